"""Profiling and duplicate analysis on the driver tables."""

from pyspark.sql import functions as F

from linegauge.operators import profile
from linegauge.registry.base import query, table


def _summary_sql(c, dtype):
    return f"""
SELECT '{c}' AS "column", '{dtype}' AS dtype, count(*) AS total, count(*) - count({c}) AS null_count,
  round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_pct, count(DISTINCT {c}) AS n_unique,
  coalesce(min(substr(CAST({c} AS VARCHAR), 1, 60)), '(all null)') AS sample,
  CASE WHEN (count(*) - count({c})) * 100.0 / count(*) > 10 THEN 'HIGH' WHEN count(*) > count({c}) THEN 'MEDIUM' END
    AS null_severity
FROM documents LEFT JOIN labels USING (doc_id)"""


@query("profile_schema", "R1 R2 Q17", " UNION ALL ".join(_summary_sql(c, t) for c, t in (
    ("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
    ("quality", "int"))))
def profile_schema(spark, sf):
    df = table(spark, sf, "documents").join(table(spark, sf, "labels").drop("toxic"), "doc_id", "left")
    return profile.schema_summary(df, ["doc_id", "text", "lang", "source", "n_chars", "quality"]).withColumn(
        "null_pct", F.round("null_pct", 4))


def _messy(part):
    """Part names with upper-case and padded spellings for some sizes."""
    name = F.col("p_name")
    return part.select(F.when(F.col("p_size") > 45, F.upper(name)).when(F.col("p_size") < 4, F.initcap(name))
                       .otherwise(name).alias("name"),
                       F.when(F.col("p_size") == 7, F.concat(F.lit(" "), "p_type")).when(
                           F.col("p_size") == 9, F.concat("p_type", F.lit(" "))).otherwise(F.col("p_type"))
                       .alias("kind"))


MESSY = """
messy AS (SELECT CASE WHEN p_size > 45 THEN upper(p_name) WHEN p_size < 4 THEN
  upper(substr(split_part(p_name, ' ', 1), 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' ||
  upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) ELSE p_name END AS name,
  CASE WHEN p_size = 7 THEN ' ' || p_type WHEN p_size = 9 THEN p_type || ' ' ELSE p_type END AS kind FROM part)
"""


@query("profile_case_whitespace", "R3 R4", f"""
WITH {MESSY}, n AS (SELECT 'name' AS c, name AS v, count(*) AS n FROM messy GROUP BY 2 UNION ALL
  SELECT 'kind', kind, count(*) FROM messy GROUP BY 2),
ws AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, v) AS r, sum(n) OVER (PARTITION BY c) AS t FROM n
       WHERE v <> trim(v))
SELECT 'case' AS issue, c AS "column", lower(v) AS value, count(*) AS variants, CAST(sum(n) AS BIGINT) AS n_rows
FROM n GROUP BY 2, 3 HAVING count(*) > 1
UNION ALL SELECT 'whitespace', c, v, CAST(n AS BIGINT), CAST(t AS BIGINT) FROM ws WHERE r <= 5
""")
def profile_case_whitespace(spark, sf):
    messy = _messy(table(spark, sf, "part"))
    cols = profile.text_columns(messy)
    case = profile.case_variants(messy, cols).select(
        F.lit("case").alias("issue"), "column", F.col("folded").alias("value"), "variants", "n_rows")
    space = profile.whitespace_variants(messy, cols).select(
        F.lit("whitespace").alias("issue"), "column", "value", F.col("n").alias("variants"),
        F.col("rows_affected").alias("n_rows"))
    return case.unionByName(space)


@query("profile_type_inference", "R5 R6", """
WITH t AS (SELECT CAST(p_size AS VARCHAR) AS size_text, CASE WHEN p_size > 5 THEN CAST(p_retailprice AS VARCHAR) ELSE
  'n/a' END AS price_text, CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'no' END AS even, p_type AS type_text,
  p_name AS name_text, CAST(DATE '2020-01-01' + CAST(p_size AS INTEGER) AS VARCHAR) AS date_text FROM part),
u AS (UNPIVOT t ON COLUMNS(*) INTO NAME "column" VALUE v),
s AS (SELECT "column", count(DISTINCT v) AS n_distinct, bool_and(lower(v) IN ('yes', 'no')) AS b,
  round(count(TRY_CAST(v AS DOUBLE)) * 100.0 / count(*), 4) AS num, round(count(TRY_CAST(v AS TIMESTAMP)) * 100.0 /
  count(*), 4) AS dt FROM u GROUP BY 1),
k AS (SELECT *, CASE WHEN "column" = 'name_text' THEN 'id' WHEN b THEN 'boolean' WHEN num >= 80 THEN 'numeric'
  WHEN dt >= 80 THEN 'datetime' WHEN n_distinct <= 15 THEN 'categorical' ELSE 'text' END AS kind FROM s)
SELECT "column", n_distinct, kind AS intended_type, CASE kind WHEN 'numeric' THEN num WHEN 'datetime' THEN dt ELSE 100.0
  END AS confidence, CASE WHEN "column" = 'name_text' THEN 'override' ELSE 'inferred' END AS source,
  kind NOT IN ('text', 'id') AS type_mismatch, CASE kind WHEN 'numeric' THEN 'CAST(col AS NUMERIC)' WHEN 'datetime'
  THEN 'CAST(col AS TIMESTAMP)' WHEN 'boolean' THEN 'CAST(col AS BOOLEAN)' WHEN 'categorical' THEN
  'consider enum or varchar' WHEN 'text' THEN 'already object; no cast needed' ELSE 'ID field; keep as varchar' END
  AS suggested_cast FROM k
""")
def profile_type_inference(spark, sf):
    c = F.col
    t = table(spark, sf, "part").select(
        c("p_size").cast("string").alias("size_text"),
        F.when(c("p_size") > 5, c("p_retailprice").cast("string")).otherwise("n/a").alias("price_text"),
        F.when(c("p_size") % 2 == 0, "Yes").otherwise("no").alias("even"), c("p_type").alias("type_text"),
        c("p_name").alias("name_text"),
        F.date_add(F.lit("2020-01-01").cast("date"), c("p_size")).cast("string").alias("date_text"))
    out = profile.infer_types(t, profile.text_columns(t), {"name_text": "id"})
    return out.withColumn("confidence", F.round("confidence", 4))


@query("profile_long_texts", "R3 R5 R6", """
WITH t AS (SELECT text AS v, CASE WHEN doc_id % 3 = 0 THEN translate(text, 'aeiou', 'AEIOU') ELSE text END AS mixed FROM documents
           UNION ALL SELECT text, lower(text) FROM documents),
n AS (SELECT lower(mixed) AS folded, mixed, count(*) AS n FROM t GROUP BY 1, 2),
c AS (SELECT count(*) AS variants, sum(n) AS n_rows, length(folded) AS l, min(mixed) AS a, max(mixed) AS b FROM n
      GROUP BY folded HAVING count(*) > 1),
u AS (SELECT repeat('0', 70) || page_id AS long_number, url FROM pages),
k AS (SELECT 'long_number' AS "column", count(DISTINCT long_number) AS n FROM u UNION ALL
      SELECT 'url', count(DISTINCT url) FROM u)
SELECT 'case' AS issue, 'mixed' AS "column", md5(a) AS first_value, md5(b) AS last_value, variants AS n_values,
       CAST(n_rows AS BIGINT) AS n_rows, CAST(l AS BIGINT) AS length, NULL AS intended_type FROM c
UNION ALL SELECT 'type', "column", NULL, NULL, n, NULL, NULL, CASE "column" WHEN 'url' THEN 'text' ELSE 'numeric' END FROM k
""")
def profile_long_texts(spark, sf):
    """Values far beyond any display width: spelling variants of whole texts, types of long numbers and urls."""
    docs = table(spark, sf, "documents")
    mixed = docs.select(F.when(F.col("doc_id") % 3 == 0, F.translate("text", "aeiou", "AEIOU")).otherwise(F.col("text")).alias("mixed")).unionByName(
        docs.select(F.lower("text").alias("mixed")))
    case = profile.case_variants(mixed, ["mixed"]).select(
        F.lit("case").alias("issue"), "column", F.md5(F.col("first_variant").cast("binary")).alias("first_value"),
        F.md5(F.col("last_variant").cast("binary")).alias("last_value"), F.col("variants").alias("n_values"), "n_rows",
        F.length("folded").cast("bigint").alias("length"), F.lit(None).cast("string").alias("intended_type"))
    pages = table(spark, sf, "pages").select(
        F.concat(F.repeat(F.lit("0"), F.lit(70)), F.col("page_id").cast("string")).alias("long_number"), "url")
    types = profile.infer_types(pages, ["long_number", "url"]).select(
        F.lit("type").alias("issue"), "column", F.lit(None).cast("string").alias("first_value"),
        F.lit(None).cast("string").alias("last_value"), F.col("n_distinct").alias("n_values"),
        F.lit(None).cast("bigint").alias("n_rows"), F.lit(None).cast("bigint").alias("length"), "intended_type")
    return case.unionByName(types)


CONTENT = ["text", "lang", "source", "n_chars"]  # every column of documents but the id
LINE_CONTENT = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate"]


def _exact_sql(name: str, content: list[str]) -> str:
    return f"""
WITH g AS (SELECT count(*) AS n FROM {name} GROUP BY {', '.join(content)})
SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS dup_rows,
       count(*) FILTER (WHERE n > 1) AS dup_groups,
       round(coalesce(sum(n) FILTER (WHERE n > 1), 0) * 100.0 / sum(n), 4) AS dup_pct
FROM g
"""


def _near_sql(name: str, content: list[str]) -> str:
    return (f"WITH m AS (SELECT *, count(*) OVER (PARTITION BY {', '.join(content)}) > 1 AS x FROM {name}) " + " UNION ALL ".join(f"""
SELECT * FROM (SELECT '{c}' AS differing_col, count(*) FILTER (WHERE s > 1 AND NOT x) AS dup_rows,
  round(count(*) FILTER (WHERE s > 1 AND NOT x) * 100.0 / count(*), 4) AS dup_pct FROM (SELECT x, count(*) OVER
  (PARTITION BY {', '.join(o for o in content if o != c)}) AS s FROM m)) WHERE dup_rows > 0""" for c in content))


def _rounded_pct(df):
    return df.withColumn("dup_pct", F.round("dup_pct", 4))


@query("profile_dups_exact", "R7", _exact_sql("lineitem", LINE_CONTENT))
def profile_dups_exact(spark, sf):
    return _rounded_pct(profile.exact_duplicates(table(spark, sf, "lineitem"), LINE_CONTENT))


@query("profile_dups_near", "R8", _near_sql("lineitem", LINE_CONTENT))
def profile_dups_near(spark, sf):
    return _rounded_pct(profile.near_duplicates(table(spark, sf, "lineitem"), LINE_CONTENT))


@query("content_dups_exact", "R7", _exact_sql("documents", CONTENT))
def content_dups_exact(spark, sf):
    return _rounded_pct(profile.exact_duplicates(table(spark, sf, "documents"), CONTENT))


@query("content_dups_near", "R8", _near_sql("documents", CONTENT))
def content_dups_near(spark, sf):
    return _rounded_pct(profile.near_duplicates(table(spark, sf, "documents"), CONTENT))


IGNORED = {"lineitem": ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"],
           "orders": ["o_orderkey", "o_orderdate", "o_totalprice"], "documents": ["doc_id"], "pages": ["page_id"]}
KEPT = {"lineitem": ["l_quantity", "l_discount", "l_tax", "lower(trim(l_returnflag))", "lower(trim(l_linestatus))"],
        "orders": ["o_custkey", "lower(trim(o_orderstatus))", "lower(trim(o_orderpriority))"],
        "documents": ["lower(trim(text))", "lower(trim(lang))", "lower(trim(source))", "n_chars"],
        "pages": ["lower(trim(url))", "lower(trim(html))"]}


@query("duplicate_report", "R7 R12", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", * FROM ({_exact_sql(t, kept)})" for t, kept in KEPT.items()))
def duplicate_report(spark, sf):
    """Identical content per table, keys and sequence columns left out, text compared without case."""
    return _rounded_pct(profile.duplicate_report({t: table(spark, sf, t) for t in IGNORED}, IGNORED))


@query("profile_dup_agreement", "R9 R11", """
WITH g AS (SELECT max(l_quantity) - min(l_quantity) AS q, max(l_extendedprice) - min(l_extendedprice) AS p,
  (epoch_us(max(l_shipdate)) - epoch_us(min(l_shipdate))) / 60000000.0 AS s,
  CASE WHEN max(lower(l_returnflag)) <> min(lower(l_returnflag)) THEN 1.0 ELSE 0.0 END AS f
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1),
u AS (SELECT 'l_quantity' AS "column", 'numeric' AS kind, q AS d FROM g UNION ALL
  SELECT 'l_extendedprice', 'numeric', p FROM g UNION ALL SELECT 'l_shipdate', 'datetime', s FROM g UNION ALL
  SELECT 'l_returnflag', 'string', f FROM g),
a AS (SELECT "column", kind, count(*) AS n, avg(CASE WHEN d = 0 THEN 1 ELSE 0 END) * 100 AS pct, avg(d) AS m,
  max(d) AS x, quantile_cont(d, 0.95) AS p95 FROM u GROUP BY 1, 2),
r AS (SELECT *, CASE WHEN round(pct, 1) = 100 THEN 'always identical' WHEN kind = 'string' THEN 'varies'
  WHEN x <= CASE WHEN kind = 'datetime' THEN 120 ELSE 2 END THEN 'minor variation' ELSE 'meaningful variation' END
  AS note FROM a)
SELECT "column", kind, n AS n_groups, round(pct, 4) AS pct_identical,
  round(CASE WHEN kind <> 'string' THEN m END, 4) AS mean_diff, round(CASE WHEN kind <> 'string' THEN x END, 4) AS
  max_diff, round(CASE WHEN kind <> 'string' THEN p95 END, 4) AS p95_diff, note,
  (SELECT CASE WHEN count(*) FILTER (WHERE note IN ('varies', 'meaningful variation')) = 0 THEN 'keep first by key'
   ELSE 'review' END FROM r) AS advice FROM r
""")
def profile_dup_agreement(spark, sf):
    out = profile.field_agreement(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
                                  ["l_quantity", "l_extendedprice"], ["l_shipdate"], ["l_returnflag"])
    advice = profile.dedup_advice(out, tolerance=1).select("advice").scalar()
    return out.withColumns({c: F.round(c, 4) for c in ("pct_identical", "mean_diff", "max_diff", "p95_diff")}).withColumn(
        "advice", advice)


@query("profile_dup_samples", "R10", """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
  ORDER BY 1, 2 LIMIT 5), k AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS i FROM g)
SELECT CAST(i AS INTEGER) AS dup_group, n AS group_size, l.l_partkey, l.l_orderkey, l.l_linenumber
FROM lineitem l JOIN k USING (l_orderkey, l_linenumber)
""")
def profile_dup_samples(spark, sf):
    return profile.sample_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_partkey", 5)


@query("dirty_rates", "R13", """
WITH k AS (SELECT CAST(sum(n) FILTER (WHERE n > 1) AS DOUBLE) / sum(n) AS d FROM
  (SELECT count(*) AS n FROM documents GROUP BY text))
SELECT round(avg(CASE WHEN text <> trim(text) THEN 1.0 ELSE 0.0 END), 6) AS raw_differs,
       round(avg(CASE WHEN quality IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing,
       round(avg(CASE WHEN starts_with(source, 'src1') THEN 0.0 ELSE 1.0 END), 6) AS wrong_form,
       round((SELECT d FROM k), 6) AS duplicate_share
FROM documents LEFT JOIN labels USING (doc_id)
""")
def dirty_rates(spark, sf):
    docs = table(spark, sf, "documents")
    share = lambda cond: F.round(F.avg(F.when(cond, 1.0).otherwise(0.0)), 6)
    # texts are counted by digest: the shuffle carries 32 bytes per text
    sizes = docs.groupBy(F.sha2("text", 256).alias("h")).agg(F.count("*").alias("n"))
    dup = sizes.agg(F.round(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("v"))
    both = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    return both.agg(share(F.col("text") != F.trim("text")).alias("raw_differs"),
                    share(F.col("quality").isNull()).alias("missing"),
                    share(~F.col("source").startswith("src1")).alias("wrong_form")).withColumn(
        "duplicate_share", dup.scalar())
