"""Data-quality checks on the driver tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linegauge.operators import quality as q
from linegauge.operators.features import time_split
from linegauge.registry.base import LINES, day, lines, query, table


def _union(*parts):
    return reduce(DataFrame.unionByName, parts)


def _row(check, tab, col, total, failed):
    return (f"SELECT '{check}' AS \"check\", '{tab}' AS \"table\", '{col}' AS \"column\", CAST({total} AS BIGINT) AS "
            f"total, CAST(coalesce({failed}, 0) AS BIGINT) AS failed, CASE WHEN coalesce({failed}, 0) = 0 THEN 'PASS' "
            f"ELSE 'FAIL' END AS status")


@query("dq_not_null_unique", "Q1 Q2", " UNION ALL ".join([
    *[_row("not_null", "documents", c, "(SELECT count(*) FROM documents)",
           f"(SELECT count(*) FROM documents WHERE {c} IS NULL)") for c in ("doc_id", "text", "lang")],
    *[_row("not_null", "labelled", c, "(SELECT count(*) FROM documents)",
           "(SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))") for c in ("quality",)],
    _row("unique", "orders", "o_orderkey", "(SELECT count(o_orderkey) FROM orders)",
         "(SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))"),
    _row("unique", "lineitem", "l_orderkey", "(SELECT count(l_orderkey) FROM lineitem)",
         "(SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1))")]))
def dq_not_null_unique(spark, sf):
    docs = table(spark, sf, "documents")
    labelled = docs.select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return _union(q.not_null(docs, "documents", ["doc_id", "text", "lang"]),
                  q.not_null(labelled, "labelled", ["quality"]),
                  q.unique(table(spark, sf, "orders"), "orders", "o_orderkey"),
                  q.unique(table(spark, sf, "lineitem"), "lineitem", "l_orderkey"))


@query("dq_primary_keys", "Q6", " UNION ALL ".join(f"""
SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS total, count(DISTINCT {c}) AS unique_values,
       count(*) - count(DISTINCT {c}) AS dupes, round((count(*) - count(DISTINCT {c})) * 100.0 / count(*), 4) AS dup_pct,
       CASE WHEN count(*) = count(DISTINCT {c}) THEN 'PASS' ELSE 'FAIL' END AS status FROM {t}"""
    for t, c in (("customer", "c_custkey"), ("part", "p_partkey"), ("events", "event_id"), ("lineitem", "l_orderkey"))))
def dq_primary_keys(spark, sf):
    keys = (("customer", "c_custkey"), ("part", "p_partkey"), ("events", "event_id"), ("lineitem", "l_orderkey"))
    out = _union(*[q.key_report(table(spark, sf, t), t, c) for t, c in keys])
    return out.withColumn("dup_pct", F.round("dup_pct", 4))


@query("dq_accepted_expr", "Q3 Q5 Q12", f"WITH {LINES} " + " UNION ALL ".join([
    _row("accepted_values", "orders", "o_orderstatus", "(SELECT count(*) FROM orders)",
         "(SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F'))"),
    _row("accepted_values", "events", "event_type", "(SELECT count(*) FROM events WHERE value > 1)",
         "(SELECT count(*) FROM events WHERE value > 1 AND event_type NOT IN ('click','error','purchase','signup','view'))"),
    _row("expression", "lineitem", "failed <= inspected", "(SELECT count(*) FROM li)",
         "(SELECT count(*) FROM li WHERE NOT failed <= inspected)"),
    _row("expression", "lineitem", "flag = failed > 0", "(SELECT count(*) FROM li)",
         "(SELECT count(*) FROM li WHERE (l_discount > 0.02) <> (failed > 0))"),
    _row("expression", "lineitem", "cost = price x (1 - discount)", "(SELECT count(*) FROM li)",
         "(SELECT count(*) FROM li WHERE abs(cost - l_extendedprice * (1 - l_discount)) >= 0.005)")]))
def dq_accepted_expr(spark, sf):
    li, c = lines(spark, sf), F.col
    kinds = ["click", "error", "purchase", "signup", "view"]
    return _union(
        q.accepted_values(table(spark, sf, "orders"), "orders", "o_orderstatus", ["O", "F"]),
        q.accepted_values(table(spark, sf, "events"), "events", "event_type", kinds, c("value") > 1),
        q.expression_holds(li, "lineitem", "failed <= inspected", c("failed") <= c("inspected")),
        q.expression_holds(li, "lineitem", "flag = failed > 0", (c("l_discount") > 0.02) == (c("failed") > 0)),
        q.expression_holds(li, "lineitem", "cost = price x (1 - discount)",
                           q.close_to(c("cost").cast("double"), c("l_extendedprice") * (1 - c("l_discount")))))


@query("dq_relationship_fknull", "Q4 Q8", """
WITH r AS (SELECT 'relationship' AS kind, 'labels.doc_id' AS rel, (SELECT count(*) FROM labels) AS total,
  (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS failed UNION ALL
  SELECT 'relationship', 'documents.doc_id', (SELECT count(*) FROM documents),
  (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)))
SELECT kind, rel, total, failed, CAST(NULL AS DOUBLE) AS null_pct,
       CASE WHEN failed = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM r
UNION ALL
SELECT 'null_rate', 'labelled.' || c, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), round(p, 4),
       CASE WHEN p = 0 THEN 'PASS' WHEN s THEN 'STRUCT' ELSE 'FAIL' END
FROM (SELECT 'quality' AS c, avg(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) * 100 AS p, true AS s
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id UNION ALL
      SELECT 'toxic', avg(CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) * 100, false
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id UNION ALL
      SELECT 'lang', avg(CASE WHEN lang IS NULL THEN 1 ELSE 0 END) * 100, false FROM documents)
""")
def dq_relationship_fknull(spark, sf):
    docs, labels = table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels")
    rel = _union(q.relationship(labels, "labels", "doc_id", docs, "doc_id"),
                 q.relationship(docs, "documents", "doc_id", labels, "doc_id"))
    nulls = q.null_rate(docs.join(labels, "doc_id", "left"), "labelled",
                        {"quality": True, "toxic": False, "lang": False})
    name = F.concat_ws(".", "table", "column")
    return rel.select(F.lit("relationship").alias("kind"), name.alias("rel"), "total", "failed",
                      F.lit(None).cast("double").alias("null_pct"), "status").unionByName(
        nulls.select(F.lit("null_rate").alias("kind"), name.alias("rel"), F.lit(None).cast("bigint").alias("total"),
                     F.lit(None).cast("bigint").alias("failed"), F.round("null_pct", 4).alias("null_pct"), "status"))


LIMITS = {"l_quantity": (1, 45), "l_extendedprice": (0, None), "l_discount": (0.01, 0.09), "l_tax": (None, 0.07)}


@query("dq_bounds", "Q9", " UNION ALL ".join(f"""
SELECT 'lineitem' AS "table", '{c}' AS "column", min({c}) AS min, max({c}) AS max,
       count(*) FILTER (WHERE {c} < {lo if lo is not None else 'NULL'}) AS below,
       count(*) FILTER (WHERE {c} > {hi if hi is not None else 'NULL'}) AS above,
       round((count(*) FILTER (WHERE {c} < {lo if lo is not None else 'NULL'})
            + count(*) FILTER (WHERE {c} > {hi if hi is not None else 'NULL'})) * 100.0 / count(*), 4) AS violation_pct,
       CASE WHEN count(*) FILTER (WHERE {c} < {lo if lo is not None else 'NULL'}) + count(*) FILTER (WHERE {c} >
         {hi if hi is not None else 'NULL'}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem"""
    for c, (lo, hi) in LIMITS.items()))
def dq_bounds(spark, sf):
    return q.bounds(table(spark, sf, "lineitem"), "lineitem", LIMITS).withColumn(
        "violation_pct", F.round("violation_pct", 4))


@query("dq_split_integrity", "Q11 Q14", """
WITH s AS (SELECT *, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train'
  WHEN o_orderdate < TIMESTAMP '2000-07-01' THEN 'validation' ELSE 'test' END AS split FROM orders),
g AS (SELECT split, count(*) AS n, min(o_orderdate) AS f, max(o_orderdate) AS l FROM s GROUP BY 1),
p AS (SELECT *, lag(l) OVER (ORDER BY f) AS prev FROM g)
SELECT split, n, strftime(f, '%Y-%m-%d') AS first_day, strftime(l, '%Y-%m-%d') AS last_day,
       coalesce(f > prev, true) AS in_order FROM p
""")
def dq_split_integrity(spark, sf):
    orders = table(spark, sf, "orders").withColumn("split", time_split("o_orderdate", "1998-12-31", "2000-06-30"))
    out = q.split_order(orders, "split", "o_orderdate", ["train", "validation", "test"])
    return out.select("split", "n", day("first").alias("first_day"), day("last").alias("last_day"), "in_order")


@query("dq_feature_quality", "Q15 Q17", """
WITH r AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-11'),
c AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-11')
SELECT 'event_type' AS feature, 0.0 AS null_pct, count(DISTINCT event_type) AS n_distinct,
       count(DISTINCT event_type) FILTER (WHERE event_type NOT IN (SELECT event_type FROM r)) AS unseen FROM c UNION ALL
SELECT 'props', round(count(*) FILTER (WHERE props IS NULL) * 100.0 / count(*), 4), count(DISTINCT props),
       count(DISTINCT props) FILTER (WHERE props NOT IN (SELECT props FROM r)) FROM c UNION ALL
SELECT 'user_id', 0.0, count(DISTINCT user_id), count(DISTINCT user_id) FILTER (WHERE user_id NOT IN
       (SELECT user_id FROM r)) FROM c UNION ALL
SELECT 'value', round(count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*), 4), count(DISTINCT value), 0 FROM c
""")
def dq_feature_quality(spark, sf):
    events = table(spark, sf, "events")
    ref = events.where(F.col("ts") < F.to_timestamp(F.lit("2024-01-11")))
    cur = events.where(F.col("ts") >= F.to_timestamp(F.lit("2024-01-11")))
    return q.feature_quality(ref, cur, ["event_type", "props", "user_id"], ["value"]).withColumn(
        "null_pct", F.round("null_pct", 4))


@query("schema_parity", "U4 Q16", """
SELECT "column", present, type, type_ok, false AS same_columns, 'period_label' AS only_right, '' AS only_left,
       (SELECT count(*) FROM events) AS n_rows
FROM (VALUES ('event_id', true, 'bigint', true), ('ts', true, 'timestamp', true), ('value', true, 'double', true),
             ('props', true, 'string', true), ('absent', false, NULL, false)) t("column", present, type, type_ok)
""")
def schema_parity(spark, sf):
    events = table(spark, sf, "events")
    late = events.where(F.col("value") > 10).withColumn("period_label", F.lit("late"))
    equal, left, right = q.same_columns(events, late)
    check = q.schema_check(events, {"event_id": T.LongType, "ts": T.TimestampType, "value": T.DoubleType,
                                    "props": T.StringType, "absent": None})
    n = events.agg(F.count("*").alias("v")).scalar()
    return check.withColumns({"same_columns": F.lit(equal), "only_right": F.lit(",".join(right)),
                              "only_left": F.lit(",".join(left)), "n_rows": n})
