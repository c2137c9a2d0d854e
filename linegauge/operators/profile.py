"""Profiling: schema, nulls, spelling variants, type inference, duplicate analysis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linegauge.operators.dedup import top_per_group
from linegauge.operators.quantiles import exact_quantiles
from linegauge.session import cut_lineage


def melted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value as text), one row per cell."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value")


def schema_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, nulls, null percentage, distinct values, an example, null severity.

    One scan: cells are counted per column and 128-bit fingerprint of the value with map-side
    partial counts, then per column, so no long text is shuffled.
    """
    cols = list(cols or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    prints = [F.xxhash64("value").alias("_v"), F.xxhash64(F.lit(1), "value").alias("_w")]
    cells = melted(df, cols).groupBy("column", F.isnull("value").alias("_null"), *prints).agg(
        F.count("*").alias("n"), F.min(F.substring("value", 1, 60)).alias("example"))
    out = cells.groupBy("column").agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(F.col("_null"), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count_if(~F.col("_null")).alias("n_unique"), F.min("example").alias("sample"))
    pct = F.col("null_count") * 100.0 / F.col("total")
    dtype = reduce(lambda acc, c: F.when(F.col("column") == c, types[c]).otherwise(acc), cols, F.lit(None))
    return out.select("column", dtype.alias("dtype"), "total", "null_count", pct.alias("null_pct"), "n_unique",
                      F.coalesce("sample", F.lit("(all null)")).alias("sample"),
                      F.when(pct > 10, "HIGH").when(pct > 0, "MEDIUM").alias("null_severity"))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def value_counts(df: DataFrame, cols: Sequence[str], **derived: Column) -> DataFrame:
    """Rows per (column, value, derived...)."""
    cells = melted(df, cols).where(F.col("value").isNotNull())
    return cells.groupBy("column", *[e.alias(n) for n, e in derived.items()],
                         "value").agg(F.count("*").alias("n"))


def case_variants(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values that collapse under lower(): variants and rows per folded value."""
    folded = value_counts(df, cols, folded=F.lower("value"))
    return folded.groupBy("column", "folded").agg(
        F.count("*").alias("variants"), F.sum("n").alias("n_rows"), F.min("value").alias("first_variant"),
        F.max("value").alias("last_variant")).where("variants > 1")


def whitespace_variants(df: DataFrame, cols: Sequence[str], examples: int = 5) -> DataFrame:
    """Values with leading or trailing space: most frequent examples per column with the column total."""
    cells = melted(df, cols).where(F.col("value") != F.trim("value"))
    bad = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
    totals = bad.groupBy("column").agg(F.sum("n").alias("rows_affected"))
    top = top_per_group(bad, ["column"], examples, F.desc("n"), F.asc("value"))
    return top.join(totals, "column").select("column", "rank", "value", "n", "rows_affected")


BOOLEAN_SETS = [{"true", "false"}, {"yes", "no"}, {"y", "n"}, {"1", "0"}, {"t", "f"}]

# Cast suggested for each intended type.
SUGGESTED_CAST = {
    "numeric": "CAST(col AS NUMERIC)",
    "datetime": "CAST(col AS TIMESTAMP)",
    "boolean": "CAST(col AS BOOLEAN)",
    "categorical": "consider enum or varchar",
    "text": "already object; no cast needed",
    "id": "ID field; keep as varchar",
}


def infer_types(df: DataFrame, cols: Sequence[str], overrides: Mapping[str, str] | None = None,
                numeric_pct: float = 80.0, datetime_pct: float = 80.0, max_categories: int = 15) -> DataFrame:
    """Intended type of text columns with confidence: boolean, numeric, datetime, categorical, text.

    Only distinct values are parsed; the counts weight them.
    """
    overrides = overrides or {}
    values = value_counts(df, cols)
    low = F.lower("value")
    sets = [F.min(low.isin(sorted(s))) for s in BOOLEAN_SETS]
    stats = values.groupBy("column").agg(
        F.sum("n").alias("_n"), F.count("*").alias("n_distinct"),
        reduce(lambda a, b: a | b, sets).alias("_bool"),
        F.sum(F.when(F.col("value").try_cast("double").isNotNull(), F.col("n")).otherwise(0)).alias("_num"),
        F.sum(F.when(F.col("value").try_cast("timestamp").isNotNull(), F.col("n")).otherwise(0)).alias("_dt"))
    num, dt = F.col("_num") * 100.0 / F.col("_n"), F.col("_dt") * 100.0 / F.col("_n")
    intended = (F.when(F.col("_bool"), "boolean").when(num >= numeric_pct, "numeric")
                .when(dt >= datetime_pct, "datetime")
                .when(F.col("n_distinct") <= max_categories, "categorical").otherwise("text"))
    confidence = (F.when(F.col("_bool"), 100.0).when(num >= numeric_pct, num)
                  .when(dt >= datetime_pct, dt).otherwise(100.0))
    source = F.lit("inferred")
    for c, t in overrides.items():
        here = F.col("column") == c
        intended, confidence = F.when(here, t).otherwise(intended), F.when(here, 100.0).otherwise(confidence)
        source = F.when(here, "override").otherwise(source)
    out = stats.select("column", "n_distinct", intended.alias("intended_type"),
                       confidence.alias("confidence"), source.alias("source"))
    cast = F.create_map(*[F.lit(x) for kv in SUGGESTED_CAST.items() for x in kv])
    return out.withColumn("type_mismatch", ~F.col("intended_type").isin("text", "id")).withColumn(
        "suggested_cast", F.try_element_at(cast, F.col("intended_type")))


# -- duplicates ----------------------------------------------------------------

def _cell_hashes(df: DataFrame, cols: Sequence[str], fold_case: bool) -> DataFrame:
    """Two independent 64-bit hashes per cell, seeded with the column's position."""
    out = []
    for i, c in enumerate(cols):
        text = F.col(c).cast("string")
        if fold_case:
            text = F.lower(F.trim(text))
        missing = F.col(c).isNull()
        out += [F.xxhash64(F.lit(2 * i), missing, text).alias(f"_a{i}"),
                F.xxhash64(F.lit(2 * i + 1_000_003), missing, text).alias(f"_b{i}")]
    return df.select(*out)


def _xor(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), [F.col(n) for n in names])


#: Columns left out of duplicate analysis, per table: those expected to differ between otherwise identical rows.
IGNORE = {"machines": ["machine_id"], "operators": ["operator_id"], "material_lots": ["lot_id_clean"], "part_catalog": ["part_number"],
          "production_orders": ["work_order_id"], "inspections": ["inspection_id", "inspection_date"], "scrap_events": ["scrap_id"]}


def content_columns(df: DataFrame, name: str, ignore: Mapping[str, Sequence[str]] = IGNORE) -> list[str]:
    """Columns of a table that tell whether two rows are the same record."""
    left_out = set(ignore.get(name, ()))
    return [c for c in df.columns if c not in left_out]


def duplicate_report(tables: Mapping[str, DataFrame], ignore: Mapping[str, Sequence[str]] = IGNORE, fold_case: bool = True) -> DataFrame:
    """One row per table: rows, rows and groups of identical content, percentage; a table is scanned once."""
    rows = [exact_duplicates(df, content_columns(df, name, ignore), fold_case).select(F.lit(name).alias("table"), "*")
            for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def exact_duplicates(df: DataFrame, content: Sequence[str], fold_case: bool = False) -> DataFrame:
    """Rows whose content columns all repeat, with their percentage (128-bit row fingerprint)."""
    k = len(content)
    rows = _cell_hashes(df, content, fold_case).select(
        _xor([f"_a{i}" for i in range(k)]).alias("h1"), _xor([f"_b{i}" for i in range(k)]).alias("h2"))
    sizes = rows.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    out = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
                    F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)), F.lit(0)).alias("dup_rows"),
                    F.count(F.when(F.col("n") > 1, 1)).alias("dup_groups"))
    return out.withColumn("dup_pct", F.col("dup_rows") * 100.0 / F.nullif("total_rows", F.lit(0)))


def _row_print(df: DataFrame, cols: Sequence[str], fold_case: bool) -> list[Column]:
    """h1, h2: a 96-bit fingerprint of a row's cells. A cell is the value itself where its type has a fixed width, else its text."""
    cells = [F.lit(len(cols))]
    for c in cols:
        cell = F.col(c)
        if not isinstance(df.schema[c].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
            cell = F.lower(F.trim(cell.cast("string"))) if fold_case else cell.cast("string")
        cells += [F.col(c).isNull(), cell]
    return [F.xxhash64(F.lit(0), *cells).alias("h1"), F.shiftright(F.xxhash64(F.lit(1_000_003), *cells), 32).cast("int").alias("h2")]


def _repeating(df: DataFrame, cols: Sequence[str], fold_case: bool) -> DataFrame:
    """One row: rows in all, and rows that another row equals in ``cols``."""
    sizes = df.select(*_row_print(df, cols, fold_case)).groupBy("h1", "h2").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("total_rows"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n"))


def near_duplicates(df: DataFrame, content: Sequence[str], fold_case: bool = False) -> DataFrame:
    """Per column: rows that match another row in every other content column, exact duplicates excluded.

    Rows are counted by fingerprints that leave one column out, a column at a time: only fingerprints and
    counts are shuffled, partly summed before, and a task holds one fingerprint per row it reads. An exact
    duplicate has a match whatever column is left out, so the rows that repeat wholly are taken off every
    column's count; nothing is compared pairwise.
    """
    exact = _repeating(df, content, fold_case).select("n").scalar()
    near = [_repeating(df, [o for o in content if o != c], fold_case).select(
        F.lit(c).alias("differing_col"), "total_rows", (F.col("n") - exact).alias("dup_rows")) for c in content]
    return reduce(DataFrame.unionAll, near).where("dup_rows > 0").select(
        "differing_col", "dup_rows", (F.col("dup_rows") * 100.0 / F.col("total_rows")).alias("dup_pct"))


def field_agreement(df: DataFrame, group: Sequence[str], numeric: Sequence[str] = (), times: Sequence[str] = (),
                    texts: Sequence[str] = (), number_limit: float = 2, minute_limit: float = 120) -> DataFrame:
    """How far the members of duplicate groups agree, per column.

    Numbers: spread of the group; times: spread in minutes; texts: whether folded values
    differ. Groups are reduced by min / max / count (map-side), never collected.
    """
    folded = lambda c: F.lower(F.trim(F.col(c)))
    aggs = [F.count("*").alias("_size")]
    for c in numeric:
        aggs.append(F.when(F.count(c) == F.count("*"), F.max(c) - F.min(c)).cast("double").alias(f"_d_{c}"))
    for c in times:
        micros = F.unix_micros(F.col(c).cast("timestamp"))
        aggs.append(((F.max(micros) - F.min(micros)) / F.lit(6e7)).alias(f"_d_{c}"))
    for c in texts:
        aggs.append(F.coalesce((F.max(folded(c)) != F.min(folded(c))).cast("double"), F.lit(0.0)).alias(f"_d_{c}"))
    groups = df.groupBy(*group).agg(*aggs).where("_size > 1")
    kinds = {**{c: "numeric" for c in numeric}, **{c: "datetime" for c in times}, **{c: "string" for c in texts}}
    long = groups.select(*[F.col(f"_d_{c}").alias(c) for c in kinds]).unpivot(
        [], list(kinds), "column", "diff").where(F.col("diff").isNotNull())
    long = cut_lineage(long)  # differences of duplicate groups only; read several times below
    kind = reduce(lambda acc, c: F.when(F.col("column") == c, kinds[c]).otherwise(acc), kinds, F.lit(None))
    stats = long.groupBy("column").agg(
        F.count("*").alias("n_groups"), (F.avg((F.col("diff") == 0).cast("int")) * 100).alias("pct_identical"),
        F.avg("diff").alias("mean_diff"), F.max("diff").alias("max_diff")).withColumn("kind", kind)
    p95 = exact_quantiles(long, ["column"], "diff", {"p95_diff": 0.95})
    is_text = F.col("kind") == "string"
    minor = F.col("max_diff") <= F.when(F.col("kind") == "datetime", minute_limit).otherwise(number_limit)
    note = (F.when(F.round("pct_identical", 1) == 100, "always identical")
            .when(is_text, "varies").when(minor, "minor variation").otherwise("meaningful variation"))
    number = lambda c: F.when(~is_text, F.col(c)).alias(c)
    return stats.join(p95, "column").select(
        "column", "kind", "n_groups", "pct_identical", number("mean_diff"), number("max_diff"), number("p95_diff"),
        note.alias("note"))


def dedup_advice(agreement: DataFrame, tolerance: int) -> DataFrame:
    """DISTINCT, keep-first or review, from the notes of field_agreement."""
    unclear = F.count(F.when(F.col("note").isin("varies", "meaningful variation"), 1))
    advice = F.lit("select distinct") if tolerance == 0 else F.when(
        unclear == 0, "keep first by key").otherwise("review")
    return agreement.agg(F.count("*").alias("columns_checked"), unclear.alias("columns_unclear"),
                         advice.alias("advice"))


def sample_groups(df: DataFrame, group: Sequence[str], row_id: str, n_groups: int = 5) -> DataFrame:
    """All rows of the first n duplicate groups, with group number (order of the group keys)."""
    picked = (df.groupBy(*group).agg(F.count("*").alias("group_size")).where("group_size > 1")
              .orderBy(*group).limit(n_groups))
    from pyspark.sql import Window as W
    numbered = picked.withColumn("dup_group", F.row_number().over(W.orderBy(*group)))  # n_groups rows
    return df.join(numbered, list(group)).select("dup_group", "group_size", row_id, *group)
