"""Data-quality checks. Each returns rows (check, table, column, total, failed, status)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.operators.joins import key_match, month_spine


def _result(df: DataFrame, check: str, table: str, column: Column, total: Column, failed: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"), F.lit(table).alias("table"), column.alias("column"),
        total.cast("bigint").alias("total"), failed.cast("bigint").alias("failed"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"))


def _zero(col) -> Column:
    return F.coalesce(col, F.lit(0))


def _counts_to_rows(df: DataFrame, conds: Mapping[str, Column], check: str, table: str) -> DataFrame:
    """All violation counts of one table in a single pass, one row per entry."""
    wide = df.agg(F.count("*").alias("_t"), *[
        _zero(F.sum(F.when(c, 1).otherwise(0))).alias(f"_f{i}") for i, c in enumerate(conds.values())])
    items = [F.struct(F.lit(n).alias("c"), F.col(f"_f{i}").alias("f")) for i, n in enumerate(conds)]
    return _result(wide.select("_t", F.explode(F.array(*items)).alias("r")), check, table,
                   F.col("r.c"), F.col("_t"), F.col("r.f"))


def not_null(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    return _counts_to_rows(df, {c: F.col(c).isNull() for c in cols}, "not_null", table)


def unique(df: DataFrame, table: str, col: str) -> DataFrame:
    """Number of values that occur more than once; nulls are not compared."""
    sizes = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return _result(sizes.agg(_zero(F.sum("n")).alias("t"), _zero(F.sum((F.col("n") > 1).cast("int"))).alias("f")),
                   "unique", table, F.lit(col), F.col("t"), F.col("f"))


def accepted_values(df: DataFrame, table: str, col: str, values: Sequence, where: Column | None = None) -> DataFrame:
    """Rows whose non-null value is not in the list."""
    scope = df if where is None else df.where(where)
    bad = F.col(col).isNotNull() & ~F.col(col).isin(list(values))
    return _counts_to_rows(scope, {col: bad}, "accepted_values", table)


def expression_holds(df: DataFrame, table: str, name: str, expression: Column) -> DataFrame:
    """Rows for which an expression is false or null."""
    return _counts_to_rows(df, {name: ~F.coalesce(expression, F.lit(False))}, "expression", table)


def close_to(a: Column, b: Column, tolerance: float = 0.005) -> Column:
    return F.abs(a - b) < tolerance


def relationship(child: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Rows with a non-null key that has no parent."""
    m = key_match(child, col, parent, parent_col)
    return _result(m, "relationship", table, F.lit(col), F.col("total_rows") - F.col("null_rows"),
                   F.col("total_rows") - F.col("null_rows") - F.col("matched_rows"))


def key_report(df: DataFrame, table: str, key: str) -> DataFrame:
    """Primary key: rows, distinct values, duplicates, duplicate percentage."""
    sizes = df.groupBy(key).agg(F.count("*").alias("n"))
    counted = sizes.agg(_zero(F.sum("n")).alias("total"), F.count(key).alias("unique_values"))
    return counted.select(
        F.lit(table).alias("table"), F.lit(key).alias("column"), "total", "unique_values",
        (F.col("total") - F.col("unique_values")).alias("dupes"),
        ((F.col("total") - F.col("unique_values")) * 100.0 / F.nullif("total", F.lit(0))).alias("dup_pct"),
        F.when(F.col("total") == F.col("unique_values"), "PASS").otherwise("FAIL").alias("status"))


def relationship_report(child: DataFrame, table: str, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Row and distinct match rate of one foreign key, orphan count and an example."""
    return key_match(child, col, parent, parent_col).select(
        F.lit(f"{table}.{col}").alias("relationship"), "total_rows", "matched_rows", "row_match_pct",
        "distinct_match_pct", "orphan_keys", "sample_orphan",
        F.when(F.col("row_match_pct") >= 100, "PASS").otherwise("FAIL").alias("status"))


def null_rate(df: DataFrame, table: str, cols: Mapping[str, bool]) -> DataFrame:
    """Null percentage of key columns; ``cols`` says which nulls are structural."""
    wide = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(f"_{i}") for i, c in enumerate(cols)])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("null_pct"), F.lit(ok).alias("structural"))
             for i, (c, ok) in enumerate(cols.items())]
    return wide.select(F.explode(F.array(*items)).alias("r")).select(
        F.lit(table).alias("table"), "r.*",
        F.when(F.col("r.null_pct") == 0, "PASS").when(F.col("r.structural"), "STRUCT").otherwise("FAIL")
        .alias("status"))


def bounds(df: DataFrame, table: str, limits: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Min, max, values below and above the limits, for all columns in one pass."""
    aggs = [F.count("*").alias("_t")]
    for i, (c, (lo, hi)) in enumerate(limits.items()):
        aggs += [F.min(c).cast("double").alias(f"_mn{i}"), F.max(c).cast("double").alias(f"_mx{i}"),
                 _zero(F.sum((F.col(c) < lo).cast("int")) if lo is not None else F.lit(0)).alias(f"_b{i}"),
                 _zero(F.sum((F.col(c) > hi).cast("int")) if hi is not None else F.lit(0)).alias(f"_a{i}")]
    items = [F.struct(F.lit(c).alias("column"), F.col(f"_mn{i}").alias("min"), F.col(f"_mx{i}").alias("max"),
                      F.col(f"_b{i}").cast("bigint").alias("below"), F.col(f"_a{i}").cast("bigint").alias("above"))
             for i, c in enumerate(limits)]
    r = df.agg(*aggs).select("_t", F.explode(F.array(*items)).alias("r")).select("_t", "r.*")
    bad = F.col("below") + F.col("above")
    return r.select(F.lit(table).alias("table"), "column", "min", "max", "below", "above",
                    (bad * 100.0 / F.nullif("_t", F.lit(0))).alias("violation_pct"),
                    F.when(bad == 0, "PASS").otherwise("FAIL").alias("status"))


def month_gaps(df: DataFrame, month: str) -> DataFrame:
    """Calendar months without a row between the first and the last month."""
    seen = df.where(F.col(month).isNotNull()).select(month).distinct()
    return month_spine(seen, month).join(seen, month, "left_anti")


def split_order(df: DataFrame, split: str, ts: str, order: Sequence[str]) -> DataFrame:
    """Row count and time range per split, and whether each starts after the one before ends."""
    one = df.groupBy(split).agg(F.count("*").alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    ends = one.agg(*[F.max(F.when(F.col(split) == s, F.col("last"))).alias(f"_e{i}") for i, s in enumerate(order)])
    end = ends.select(F.struct("*").alias("v")).scalar()
    before = reduce(lambda acc, i: F.when(F.col(split) == order[i], end[f"_e{i - 1}"]).otherwise(acc),
                    range(1, len(order)), F.lit(None).cast("timestamp"))
    return one.withColumn("previous_last", before).withColumn(
        "in_order", F.coalesce(F.col("first") > F.col("previous_last"), F.lit(True)))


def class_balance(df: DataFrame, target: str, low: float, high: float, min_rows: int = 0,
                  keys: Sequence[str] = ()) -> DataFrame:
    """Positive and negative counts, rate, odds, and whether rate and size are inside limits."""
    y = F.col(target).cast("int")
    out = df.where(F.col(target).isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"), _zero(F.sum(y)).alias("positives"), F.avg(y).alias("rate"))
    return out.select(
        *keys, "n", "positives", (F.col("n") - F.col("positives")).alias("negatives"), "rate",
        (F.col("positives") / F.nullif(F.col("n") - F.col("positives"), F.lit(0))).alias("odds"),
        ((F.col("n") - F.col("positives")) / F.greatest("positives", F.lit(1))).alias("class_weight"),
        F.coalesce(F.col("rate").between(low, high), F.lit(False)).alias("balance_ok"),
        (F.col("n") > min_rows).alias("size_ok"))


def schema_check(df: DataFrame, expected: Mapping[str, type | None]) -> DataFrame:
    """Expected columns against the frame's schema (no data is read)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    rows = [(c, c in have, have[c].simpleString() if c in have else None,
             c in have and (t is None or isinstance(have[c], t))) for c, t in expected.items()]
    return df.sparkSession.createDataFrame(rows, "column string, present boolean, type string, type_ok boolean")


def same_columns(a: DataFrame, b: DataFrame) -> tuple[bool, list[str], list[str]]:
    """Whether two frames have the same column set, and what each has alone."""
    left, right = set(a.columns), set(b.columns)
    return left == right, sorted(left - right), sorted(right - left)


def feature_quality(reference: DataFrame, current: DataFrame, categorical: Sequence[str],
                    numeric: Sequence[str]) -> DataFrame:
    """Null percentage, distinct values and values unseen in the reference, per feature.

    Both frames are melted to (feature, value) counts once; all features share one shuffle.
    """
    from linegauge.operators.profile import melted

    cols = [*categorical, *numeric]

    def counts(df, n):
        return melted(df, cols).groupBy("column", "value").agg(
            F.count("*").alias(n))

    ref = counts(reference, "_r").where(F.col("value").isNotNull())
    cur = counts(current, "_n")
    both = cur.join(ref, ["column", "value"], "left")
    cat = F.col("column").isin(list(categorical)) if categorical else F.lit(False)
    return both.groupBy("column").agg(
        F.sum("_n").alias("_t"), _zero(F.sum(F.when(F.col("value").isNull(), F.col("_n")))).alias("_nulls"),
        F.count("value").alias("n_distinct"),
        F.count(F.when(F.col("value").isNotNull() & F.col("_r").isNull() & cat, 1)).alias("unseen"),
    ).select(F.col("column").alias("feature"), (F.col("_nulls") * 100.0 / F.col("_t")).alias("null_pct"),
             "n_distinct", "unseen")
