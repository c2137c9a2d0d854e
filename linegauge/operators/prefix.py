"""Running sums over a global order, split into value ranges.

A window without (or with few) partition keys puts a whole key into one task. Here the
order column is cut at approximate quantiles, each range is summed, the few range totals
are accumulated, and the window then runs inside one range only. The result is exact: the
cut points decide the balance of the tasks, never the values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Tasks whose value summaries are merged by one task.
MERGED_TASKS = 64


def split_points(df: DataFrame, col: str, ranges: int) -> list[float]:
    """At most ranges - 1 ascending cut points at approximate quantiles of ``col``.

    One pass: every task summarises its values, ``MERGED_TASKS`` summaries at a time are merged into
    quantiles, and the cut points are quantiles of these. No rows are shuffled, no task reads the summaries
    of all others, and only the cut points come to the driver.
    """
    probs = [i / max(ranges, 1) for i in range(1, max(ranges, 1))]
    if not probs:
        return []

    def at_probs(value: Column | str) -> Column:
        return F.percentile_approx(value, probs, 2 * ranges)

    values = df.select(F.col(col).cast("double").alias("v"), F.floor(F.spark_partition_id() / MERGED_TASKS).alias("tasks"))
    merged = values.groupBy("tasks").agg(at_probs("v").alias("cuts")).select(F.explode("cuts").alias("v"))
    return sorted(set(merged.agg(at_probs("v").alias("cuts")).first()["cuts"] or []))


def range_number(col: str, cuts: Sequence[float]) -> Column:
    """How many cut points are <= the value, by halving a sorted array; null counts as above all.

    The expression has one array and a step per bit, whatever the number of cut points.
    """
    bits = len(cuts).bit_length()
    value = F.col(col).cast("double")
    table = F.lit([*map(float, cuts), *[float("inf")] * ((1 << bits) - 1 - len(cuts))]) if cuts else F.array().cast("array<double>")
    steps = F.lit([1 << b for b in reversed(range(bits))]) if cuts else F.array().cast("array<int>")
    at = F.aggregate(steps, F.lit(0), lambda at, step: F.when(value < F.get(table, at + step - 1), at).otherwise(at + step))
    return F.least(at, F.lit(len(cuts)))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys where null equals null; right key columns are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def running_sums(df: DataFrame, keys: Sequence[str], order: str, measures: Sequence[str],
                 ranges: int = 0, cuts: Sequence[float] | None = None) -> DataFrame:
    """Add ``<m>_upto`` (sum through this row) and ``<m>_total`` per key, and ``next_<order>``.

    ``df`` holds one row per (keys, order) with a non-null numeric ``order``. With
    ``ranges`` = 0 one plain window per key is used: right where the number of distinct
    order values per key has a known bound (calendar months, scores of four digits).
    """
    keys = list(keys)
    if not ranges:
        upto = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
        whole = W.partitionBy(*keys)
        return df.select(
            "*",
            *[F.sum(m).over(upto).alias(f"{m}_upto") for m in measures],
            *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
            F.lead(order).over(W.partitionBy(*keys).orderBy(order)).alias(f"next_{order}"))

    if cuts is None:
        cuts = split_points(df, order, ranges)
    cells = df.withColumn("_range", range_number(order, cuts))
    totals = cells.groupBy(*keys, "_range").agg(
        *[F.sum(m).alias(f"_s_{m}") for m in measures], F.min(order).alias("_first"))
    per_key = W.partitionBy(*keys).orderBy("_range")  # at most `ranges` rows per key
    offsets = totals.select(
        *keys, "_range",
        *[F.coalesce(F.sum(f"_s_{m}").over(per_key.rowsBetween(W.unboundedPreceding, -1)),
                     F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(W.partitionBy(*keys)).alias(f"{m}_total") for m in measures],
        F.lead("_first").over(per_key).alias("_after"))
    joined = same_keys(cells, offsets, [*keys, "_range"])
    cell = W.partitionBy(*keys, "_range").orderBy(order)
    upto = cell.rowsBetween(W.unboundedPreceding, W.currentRow)
    return joined.select(
        *df.columns,
        *[(F.sum(m).over(upto) + F.col(f"_o_{m}")).alias(f"{m}_upto") for m in measures],
        *[f"{m}_total" for m in measures],
        F.coalesce(F.lead(order).over(cell), F.col("_after")).alias(f"next_{order}"))
