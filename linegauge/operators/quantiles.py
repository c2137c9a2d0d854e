"""Exact interpolated quantiles, histograms and box statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linegauge.operators.prefix import range_number, same_keys, split_points
from linegauge.session import fan_out


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
                    ranges: int | None = None) -> DataFrame:
    """One row per key with the interpolated quantiles named in ``probs``; nulls are ignored.

    Rows are counted per (key, value) first, so a repeated value is one row from here on. Values
    are cut into ranges; counts per (key, range) tell which ranges hold the wanted ranks, and only
    the values of those ranges are ranked. No group is held by one task, whatever its size.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    ranges = max(64, fan_out(df.sparkSession)) if ranges is None else ranges
    cuts = split_points(rows, "_v", ranges)
    counted = rows.groupBy(*keys, "_v").agg(F.count("*").alias("_c"))
    placed = counted.withColumn("_range", range_number("_v", cuts))

    per_key = W.partitionBy(*keys)  # at most `ranges` rows per key
    sizes = placed.groupBy(*keys, "_range").agg(F.sum("_c").alias("_n")).select(
        *keys, "_range", "_n", F.sum("_n").over(per_key).alias("_total"),
        F.coalesce(F.sum("_n").over(per_key.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)),
                   F.lit(0)).alias("_before"))
    at = {name: F.lit(float(p)) * (F.col("_total") - 1) for name, p in probs.items()}
    ranks = {f"_{side}_{n}": f(pos) for n, pos in at.items() for side, f in (("lo", F.floor), ("hi", F.ceil))}
    held = {c: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")) for c, r in ranks.items()}
    wanted = sizes.where(reduce(lambda a, b: a | b, held.values())).select(
        *keys, "_range", "_total", *[F.when(held[c], r - F.col("_before")).alias(c) for c, r in ranks.items()])

    cell = [*keys, "_range"]
    hits = same_keys(placed, wanted, cell)
    order = W.partitionBy(*cell).orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = hits.withColumn("_upto", F.sum("_c").over(order))
    found = ranked.groupBy(*keys).agg(
        F.max("_total").alias("_total"),
        *[F.min(F.when(F.col("_upto") > F.col(c), F.col("_v"))).alias(c) for c in ranks])
    return found.select(*keys, *[
        (F.col(f"_lo_{n}") + (pos - F.floor(pos)) * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n)
        for n, pos in at.items()])


def histogram(df: DataFrame, value: str, lo: float | None = None, hi: float | None = None, bins: int = 30,
              keys: Sequence[str] = (), density: bool = False) -> DataFrame:
    """Counts (or density) in equal bins; the last bin takes the upper edge.

    The limits are the column's own least and largest value (over all keys) unless given. Given
    limits are for values with a known domain, such as probabilities: what lies outside is left
    out, as in a plot with fixed limits. Empty bins are not listed; a column with one value only
    has a single bin of width 1.
    """
    if lo is None or hi is None:
        row = df.where(~F.isnan(F.col(value).cast("double"))).agg(F.min(value).alias("a"), F.max(value).alias("b")).first()
        lo = (0.0 if row["a"] is None else float(row["a"])) if lo is None else lo
        hi = (lo if row["b"] is None else float(row["b"])) if hi is None else hi
    width = (hi - lo) / bins if hi > lo else 1.0
    inside = df.where(F.col(value).between(lo, hi))
    slot = F.least(F.floor((F.col(value) - lo) / width), F.lit(bins - 1)).cast("int")
    out = inside.groupBy(*keys, slot.alias("bin")).agg(F.count("*").alias("n"))
    if density:
        # the counts are at most bins rows per key, so the window below is small
        total = F.sum("n").over(W.partitionBy(*keys))
        out = out.withColumn("density", F.col("n") / (total * F.lit(width)))
    return out.withColumn("bin_start", F.lit(lo) + F.col("bin") * F.lit(width))


def box_stats(df: DataFrame, keys: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """Quartiles, whiskers at the last value inside 1.5 IQR, and the number of outliers per group.

    Without keys the whole column is one group.
    """
    quart = exact_quantiles(df, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, ranges)
    quart = quart.withColumn("_reach", 1.5 * (F.col("q3") - F.col("q1")))
    # value counts are joined back, not rows: a repeated value costs one row
    cells = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(
        F.count("*").alias("_n"))
    if keys:
        joined = same_keys(cells, quart, list(keys))
    else:
        one = quart.select(F.struct("q1", "median", "q3", "_reach").alias("s")).scalar()
        joined = cells.select("*", one.alias("_s")).select("*", "_s.*")
    inside = F.col("_v").between(F.col("q1") - F.col("_reach"), F.col("q3") + F.col("_reach"))
    return joined.groupBy(*keys).agg(
        F.sum("_n").alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("outliers"))
