"""Rates, shares, pivots, scalar comparison: aggregates keyed by any dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linegauge.functions.exprs import ratio, ratio_or_zero


def weighted_rate(failed, inspected) -> Column:
    """Sum of failed over sum of inspected, 0 for an empty group."""
    total = F.coalesce(F.sum(inspected), F.lit(0))
    return ratio_or_zero(F.coalesce(F.sum(failed), F.lit(0)), total)


def rate_by(df: DataFrame, dims: Sequence[str | Column], failed: str, inspected: str) -> DataFrame:
    """Volume-weighted rate per dimension with the sums behind it."""
    return df.groupBy(*dims).agg(
        F.sum(inspected).alias("inspected"), F.sum(failed).alias("failed"),
        weighted_rate(failed, inspected).alias("rate"))


def rates_by(df: DataFrame, dims: Sequence[str], failed: str, inspected: str, min_group: int = 0) -> DataFrame:
    """Weighted rate, mean of row rates, n and low-n flag per dimension, and the overall mean, in one aggregate.

    The overall mean comes from the groups' sums, so the rows are read once.
    """
    row_rate = ratio(failed, inspected)
    groups = df.groupBy(*dims).agg(
        F.sum(inspected).alias("inspected"), F.sum(failed).alias("failed"),
        weighted_rate(failed, inspected).alias("weighted_rate"), F.avg(row_rate).alias("mean_rate"),
        F.count(row_rate).alias("n"), F.sum(row_rate).alias("_s"))
    overall = groups.agg((F.sum("_s") / F.sum("n")).alias("v")).scalar()
    return groups.select(*dims, "inspected", "failed", "weighted_rate", "mean_rate", "n",
                         (F.col("n") < min_group).alias("low_n"), overall.alias("overall_mean"))


def mean_by(df: DataFrame, dims: Sequence[str | Column], rate: str, min_group: int = 0) -> DataFrame:
    """Mean of row rates per dimension with n and a low-n flag."""
    return df.where(F.col(rate).isNotNull()).groupBy(*dims).agg(
        F.avg(rate).alias("mean_rate"), F.count("*").alias("n")).withColumn("low_n", F.col("n") < min_group)


def cost_by(df: DataFrame, dims: Sequence[str | Column], cost: str) -> DataFrame:
    """Total and mean cost, and number of events per dimension."""
    return df.groupBy(*dims).agg(
        F.sum(cost).alias("total_cost"), F.avg(cost).alias("mean_cost"), F.count("*").alias("n"))


def conditional_share(cond: Column) -> Column:
    """Percentage of rows for which a condition holds, null for no rows."""
    return ratio(F.sum(F.when(cond, 1).otherwise(0)), F.count("*")) * 100


def scalar_of(df: DataFrame, expr: Column) -> Column:
    """An ungrouped aggregate as a scalar subquery column: evaluated once, no join."""
    return df.agg(expr.alias("v")).scalar()


def scalars_of(df: DataFrame, exprs: Mapping[str, Column]) -> Column:
    """Several ungrouped aggregates as one struct-valued scalar subquery."""
    one = df.agg(*[e.alias(n) for n, e in exprs.items()])
    return one.select(F.struct(*exprs).alias("v")).scalar()


def matrix(df: DataFrame, rows: Sequence[str | Column], col: str, values: Sequence, measure: Column,
           fill: float | None = 0) -> DataFrame:
    """Pivot with a declared list of columns (no extra pass to find them)."""
    out = df.groupBy(*rows).pivot(col, list(values)).agg(measure)
    return out if fill is None else out.fillna(fill, subset=[str(v) for v in values])


def share_within(df: DataFrame, group: Sequence[str], value: str, out: str = "share") -> DataFrame:
    """Share of a value within its group, on an already aggregated frame."""
    return df.withColumn(out, ratio(F.col(value), F.sum(value).over(W.partitionBy(*group))))


def stacked(df: DataFrame, group: Sequence[str], order: str, value: str) -> DataFrame:
    """Offset below each segment of a stacked bar, on an aggregated frame (few rows per group)."""
    below = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("offset", F.coalesce(F.sum(value).over(below), F.lit(0)))


def frequency(df: DataFrame, col: str | Column, n: int | None = None) -> DataFrame:
    """Frequency table in descending order, ties by value; optionally the first n."""
    name = col if isinstance(col, str) else "value"
    key = F.col(col) if isinstance(col, str) else col
    out = df.groupBy(key.alias(name)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(name))
    return out.limit(n) if n else out


def last_months(df: DataFrame, month: str, n: int) -> DataFrame:
    """Rows of the last n distinct months present (months are few; rows join by semi join)."""
    latest = df.select(month).where(F.col(month).isNotNull()).distinct().orderBy(F.desc(month)).limit(n)
    return df.join(latest, month, "left_semi")
