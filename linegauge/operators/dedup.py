"""Keep-first, duplicate groups, full-row duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linegauge.operators.prefix import same_keys


def keep_first(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """First row of every key by ``order`` (nulls last).

    Spark prunes to one row per key inside every input task before the shuffle
    (partial group limit), so a key with a third of the rows sends one row per task.
    """
    exprs = [F.asc_nulls_last(o) if isinstance(o, str) else o for o in order]
    rn = F.row_number().over(W.partitionBy(*keys).orderBy(*exprs))
    return df.withColumn("_rn", rn).where("_rn <= 1").drop("_rn")


def top_per_group(df: DataFrame, keys: Sequence[str], n: int, *order: Column) -> DataFrame:
    """First n rows of every key with their rank; same pruning as keep_first."""
    rn = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rn).where(F.col("rank") <= n)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups of more than one row with their size (counted map-side first)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def mark_duplicates(df: DataFrame, keys: Sequence[str], out: str = "is_duplicate") -> DataFrame:
    """Flag every member of a duplicate group.

    Group sizes are aggregated and joined back; a hot key makes one skewed join partition,
    which AQE splits, instead of one window over all its rows.
    """
    sizes = df.groupBy(*keys).agg((F.count("*") > 1).alias(out))
    return same_keys(df, sizes, list(keys))


def duplicate_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: all rows, rows in duplicate groups, distinct groups."""
    sizes = df.groupBy(*(keys or df.columns)).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)), F.lit(0)).alias("dup_rows"),
        F.count("*").alias("distinct_rows"))
