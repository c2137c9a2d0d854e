"""Join shapes: integrity, as-of eligibility, lookups, calendar spines, period matrices."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def key_match(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: rows, distinct keys, orphan keys, row and distinct match rate (percent).

    The child is reduced to counts per key before the join, so a hot key is one row.
    """
    keys = child.groupBy(F.col(child_key).alias("_k")).agg(F.count("*").alias("_n"))
    parents = parent.where(F.col(parent_key).isNotNull()).select(F.col(parent_key).alias("_p")).distinct()
    hit = F.col("_p").isNotNull()
    known = F.col("_k").isNotNull()
    counted = keys.join(parents, F.col("_k") == F.col("_p"), "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).alias("matched_rows"),
        F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("null_rows"),
        F.count(F.when(known, 1)).alias("distinct_keys"),
        F.count(F.when(known & ~hit, 1)).alias("orphan_keys"),
        F.min(F.when(known & ~hit, F.col("_k"))).alias("sample_orphan"))
    return counted.select(
        "*",
        (F.col("matched_rows") * 100.0 / F.greatest("total_rows", F.lit(1))).alias("row_match_pct"),
        ((F.col("distinct_keys") - F.col("orphan_keys")) * 100.0
         / F.greatest("distinct_keys", F.lit(1))).alias("distinct_match_pct"))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, each with its number of rows."""
    keys = (child.where(F.col(child_key).isNotNull())
            .groupBy(child_key).agg(F.count("*").alias("n_rows")))
    return keys.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def orphan_sample(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, n: int = 6) -> DataFrame:
    """The first ``n`` child keys without a parent, each with its number of rows."""
    return orphans(child, child_key, parent, parent_key).orderBy(child_key).limit(n)


def integrity_report(tables: Mapping[str, DataFrame], relations: Sequence[tuple[str, str, str, str]], n: int = 6) -> DataFrame:
    """Per relation (child, key, parent, key): match rates, orphan keys and the first ``n`` of them."""
    rows = []
    for child, child_key, parent, parent_key in relations:
        sides = tables[child], child_key, tables[parent], parent_key
        first = orphan_sample(*sides, n=n).agg(F.array_join(F.transform(F.array_sort(F.collect_list(child_key)), lambda k: k.cast("string")), ",")
                                               .alias("v"))
        rows.append(key_match(*sides).select(
            F.lit(f"{child}.{child_key} -> {parent}.{parent_key}").alias("relation"), "row_match_pct", "distinct_match_pct", "orphan_keys",
            F.coalesce(first.scalar(), F.lit("")).alias("sample")))
    return reduce(lambda a, b: a.unionByName(b), rows)


def in_segment(events: DataFrame, orders: DataFrame, key: str, segment: Column) -> DataFrame:
    """Events whose order belongs to a segment."""
    return events.join(orders.where(segment).select(key), key, "left_semi")


def with_total(df: DataFrame, facts: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Left join to a total per key, 0 where there is none. Facts are summed before the join."""
    totals = facts.groupBy(key).agg(F.sum(value).alias(out))
    return df.join(totals, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))


def join_first(left: DataFrame, right: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """Left join after reducing the right side to its first row per key."""
    from linegauge.operators.dedup import keep_first

    return left.join(keep_first(right, [key], *order), key, "left")


def join_renamed(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y"),
                 how: str = "left") -> DataFrame:
    """Join of frames that share column names beside the key; both get a suffix."""
    shared = (set(left.columns) & set(right.columns)) - {key}
    rename = lambda df, s: df.select(*[F.col(c).alias(c + s if c in shared else c) for c in df.columns])
    return rename(left, suffixes[0]).join(rename(right, suffixes[1]), key, how)


def eligible_lots(demand: DataFrame, lots: DataFrame, group: str, demand_day: str, receipt_day: str,
                  lot_id: str, keep: int = 60) -> DataFrame:
    """For every demand row: the newest and the oldest of the ``keep`` latest lots of its
    group received on or before its day, and how many there are.

    Demand rows never meet lots pairwise. Lots are counted per (group, day) and accumulated
    over days; a lot's position in its group then follows from the day's running count and
    its position inside the day, of which only the last ``keep`` matter. Demand rows look up
    their day's running count and the lot at that position: two equi-joins on aggregated
    tables. The day window holds calendar days, not rows.
    """
    lots = lots.where(F.col(group).isNotNull() & F.col(receipt_day).isNotNull())  # others are never eligible
    days = lots.groupBy(group, F.col(receipt_day).alias("_day")).agg(F.count("*").alias("_n"))
    asked = demand.select(group, F.col(demand_day).alias("_day")).distinct()
    calendar = (days.withColumn("_ask", F.lit(False))
                .unionByName(asked.select(group, "_day", F.lit(0).cast("bigint").alias("_n"),
                                          F.lit(True).alias("_ask")))
                .groupBy(group, "_day").agg(F.sum("_n").alias("_n"), F.max("_ask").alias("_ask")))
    run = W.partitionBy(group).orderBy("_day").rowsBetween(W.unboundedPreceding, W.currentRow)
    calendar = calendar.withColumn("_upto", F.sum("_n").over(run))

    newest_first = W.partitionBy(group, receipt_day).orderBy(F.desc(lot_id))
    recent = (lots.select(group, receipt_day, lot_id)
              .withColumn("_back", F.row_number().over(newest_first)).where(F.col("_back") <= keep))
    placed = (recent.join(calendar.where("_n > 0").select(group, F.col("_day").alias(receipt_day), "_upto"),
                          [group, receipt_day])
              .select(group, (F.col("_upto") - F.col("_back") + 1).alias("_pos"), lot_id, receipt_day))

    wanted = calendar.where(F.col("_ask") & (F.col("_upto") > 0)).select(
        group, "_day", F.col("_upto").alias("_newest"),
        F.greatest(F.col("_upto") - keep + 1, F.lit(1)).alias("_oldest"))
    # both positions of a day are looked up by one join with the lots
    ends = wanted.select(group, "_day", "_newest", "_oldest", F.explode(F.array("_newest", "_oldest")).alias("_pos"))
    found = ends.join(placed, [group, "_pos"])
    of = lambda end, c: F.max(F.when(F.col("_pos") == F.col(end), F.col(c)))
    answer = found.groupBy(group, "_day").agg(
        of("_newest", lot_id).alias("newest_lot"), of("_newest", receipt_day).alias("newest_receipt"),
        of("_oldest", lot_id).alias("oldest_lot"), F.max(F.col("_newest") - F.col("_oldest") + 1).alias("eligible"),
    ).withColumnRenamed("_day", demand_day)
    return (demand.join(answer, [group, demand_day], "left")
            .withColumn("eligible", F.coalesce(F.col("eligible"), F.lit(0).cast("bigint"))))


def month_spine(df: DataFrame, month: str) -> DataFrame:
    """Every calendar month between the first and the last month present."""
    ends = df.agg(F.min(month).alias("_a"), F.max(month).alias("_b")).where(F.col("_a").isNotNull())
    return ends.select(F.explode(F.expr("sequence(_a, _b, interval 1 month)")).alias(month))


def on_spine(series: DataFrame, month: str, spine: DataFrame) -> DataFrame:
    """A monthly series on all months of the spine, missing ones null."""
    return spine.join(series, month, "left")


def period_matrix(df: DataFrame, row: str, period: str, value: str, periods: Sequence[str]) -> DataFrame:
    """Row x period matrix ordered by mean value."""
    wide = df.groupBy(row).pivot(period, list(periods)).agg(F.first(value))
    means = df.groupBy(row).agg(F.avg(value).alias("mean_value"))
    return wide.join(means, row)
