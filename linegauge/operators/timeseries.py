"""Monthly series: trend, autocorrelation, seasonality, period comparison.

Every window here runs over a series that is already aggregated to calendar months.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linegauge.functions.exprs import change_arrow, change_verdict, month_start, relative_change


def monthly_counts(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Records per calendar month; rows without a date are left out."""
    return df.where(F.col(ts).isNotNull()).groupBy(*keys, month_start(ts).alias("month")).agg(
        F.count("*").alias("records"))


def indexed(series: DataFrame, month: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Position of each month (0..n-1) and the value of the month before."""
    order = W.partitionBy(*keys).orderBy(month)
    return series.select("*", (F.row_number().over(order) - 1).alias("t"), F.lag(value).over(order).alias("previous"))


def trend(series: DataFrame, month: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of the value over the month index."""
    points = indexed(series, month, value, keys)
    return points.groupBy(*keys).agg(
        F.regr_slope(value, "t").alias("slope"), F.regr_intercept(value, "t").alias("intercept"),
        F.corr(F.col(value).cast("double"), F.col("t").cast("double")).alias("r"), F.count("*").alias("n"))


def lag1(series: DataFrame, month: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Lag-1 autocorrelation over available pairs."""
    points = indexed(series, month, value, keys).where(F.col("previous").isNotNull())
    return points.groupBy(*keys).agg(
        F.corr(F.col(value).cast("double"), F.col("previous").cast("double")).alias("acf1"),
        F.count("*").alias("pairs"))


def series_summary(series: DataFrame, month: str, value: str, keys: Sequence[str] = (),
                   min_months: int = 24) -> DataFrame:
    """Mean, median, spread, extremes with their month, slope, lag-1 and seasonal strength."""
    points = indexed(series, month, value, keys)
    x, p = F.col(value).cast("double"), F.col("previous").cast("double")
    first_on_tie = lambda v: F.struct(v, F.unix_date(F.col(month)))
    base = points.groupBy(*keys).agg(
        F.count("*").alias("months"), F.avg(x).alias("mean"), F.median(x).alias("median"),
        F.stddev_samp(x).alias("std"), F.var_samp(x).alias("_var"),
        F.min(x).alias("min"), F.min_by(month, first_on_tie(x)).alias("min_month"),
        F.max(x).alias("max"), F.min_by(month, first_on_tie(-x)).alias("max_month"),
        F.regr_slope(x, F.col("t")).alias("slope"),
        F.corr(F.when(p.isNotNull(), x), p).alias("acf1"))
    of_year = series.groupBy(*keys, F.month(month).alias("_moy")).agg(F.avg(x).alias("_mean"))
    between = of_year.groupBy(*keys).agg(F.var_samp("_mean").alias("_between"))
    # one row per key on both sides
    if keys:
        both = base.join(between, list(keys))
    else:
        both = base.withColumn("_between", between.scalar())
    seasonal = F.when((F.col("months") >= min_months) & (F.col("_var") > 0), F.col("_between") / F.col("_var"))
    return both.select(
        *keys, "months", "mean", "median", "std",
        F.when(F.col("mean") != 0, F.col("std") / F.col("mean")).alias("cv"),
        "min", "min_month", "max", "max_month", "slope", "acf1", seasonal.alias("seasonal_strength"))


def period_windows(last_month: Column, last_day: Column, month: Column, ts: Column) -> dict[tuple[str, str], Column]:
    """Conditions for current and prior week, month and trailing twelve months.

    The week ends before the midnight of the last day (that day is left out), the prior
    week is the seven days before. The prior twelve months end one year before the last
    month.
    """
    week = F.expr("INTERVAL 7 DAYS")
    return {
        ("week", "current"): (ts >= last_day - week) & (ts < last_day),
        ("week", "prior"): (ts >= last_day - week - week) & (ts < last_day - week),
        ("month", "current"): month == last_month,
        ("month", "prior"): month == F.add_months(last_month, -1),
        ("ttm", "current"): month >= F.add_months(last_month, -11),
        ("ttm", "prior"): month.between(F.add_months(last_month, -23), F.add_months(last_month, -12)),
    }


def compare_periods(df: DataFrame, windows: Mapping[tuple[str, str], Column],
                    measures: Mapping[str, Column]) -> DataFrame:
    """One row per (window, measure sums): every window in one pass of conditional sums.

    A row may lie in several windows; nothing is exploded and nothing but one row per task
    is shuffled.
    """
    aggs = [F.coalesce(F.sum(F.when(cond, m)), F.lit(0)).cast("double").alias(f"{w}|{p}|{name}")
            for (w, p), cond in windows.items() for name, m in measures.items()]
    wide = df.agg(*aggs)
    names = list(measures)
    rows = [F.struct(F.lit(w).alias("window"), F.lit(p).alias("period"),
                     *[F.col(f"`{w}|{p}|{n}`").alias(n) for n in names]) for w, p in windows]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def change_cards(periods: DataFrame, measures: Mapping[str, tuple[Column, bool]]) -> DataFrame:
    """Current against prior per window and measure, with change, arrow and verdict.

    ``periods`` holds one row per (window, period); ``measures`` maps a name to its value
    expression and whether a lower value is better.
    """
    parts = []
    for name, (expr, lower) in measures.items():
        parts.append(F.struct(F.lit(name).alias("measure"), expr.cast("double").alias("value"),
                              F.lit(lower).alias("lower")))
    long = periods.select("window", "period", F.explode(F.array(*parts)).alias("m")).select(
        "window", "period", "m.*")
    pair = long.groupBy("window", "measure", "lower").agg(
        F.max(F.when(F.col("period") == "current", F.col("value"))).alias("cur"),
        F.max(F.when(F.col("period") == "prior", F.col("value"))).alias("prior"))
    good_low, good_high = change_verdict("cur", "prior", True), change_verdict("cur", "prior", False)
    return pair.select(
        "window", "measure", "cur", "prior", relative_change("cur", "prior").alias("change"),
        change_arrow("cur", "prior").alias("arrow"),
        F.when(F.col("lower"), good_low).otherwise(good_high).alias("verdict"))
