"""KPI cards and chart tables of the quality dashboard, from the two fact marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.functions.exprs import ratio, ratio_or_zero
from linegauge.operators.joins import month_spine
from linegauge.operators.rates import scalars_of, share_within, stacked
from linegauge.operators.timeseries import change_cards, compare_periods, period_windows


def kpi_cards(rates: DataFrame, scrap: DataFrame, order_ts: str = "actual_start", order_month: str = "order_month",
              scrap_ts: str = "scrap_date", scrap_month: str = "scrap_month", inspected: str = "quantity_inspected",
              failed: str = "quantity_failed", scrapped: str = "quantity_scrapped",
              cost: str = "total_scrap_cost") -> DataFrame:
    """Six measures x {week, month, trailing 12 months}: current, prior, change, verdict.

    Both facts are read once; the windows follow the last order in the data.
    """
    last = scalars_of(rates, {"m": F.max(F.col(order_month)), "d": F.date_trunc("day", F.max(F.col(order_ts)))})
    m, d = F.col("_last")["m"], F.col("_last")["d"]
    orders = compare_periods(rates.withColumn("_last", last), period_windows(m, d, F.col(order_month), F.col(order_ts)),
                             {"qi": F.col(inspected), "qf": F.col(failed)})
    events = compare_periods(scrap.withColumn("_last", last), period_windows(m, d, F.col(scrap_month), F.col(scrap_ts)),
                             {"ps": F.col(scrapped), "co": F.col(cost), "ev": F.lit(1)})
    both = orders.join(events, ["window", "period"])  # six rows on each side
    return change_cards(both, {
        "parts_inspected": (F.col("qi"), False),
        "defects": (F.col("qf"), True),
        "defect_rate": (ratio_or_zero("qf", "qi"), True),
        "parts_scrapped": (F.col("ps"), True),
        "scrap_cost": (F.col("co"), True),
        "cost_per_event": (F.col("co") / F.greatest(F.col("ev"), F.lit(1)), True)})


def trailing(df: DataFrame, month: str, months: int = 12) -> DataFrame:
    """Rows of the trailing months, counted back from the last month present."""
    last = df.agg(F.max(month).alias("v")).scalar()
    return df.where(F.col(month) >= F.add_months(last, 1 - months))


def monthly_rate(df: DataFrame, month: str, inspected: str, failed: str, months: int = 12) -> DataFrame:
    """Monthly defects and rate of the trailing months with their mean rate."""
    out = trailing(df, month, months).groupBy(month).agg(F.sum(inspected).alias("inspected"),
                                                         F.sum(failed).alias("failed"))
    out = out.withColumn("rate", ratio("failed", "inspected"))
    return out.withColumn("mean_rate", out.agg(F.avg("rate").alias("v")).scalar())


def monthly_stack(df: DataFrame, month: str, dim: str, value: str, months: int = 12) -> DataFrame:
    """Month x dimension totals with stack offsets and shares of the month."""
    out = trailing(df, month, months).groupBy(month, dim).agg(F.sum(value).alias("value"))
    return stacked(share_within(out, [month], "value"), [month], dim, "value")


def rate_lines(df: DataFrame, month: str, dim: str, inspected: str, failed: str, months: int = 12) -> DataFrame:
    """Monthly rate per dimension value on all months of the window; a missing month has a null rate."""
    rows = trailing(df, month, months).where(F.col(dim).isNotNull())
    seen = rows.groupBy(F.col(month).alias("_m"), F.col(dim).alias("_d")).agg(
        F.sum(inspected).alias("inspected"), F.sum(failed).alias("failed"))
    spine = month_spine(rows.select(month).distinct(), month)
    # every dimension value gets the list of months: one array, no join between the two
    all_months = spine.agg(F.collect_set(month).alias("v")).scalar()
    axis = seen.select("_d").distinct().select(F.col("_d").alias(dim), F.explode(all_months).alias(month))
    return (axis.join(seen, (axis[month] == seen["_m"]) & (axis[dim] == seen["_d"]), "left").drop("_m", "_d")
            .withColumn("rate", ratio("failed", "inspected")))


def cost_split(scrap: DataFrame, month: str, material: str, labor: str) -> DataFrame:
    """Material and labor share of the monthly cost."""
    out = scrap.groupBy(month).agg(F.sum(material).alias("material"), F.sum(labor).alias("labor"))
    total = F.col("material") + F.col("labor")
    return out.withColumns({"material_share": ratio("material", total), "labor_share": ratio("labor", total)})
