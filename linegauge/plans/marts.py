"""Marts: defect rates per order, scrap summary per event, scorecard per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.functions.exprs import all_of, flag
from linegauge.operators.quantiles import exact_quantiles
from linegauge.operators.rates import conditional_share, scalar_of


def press_brake_second_shift() -> Column:
    """Literal reading of the published flag: no machine carries this type name, so it is never set."""
    return all_of(F.col("machine_type") == "Press Brake", F.col("shift_code") == "Shift B")


def bending_second_shift() -> Column:
    """The same pattern by the type name the data uses."""
    return all_of(F.col("machine_type") == "Bending", F.col("shift_code") == "Shift B")


def pattern_flags(p1: Callable[[], Column] = press_brake_second_shift) -> dict[str, Column]:
    return {
        "is_p1_combination": p1(),
        "is_p2_supplier": flag(F.col("supplier") == "Supplier C"),
        "is_p3_complexity": flag(F.col("complexity") == "High"),
        "is_p4_cert_mismatch": F.col("welding_cert_mismatch"),
    }


def defect_rates(enriched: DataFrame, p1: Callable[[], Column] = press_brake_second_shift) -> DataFrame:
    """One wide row per work order with calendar parts, target and pattern flags."""
    return enriched.withColumns({
        "order_month": F.date_trunc("month", "actual_start"),
        "order_year": F.year("actual_start"),
        "order_month_num": F.month("actual_start"),
        "defect_flag": flag(F.col("quantity_failed") > 0),
        **pattern_flags(p1)})


def scrap_summary(costs: DataFrame, p1: Callable[[], Column] = press_brake_second_shift) -> DataFrame:
    """One row per scrap event with the cost split and calendar parts."""
    return costs.withColumns({
        "scrap_year": F.year("scrap_date"),
        "scrap_month_num": F.month("scrap_date"),
        "material_cost_total": F.round(F.col("material_cost_per_unit") * F.col("quantity_scrapped"), 2),
        "labor_cost_total": F.round(F.col("labor_cost_per_unit") * F.col("quantity_scrapped"), 2),
        **pattern_flags(p1)}).drop("order_date", "actual_start")


OPERATOR_COLUMNS = ["operator_id", "operator_name", "cert_level", "specialization", "welding_cert_current",
                    "hire_date"]


def operator_performance(rates: DataFrame, scrap: DataFrame) -> DataFrame:
    """One row per operator: volume, mean and median rate, gap to the fleet, attributed cost."""
    rated = rates.where(F.col("defect_rate").isNotNull())
    count_of = lambda c: F.sum(flag(F.col(c)).cast("int"))
    stats = rated.groupBy(*OPERATOR_COLUMNS).agg(
        F.count("*").alias("total_jobs"),
        count_of("requires_welding").alias("total_welding_jobs"),
        count_of("welding_cert_mismatch").alias("cert_mismatch_job_count"),
        F.round(F.avg("defect_rate"), 4).alias("mean_defect_rate"), F.sum("defect_rate").alias("_rates"),
        F.sum("quantity_failed").alias("total_quantity_failed"),
        count_of("defect_flag").alias("jobs_with_defect"),
        F.round(conditional_share(F.col("defect_flag")), 1).alias("pct_jobs_with_defect"))
    medians = exact_quantiles(rated, ["operator_id"], "defect_rate", {"_m": 0.5})
    cost = scrap.groupBy("operator_id").agg(F.sum("total_scrap_cost").alias("_cost"))
    # the fleet mean follows from the operators' sums; the orders are not read again
    fleet = scalar_of(stats, F.round(F.sum("_rates") / F.sum("total_jobs"), 4))
    return (stats.join(medians, "operator_id").join(cost, "operator_id", "left")
            .withColumn("peer_mean_defect_rate", fleet)
            .select(*OPERATOR_COLUMNS, "total_jobs", "total_welding_jobs", "cert_mismatch_job_count",
                    "mean_defect_rate", F.round("_m", 4).alias("median_defect_rate"), "total_quantity_failed",
                    "jobs_with_defect", "pct_jobs_with_defect", "peer_mean_defect_rate",
                    F.round(F.col("mean_defect_rate") - F.col("peer_mean_defect_rate"), 4)
                    .alias("defect_rate_vs_peer"),
                    F.coalesce("_cost", F.lit(0.0)).alias("total_scrap_cost_attributed")))
