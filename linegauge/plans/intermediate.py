"""Intermediate layer: the inspected-order spine, its dimensions, and scrap costs in context.

Joins carry no hints: dimensions are broadcast while Spark measures them below its
threshold, fact-to-fact joins shuffle on the work order and AQE splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.functions.exprs import all_of, hours_crossed, ratio

ORDER_COLUMNS = ["work_order_id", "part_number", "customer", "machine_id", "operator_id", "shift_code", "lot_id",
                 "complexity", "material_type", "requires_welding", "order_date", "actual_start", "quantity_ordered",
                 "std_labor_hrs"]
INSPECTION_COLUMNS = ["inspection_id", "inspection_date", "inspector_id", "quantity_inspected", "quantity_passed",
                      "quantity_failed", "defect_code", "disposition", "is_anomalous_timestamp"]


def orders_with_inspections(orders: DataFrame, inspections: DataFrame) -> DataFrame:
    """One row per inspected work order, with defect rate and start delay in hour boundaries."""
    return (orders.select(*ORDER_COLUMNS, "scheduled_start")
            .join(inspections.select("work_order_id", *INSPECTION_COLUMNS), "work_order_id")
            .withColumns({"defect_rate": ratio("quantity_failed", "quantity_inspected"),
                          "schedule_variance_hrs": hours_crossed("scheduled_start", "actual_start")})
            .drop("scheduled_start"))


def orders_enriched(spine: DataFrame, machines: DataFrame, operators: DataFrame, lots: DataFrame) -> DataFrame:
    """Machine and operator must exist; the lot may be missing."""
    m = machines.select("machine_id", "machine_name", "machine_type", F.col("age_years").alias("machine_age_years"),
                        F.col("location").alias("machine_location"))
    o = operators.select("operator_id", "operator_name", F.col("shift").alias("operator_home_shift"), "cert_level",
                         "specialization", "welding_cert_current", "hire_date")
    lot = lots.select("lot_id", "supplier", F.col("cert_status").alias("lot_cert_status"),
                      F.col("receipt_date").alias("lot_receipt_date"), "unit_cost_per_lb")
    mismatch = all_of(F.col("requires_welding"), ~F.col("welding_cert_current"))
    return (spine.join(m, "machine_id").join(o, "operator_id").join(lot, "lot_id", "left")
            .withColumn("welding_cert_mismatch", mismatch))


SCRAP_COLUMNS = ["scrap_id", "work_order_id", "inspection_id", "scrap_date", "scrap_reason", "defect_code",
                 "quantity_scrapped", "quantity_reworked", "material_cost_per_unit", "labor_cost_per_unit",
                 "total_scrap_cost"]
CONTEXT_COLUMNS = ["work_order_id", "part_number", "customer", "machine_id", "machine_name", "machine_type",
                   "machine_age_years", "operator_id", "operator_name", "shift_code", "complexity", "material_type",
                   "supplier", "lot_id", "lot_cert_status", "welding_cert_current", "welding_cert_mismatch",
                   "order_date", "actual_start"]


def scrap_costs(scrap: DataFrame, enriched: DataFrame) -> DataFrame:
    """Scrap events with the context of their order, joined on the order: the inspection an
    event names may be gone."""
    context = enriched.select(*CONTEXT_COLUMNS, F.col("defect_rate").alias("order_defect_rate"))
    return (scrap.select(*SCRAP_COLUMNS).join(context, "work_order_id")
            .withColumn("scrap_month", F.date_trunc("month", "scrap_date")))
