"""Staging layer: one frame per source with typed, canonical columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.functions.exprs import clock_bucket, flag, in_clock_window
from linegauge.operators.dedup import keep_first

# The working windows of the two shifts.
SHIFT_WINDOWS = [("Shift A", "06:00:00", "13:59:59"), ("Shift B", "14:00:00", "21:59:59")]
DAY_WINDOW = ("06:00:00", "21:59:59")


def machines(raw: DataFrame) -> DataFrame:
    return raw.withColumn("age_years", F.col("age_years").cast("int"))


def operators(raw: DataFrame) -> DataFrame:
    """The certificate column holds Yes / No and becomes a boolean."""
    return raw.withColumns({"hire_date": F.col("hire_date").cast("date"),
                            "welding_cert_current": F.col("welding_cert_current").cast("boolean")})


def lots(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("lot_id_clean").alias("lot_id"), "lot_id_raw", "supplier", "material_type",
        F.col("receipt_date").cast("date").alias("receipt_date"), "cert_status",
        F.col("quantity_lbs").cast("int").alias("quantity_lbs"),
        F.col("unit_cost_per_lb").cast("double").alias("unit_cost_per_lb"))


def parts(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"std_labor_hrs": F.col("std_labor_hrs").cast("double"),
                            "unit_price": F.col("unit_price").cast("double"),
                            "requires_welding": F.col("requires_welding").cast("boolean")})


def production_orders(raw: DataFrame) -> DataFrame:
    """Canonical ids beside their raw form; a missing shift follows from the start time."""
    start = F.col("actual_start").cast("timestamp")
    return raw.select(
        "work_order_id", F.col("part_number_clean").alias("part_number"), "part_number_raw", "customer",
        F.col("quantity_ordered").cast("int").alias("quantity_ordered"), "machine_id",
        F.col("operator_id_clean").alias("operator_id"), "operator_id_raw",
        F.coalesce("shift_code", clock_bucket(start, SHIFT_WINDOWS)).alias("shift_code"),
        F.col("lot_id_clean").alias("lot_id"), "lot_id_raw",
        F.col("order_date").cast("date").alias("order_date"),
        F.col("scheduled_start").cast("timestamp").alias("scheduled_start"), start.alias("actual_start"),
        "complexity", "material_type", F.col("requires_welding").cast("boolean").alias("requires_welding"),
        F.col("std_labor_hrs").cast("double").alias("std_labor_hrs"))


def inspections(raw: DataFrame, order: tuple = ("inspection_id",)) -> DataFrame:
    """One record per work order: the first by inspection id, compared as text by default."""
    when = F.col("inspection_date").cast("timestamp")
    typed = raw.select(
        "inspection_id", "work_order_id", when.alias("inspection_date"), "inspector_id",
        *[F.col(c).cast("int").alias(c) for c in ("quantity_inspected", "quantity_passed", "quantity_failed")],
        F.col("defect_code_clean").alias("defect_code"), "defect_code_raw", "disposition", "notes",
        flag(~in_clock_window(when, *DAY_WINDOW)).alias("is_anomalous_timestamp"))
    return keep_first(typed, ["work_order_id"], *order)


def scrap_events(raw: DataFrame) -> DataFrame:
    money = ("material_cost_per_unit", "labor_cost_per_unit", "total_scrap_cost")
    return raw.select(
        "scrap_id", "work_order_id", "inspection_id", F.col("scrap_date").cast("timestamp").alias("scrap_date"),
        "machine_id", "operator_id", "shift_code", "material_type", "lot_id",
        F.col("scrap_reason_clean").alias("scrap_reason"), "scrap_reason_raw",
        F.col("defect_code_clean").alias("defect_code"),
        *[F.col(c).cast("int").alias(c) for c in ("quantity_scrapped", "quantity_reworked")],
        *[F.col(c).cast("double").alias(c) for c in money])


STAGING = {
    "machines": machines,
    "operators": operators,
    "material_lots": lots,
    "part_catalog": parts,
    "production_orders": production_orders,
    "inspection_records": inspections,
    "scrap_events": scrap_events,
}


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(raw[name]) for name, build in STAGING.items() if name in raw}
