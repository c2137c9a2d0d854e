"""From source extracts to marts, and the contracts every layer must meet."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.functions.codes import DEFECT_SPELLINGS, SCRAP_REASON_SPELLINGS
from linegauge.operators import quality as q
from linegauge.plans import intermediate, marts
from linegauge.plans.staging import stage_all
from linegauge.sources.readers import read_sources
from linegauge.sources.sinks import publish


def build_layers(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All layers by name. Lazy; the enriched orders feed both fact marts."""
    t = stage_all(raw)
    spine = intermediate.orders_with_inspections(t["production_orders"], t["inspection_records"])
    enriched = intermediate.orders_enriched(spine, t["machines"], t["operators"], t["material_lots"])
    costs = intermediate.scrap_costs(t["scrap_events"], enriched)
    rates, scrap = marts.defect_rates(enriched), marts.scrap_summary(costs)
    return {
        **{f"stg_{n}": df for n, df in t.items()},
        "int_orders_with_inspections": spine, "int_orders_enriched": enriched, "int_scrap_costs": costs,
        "mart_defect_rates": rates, "mart_scrap_summary": scrap,
        "mart_operator_performance": marts.operator_performance(rates, scrap)}


def build_warehouse(spark: SparkSession, root: str, stored: bool = False, suffix: str = "",
                    tables_root: str | None = None) -> dict[str, DataFrame]:
    """Read the extracts, publish staging and intermediate as views and the marts as views or tables."""
    raw = read_sources(spark, root, suffix=suffix)
    layers = build_layers(raw)
    if stored:
        layers["int_orders_enriched"].persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {n: publish(df, n, stored and n.startswith("mart_"), tables_root and f"{tables_root}/{n}")
                for n, df in layers.items()}
    finally:
        if stored:
            layers["int_orders_enriched"].unpersist()


def contracts(t: dict[str, DataFrame]) -> DataFrame:
    """All data contracts of the layers as one result table (check, table, column, total, failed, status)."""
    keys = {"stg_machines": "machine_id", "stg_operators": "operator_id", "stg_material_lots": "lot_id",
            "stg_part_catalog": "part_number", "stg_production_orders": "work_order_id",
            "stg_inspection_records": "inspection_id", "stg_scrap_events": "scrap_id"}
    flags = ["is_p1_combination", "is_p2_supplier", "is_p3_complexity", "is_p4_cert_mismatch"]
    required = {
        **{n: [k] for n, k in keys.items()},
        "int_orders_with_inspections": ["work_order_id", "inspection_id"],
        "int_orders_enriched": ["work_order_id", "machine_name", "operator_name", "welding_cert_mismatch"],
        "int_scrap_costs": ["scrap_id", "total_scrap_cost", "scrap_month"],
        "mart_defect_rates": ["work_order_id", "inspection_id", "defect_flag", *flags, "quantity_inspected",
                              "quantity_passed", "quantity_failed"],
        "mart_scrap_summary": ["scrap_id", "total_scrap_cost", "material_cost_total", "labor_cost_total", *flags],
        "mart_operator_performance": ["operator_id", "total_jobs", "mean_defect_rate", "peer_mean_defect_rate",
                                      "defect_rate_vs_peer", "total_scrap_cost_attributed"]}
    grain = {**{n: [k] for n, k in keys.items()},
             "int_orders_with_inspections": ["work_order_id", "inspection_id"],
             "int_orders_enriched": ["work_order_id"], "int_scrap_costs": ["scrap_id"],
             "mart_defect_rates": ["work_order_id", "inspection_id"], "mart_scrap_summary": ["scrap_id"],
             "mart_operator_performance": ["operator_id"]}
    defects, reasons = list(DEFECT_SPELLINGS), list(SCRAP_REASON_SPELLINGS)
    accepted = [
        ("stg_material_lots", "cert_status", ["Certified", "Conditional", "Missing"], None),
        ("stg_part_catalog", "complexity", ["Low", "Medium", "High"], None),
        ("stg_production_orders", "shift_code", ["Shift A", "Shift B"], F.col("shift_code").isNotNull()),
        ("stg_production_orders", "complexity", ["Low", "Medium", "High"], None),
        ("stg_inspection_records", "defect_code", defects, None),
        ("stg_inspection_records", "disposition", ["Pass", "Scrap", "Rework", "Use-As-Is"], None),
        ("stg_scrap_events", "scrap_reason", reasons, None),
        ("stg_scrap_events", "defect_code", defects, None)]
    parents = [("stg_production_orders", "part_number", "stg_part_catalog"),
               ("stg_production_orders", "machine_id", "stg_machines"),
               ("stg_production_orders", "operator_id", "stg_operators"),
               ("stg_inspection_records", "work_order_id", "stg_production_orders"),
               ("stg_scrap_events", "work_order_id", "stg_production_orders")]
    col = F.col
    parts = [q.not_null(t[n], n, cols) for n, cols in required.items()]
    parts += [q.unique(t[n], n, c) for n, cols in grain.items() for c in cols]
    parts += [q.accepted_values(t[n], n, c, values, where) for n, c, values, where in accepted]
    parts += [q.relationship(t[n], n, c, t[p], c) for n, c, p in parents]
    parts += [
        q.expression_holds(t["mart_defect_rates"], "mart_defect_rates", "passed + failed = inspected",
                           col("quantity_passed") + col("quantity_failed") == col("quantity_inspected")),
        q.expression_holds(t["mart_scrap_summary"], "mart_scrap_summary", "material + labor = total",
                           q.close_to(col("material_cost_total") + col("labor_cost_total"),
                                      col("total_scrap_cost")))]
    return reduce(DataFrame.unionByName, parts)
