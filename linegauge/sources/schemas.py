"""Column contracts of the source extracts."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Source:
    """One extract: the system it comes from, its columns, key and content rules."""

    system: str
    schema: str
    key: str
    ignore_in_duplicates: tuple[str, ...] = field(default=())


SOURCES: dict[str, Source] = {
    "machines": Source(
        "mes", "machine_id string, machine_name string, machine_type string, age_years int, location string",
        "machine_id", ("machine_id",)),
    "operators": Source(
        "hr", "operator_id string, operator_name string, shift string, hire_date date, cert_level string, "
              "specialization string, welding_cert_current string",
        "operator_id", ("operator_id",)),
    "material_lots": Source(
        "materials", "lot_id_clean string, lot_id_raw string, supplier string, material_type string, "
                     "receipt_date date, cert_status string, quantity_lbs int, unit_cost_per_lb double",
        "lot_id_clean", ("lot_id_clean",)),
    "part_catalog": Source(
        "erp", "part_number string, customer string, material_type string, complexity string, "
               "primary_machine string, std_labor_hrs double, unit_price double, requires_welding boolean",
        "part_number", ("part_number",)),
    "production_orders": Source(
        "erp", "work_order_id string, part_number_raw string, part_number_clean string, customer string, "
               "quantity_ordered int, machine_id string, operator_id_raw string, operator_id_clean string, "
               "shift_code string, lot_id_raw string, lot_id_clean string, order_date date, "
               "scheduled_start timestamp, actual_start timestamp, complexity string, material_type string, "
               "requires_welding boolean, std_labor_hrs double",
        "work_order_id", ("work_order_id",)),
    "inspection_records": Source(
        "qms", "inspection_id string, work_order_id string, inspection_date timestamp, inspector_id string, "
               "quantity_inspected int, quantity_passed int, quantity_failed int, defect_code_raw string, "
               "defect_code_clean string, disposition string, notes string",
        "inspection_id", ("inspection_id", "inspection_date")),
    "scrap_events": Source(
        "qms", "scrap_id string, work_order_id string, inspection_id string, scrap_date timestamp, "
               "machine_id string, operator_id string, shift_code string, material_type string, lot_id string, "
               "defect_code_clean string, quantity_scrapped int, quantity_reworked int, scrap_reason_raw string, "
               "scrap_reason_clean string, material_cost_per_unit double, labor_cost_per_unit double, "
               "total_scrap_cost double",
        "scrap_id", ("scrap_id",)),
}
