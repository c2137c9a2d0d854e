"""From hand-written extracts through every layer, with the edge rows that matter."""

from datetime import date, datetime

import pytest
from conftest import one, rows
from pyspark.sql import functions as F

from linegauge.plans import kpi, marts, warehouse
from linegauge.sources.readers import read_source, read_sources

EXTRACTS = {
    "mes/machines": """machine_id,machine_name,machine_type,age_years,location
M01,Laser Cutter 1,Laser Cutting,3,Bay A
M03,Press Brake 1,Bending,12,Bay B
""",
    "hr/operators": """operator_id,operator_name,shift,hire_date,cert_level,specialization,welding_cert_current
OP001,Ann,Shift A,2020-01-01,Level 1,General,Yes
OP007,Bob,Shift B,2021-01-01,Level 2,Welding,No
OP009,Cid,Shift B,2021-01-01,Level 2,Welding,Yes
""",
    "materials/material_lots": '''lot_id_clean,lot_id_raw,supplier,material_type,receipt_date,cert_status,quantity_lbs,unit_cost_per_lb
LOT-1000,LOT1000,Supplier C,16ga Steel,2024-01-01,Certified,500,1.5
LOT-1001,1001,Supplier A,"1/4"" Plate",2024-01-02,Missing,900,2.5
''',
    "erp/part_catalog": """part_number,customer,material_type,complexity,primary_machine,std_labor_hrs,unit_price,requires_welding
P-1000,Customer A,16ga Steel,High,M01,1.5,20.0,True
P-1001,Customer B,16ga Steel,Low,M03,0.5,30.0,False
""",
    "erp/production_orders": """work_order_id,part_number_raw,part_number_clean,customer,quantity_ordered,machine_id,operator_id_raw,operator_id_clean,shift_code,lot_id_raw,lot_id_clean,order_date,scheduled_start,actual_start,complexity,material_type,requires_welding,std_labor_hrs
WO-1,P1000,P-1000,Customer A,10,M03,Bob,OP007,Shift B,LOT1000,LOT-1000,2024-01-02,2024-01-02 13:50:00,2024-01-02 14:10:00,High,16ga Steel,True,1.5
WO-2,P-1001,P-1001,Customer B,5,M01,OP001,OP001,,,,2024-01-03,,2024-01-03 13:59:59.500000,Low,16ga Steel,False,0.5
WO-3,P-1001,P-1001,Customer B,5,M01,OP001,OP001,,1001,LOT-1001,2024-01-03,2024-01-03 08:00:00,2024-01-03 06:00:00,Low,16ga Steel,False,0.5
WO-4,P-1000,P-1000,Customer A,8,M01,OP009,OP009,,9999,LOT-9999,2024-02-03,2024-02-03 22:00:00,2024-02-03 22:00:00,High,16ga Steel,True,1.5
WO-5,P-1000,P-1000,Customer A,8,M01,OP009,OP009,Shift A,,,2024-02-04,2024-02-04 07:00:00,2024-02-04 07:30:00,High,16ga Steel,True,1.5
""",
    "qms/inspection_records": """inspection_id,work_order_id,inspection_date,inspector_id,quantity_inspected,quantity_passed,quantity_failed,defect_code_raw,defect_code_clean,disposition,notes
INSP-9,WO-1,2024-01-02 17:00:00.123456789,OP001,10,9,1,Burr,Burr,Scrap,
INSP-10,WO-1,2024-01-02 17:05:00.0,OP001,10,6,4,BURR,Burr,Scrap,again
INSP-2,WO-2,2024-01-03 23:00:00.0,OP001,0,0,0,,None,Pass,
INSP-3,WO-3,2024-01-03 21:59:59.0,OP001,5,5,0,OK,None,Pass,
INSP-4,WO-4,2024-02-04 05:59:59.0,OP001,8,6,2,Void,Porosity,Rework,
""",
    "qms/scrap_events": """scrap_id,work_order_id,inspection_id,scrap_date,machine_id,operator_id,shift_code,material_type,lot_id,defect_code_clean,quantity_scrapped,quantity_reworked,scrap_reason_raw,scrap_reason_clean,material_cost_per_unit,labor_cost_per_unit,total_scrap_cost
SCRAP-1,WO-1,INSP-9,2024-01-02 17:00:00,M03,OP007,Shift B,16ga Steel,LOT-1000,Burr,2,0,Setup,SETUP_ERROR,10.38,109.38,239.52
SCRAP-2,WO-1,INSP-10,2024-01-05 17:00:00,M03,OP007,,16ga Steel,,Burr,1,1,Machine,MACHINE_ISSUE,10.0,20.0,30.0
SCRAP-3,WO-5,INSP-77,2024-02-05 17:00:00,M01,OP009,,16ga Steel,,Burr,1,0,TBD,UNKNOWN,1.0,1.0,2.0
SCRAP-4,WO-4,INSP-4,2024-02-05 17:00:00,M01,OP009,,16ga Steel,,Porosity,0,2,,UNKNOWN,1.0,1.0,0.0
""",
}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("extracts")
    for name, text in EXTRACTS.items():
        path = base / f"{name}.csv"
        path.parent.mkdir(exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(base)


@pytest.fixture(scope="module")
def layers(spark, root):
    return warehouse.build_warehouse(spark, root)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_extracts_keep_quotes_and_the_text_none(spark, root):
    lots = by(read_source(spark, root, "material_lots"), "lot_id_clean")
    assert lots["LOT-1001"]["material_type"] == '1/4" Plate'
    insp = by(read_source(spark, root, "inspection_records"), "inspection_id")
    assert insp["INSP-2"]["defect_code_clean"] == "None" and insp["INSP-2"]["defect_code_raw"] is None
    profiled = by(read_source(spark, root, "inspection_records", na_tokens=["None", "N/A"]), "inspection_id")
    assert profiled["INSP-2"]["defect_code_clean"] is None
    assert set(read_sources(spark, root, ["machines", "operators"])) == {"machines", "operators"}
    assert read_sources(spark, root + "/nowhere") == {}


def test_staging(layers):
    orders = by(layers["stg_production_orders"], "work_order_id")
    assert {k: r["shift_code"] for k, r in orders.items()} == {
        "WO-1": "Shift B", "WO-2": None, "WO-3": "Shift A", "WO-4": None, "WO-5": "Shift A"}
    insp = by(layers["stg_inspection_records"], "inspection_id")
    assert set(insp) == {"INSP-10", "INSP-2", "INSP-3", "INSP-4"}  # text order: INSP-10 before INSP-9
    assert {k: r["is_anomalous_timestamp"] for k, r in insp.items()} == {
        "INSP-10": False, "INSP-2": True, "INSP-3": False, "INSP-4": True}
    people = by(layers["stg_operators"], "operator_id")
    assert people["OP007"]["welding_cert_current"] is False and people["OP001"]["hire_date"] == date(2020, 1, 1)


def test_spine_and_enrichment(layers):
    spine = by(layers["int_orders_with_inspections"], "work_order_id")
    assert set(spine) == {"WO-1", "WO-2", "WO-3", "WO-4"}  # WO-5 was never inspected
    assert spine["WO-1"]["defect_rate"] == 0.4 and spine["WO-2"]["defect_rate"] is None
    assert [spine[k]["schedule_variance_hrs"] for k in ("WO-1", "WO-2", "WO-3", "WO-4")] == [1, None, -2, 0]
    rich = by(layers["int_orders_enriched"], "work_order_id")
    assert {k: r["welding_cert_mismatch"] for k, r in rich.items()} == {
        "WO-1": True, "WO-2": False, "WO-3": False, "WO-4": False}
    assert rich["WO-1"]["supplier"] == "Supplier C" and rich["WO-2"]["supplier"] is None
    assert rich["WO-4"]["supplier"] is None and rich["WO-4"]["lot_id"] == "LOT-9999"


def test_scrap_keeps_events_with_a_lost_inspection(layers):
    costs = by(layers["int_scrap_costs"], "scrap_id")
    assert set(costs) == {"SCRAP-1", "SCRAP-2", "SCRAP-4"}  # SCRAP-3 belongs to an uninspected order
    assert costs["SCRAP-1"]["inspection_id"] == "INSP-9" and costs["SCRAP-1"]["order_defect_rate"] == 0.4
    summary = by(layers["mart_scrap_summary"], "scrap_id")
    assert summary["SCRAP-1"]["material_cost_total"] == 20.76 and summary["SCRAP-1"]["labor_cost_total"] == 218.76
    assert summary["SCRAP-2"]["shift_code"] == "Shift B"  # the order's shift, not the event's
    assert (summary["SCRAP-1"]["scrap_year"], summary["SCRAP-1"]["scrap_month_num"]) == (2024, 1)
    assert summary["SCRAP-1"]["scrap_month"] == datetime(2024, 1, 1)


def test_defect_rate_mart_and_flags(layers):
    mart = by(layers["mart_defect_rates"], "work_order_id")
    assert mart["WO-1"]["order_month"] == datetime(2024, 1, 1) and mart["WO-4"]["order_month_num"] == 2
    flags = ["is_p1_combination", "is_p2_supplier", "is_p3_complexity", "is_p4_cert_mismatch", "defect_flag"]
    assert [mart["WO-1"][f] for f in flags] == [False, True, True, True, True]
    assert [mart["WO-3"][f] for f in flags] == [False] * 5
    by_type = by(marts.defect_rates(layers["int_orders_enriched"], marts.bending_second_shift), "work_order_id")
    assert by_type["WO-1"]["is_p1_combination"] is True


def test_operator_performance(layers):
    mart = by(layers["mart_operator_performance"], "operator_id")
    assert set(mart) == {"OP001", "OP007", "OP009"}
    bob = mart["OP007"]
    assert (bob["total_jobs"], bob["total_welding_jobs"], bob["cert_mismatch_job_count"]) == (1, 1, 1)
    assert (bob["mean_defect_rate"], bob["median_defect_rate"], bob["pct_jobs_with_defect"]) == (0.4, 0.4, 100.0)
    assert bob["peer_mean_defect_rate"] == 0.2167 and bob["defect_rate_vs_peer"] == 0.1833
    assert bob["total_scrap_cost_attributed"] == pytest.approx(269.52)
    assert mart["OP001"]["total_jobs"] == 1 and mart["OP001"]["total_scrap_cost_attributed"] == 0.0
    assert mart["OP009"]["total_scrap_cost_attributed"] == 0.0


def test_all_contracts(layers):
    result = warehouse.contracts(layers)
    kinds = {r["check"]: r["count"] for r in result.groupBy("check").count().collect()}
    assert kinds == {"not_null": 40, "unique": 15, "accepted_values": 8, "relationship": 5, "expression": 2}
    assert rows(result.where("status <> 'PASS'")) == []


def test_contracts_notice_violations(spark, layers):
    broken = dict(layers)
    broken["stg_machines"] = layers["stg_machines"].where("machine_id <> 'M03'")
    scrap = layers["mart_scrap_summary"]
    broken["mart_scrap_summary"] = scrap.withColumn("total_scrap_cost", F.col("total_scrap_cost") + 1)
    failed = {(r["check"], r["table"], r["column"]): r["failed"]
              for r in warehouse.contracts(broken).where("status = 'FAIL'").collect()}
    assert failed == {("relationship", "stg_production_orders", "machine_id"): 1,
                      ("expression", "mart_scrap_summary", "material + labor = total"): 3}


def test_kpi_cards_on_the_marts(layers):
    cards = {(r["window"], r["measure"]): r for r in kpi.kpi_cards(
        layers["mart_defect_rates"], layers["mart_scrap_summary"]).collect()}
    assert len(cards) == 18
    month = cards[("month", "parts_inspected")]
    assert (month["cur"], month["prior"], month["arrow"], month["verdict"]) == (8.0, 15.0, "down", "bad")
    assert cards[("month", "defects")]["verdict"] == "good"
    assert cards[("month", "scrap_cost")]["prior"] == pytest.approx(269.52)
    assert cards[("week", "defect_rate")]["verdict"] == "neutral"  # the prior week is empty


def test_publishing_a_stored_mart(spark, layers, tmp_path):
    from linegauge.sources.sinks import publish

    view = publish(layers["stg_machines"], "machines_view")
    assert spark.table("machines_view").count() == view.count() == 2
    assert one(spark.sql("select count(*) n from mart_defect_rates"))["n"] == 4


def test_stored_marts(spark, root, tmp_path):
    stored = warehouse.build_warehouse(spark, root, stored=True, tables_root=str(tmp_path))
    assert one(spark.sql("select count(*) n from mart_scrap_summary"))["n"] == 3
    assert stored["mart_operator_performance"].count() == 3
    for name in stored:
        if name.startswith("mart_"):
            spark.sql(f"drop table {name}")
