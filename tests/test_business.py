from datetime import datetime

import pytest
from conftest import one
from pyspark.sql import functions as F

from linegauge.functions.exprs import flag
from linegauge.operators import business


def test_multiplier_null_policy(spark):
    df = spark.createDataFrame([("C", 4, 10), ("A", 1, 10), (None, 3, 10)], "s string, f int, i int")
    c = F.col("s") == "C"
    got = one(business.segment_multipliers(df, {"c": (flag(c), flag(~c, True))}, "f", "i"))
    assert (got["segment_rate"], got["baseline_rate"], got["multiplier"]) == (0.4, 0.2, 2.0)
    none = one(business.segment_multipliers(df, {"q": (F.col("s") == "Q", flag(c))}, "f", "i"))
    assert (none["segment_rate"], none["multiplier"]) == (0.0, 0.0)


def test_savings(spark):
    orders = spark.createDataFrame([("w1", "C", 4, 10), ("w2", "A", 1, 10), ("w3", "C", 0, 10)],
                                   "k string, s string, f int, i int")
    costs = spark.createDataFrame([("w1", 60.0), ("w1", 40.0), ("w2", 500.0), ("gone", 9.0)], "k string, c double")
    got = {r["segment"]: r for r in business.savings(orders, costs, "k", {
        "c": (F.col("s") == "C", 0.1), "none": (F.col("s") == "Z", 0.1)}, "f", "i", "c", F.lit(6)).collect()}
    assert got["c"]["segment_cost"] == 100.0 and got["c"]["rate"] == 0.2
    assert got["c"]["savings"] == pytest.approx(50.0) and got["c"]["savings_per_year"] == pytest.approx(100.0)
    assert (got["none"]["savings"], got["none"]["segment_cost"]) == (0.0, 0.0)


def test_queue(spark):
    t = lambda h: datetime(2026, 1, 5, h)
    orders = spark.createDataFrame([("a", t(7)), ("b", t(9)), ("c", t(15)), ("d", t(13))], "k string, ts timestamp")
    preds = spark.createDataFrame([("c", 0.9, "High"), ("a", 0.7, "Medium"), ("d", 0.8, "High")],
                                  "k string, defect_probability double, risk_tier string")
    got = business.in_queue_order(business.work_queue(orders, preds, "k", "ts"), "ts", "k").collect()
    assert [(r["k"], r["status"], r["defect_probability"]) for r in got] == [
        ("d", "In Progress", 0.8), ("c", "Open", 0.9), ("a", "Open", 0.7), ("b", "In Progress", 0.1)]
    named = business.with_names(orders, "k", {"a": "Alpha"}, "name").collect()
    assert {r["k"]: r["name"] for r in named} == {"a": "Alpha", "b": "b", "c": "c", "d": "d"}


def _job(**kw):
    base = dict(top_driver_feature="machine_id", machine_type="Laser", shift_code="Shift A", complexity="Low",
                machine_age_years=2, lot_cert_status="Certified", material_type="Aluminum", defect_probability=0.7,
                risk_tier="Medium")
    return {**base, **kw}


def test_risk_factors(spark):
    T = business.RISK_TEXT
    cases = [
        (_job(machine_type="Bending", shift_code="Shift B", complexity="High", machine_age_years=12, risk_tier="High",
              defect_probability=0.9),
         [T["bending"], "High complexity part on aging equipment (12 yrs old)"]),
        (_job(top_driver_feature="lot_cert_status", lot_cert_status="Missing", material_type="16ga Steel"),
         [T["lot"], T["thin"]]),
        (_job(top_driver_feature="is_supplier_c_thin_gauge"), [T["supply"]]),
        (_job(top_driver_feature="is_lapsed_cert_op"), [T["cert"]]),
        (_job(), [T["check"]]),
        (_job(defect_probability=0.85, risk_tier="High"), [T["many"]]),
        (_job(machine_type="Bending", complexity="High"), [T["complex"], T["tight_bend"]]),
        (_job(risk_tier="Low", complexity="High"), []),
    ]
    cols = list(_job())
    df = spark.createDataFrame([(i, *[j[c] for c in cols]) for i, (j, _) in enumerate(cases)],
                               "i int, top_driver_feature string, machine_type string, shift_code string, complexity string, "
                               "machine_age_years int, lot_cert_status string, material_type string, "
                               "defect_probability double, risk_tier string")
    got = {r["i"]: r for r in business.risk_factors(df).collect()}
    # "lot_cert_status" and "is_lapsed_cert_op" both contain "cert"
    want = {i: f for i, (_, f) in enumerate(cases)}
    want[3] = [T["supply"], T["cert"]]
    assert {i: r["risk_factors"] for i, r in got.items()} == want
    assert got[0]["action"] == business.ACTION_TEXT["High"] and got[7]["action"] is None


def test_caught_value_and_ranking(spark):
    scored = spark.createDataFrame([("a", True, 1), ("b", True, 0), ("c", False, 1)], "k string, hit boolean, y int")
    costs = spark.createDataFrame([("a", 600.0), ("c", 100.0), ("b", 7.0)], "k string, c double")
    got = one(business.caught_value(scored, costs, "k", "c", F.col("hit"), F.col("y") == 1))
    assert (got["n_caught"], got["caught_month"], got["defect_month"], got["caught_year"], got["defect_year"]) == (
        1, 600.0, 700.0, 7000.0, 8000.0)
    drivers = spark.createDataFrame([(f,) for f in "aaabbc"], "f string")
    ranked = {r["f"]: r["rank"] for r in business.ranked_drivers(drivers, "f", "a").collect()}
    assert ranked == {"b": 1, "c": 2, "a": 3}
