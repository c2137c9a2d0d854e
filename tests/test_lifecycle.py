"""Features, training, scoring and monitoring over stored tables, on a mart with a planted pattern."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from linegauge.operators import features as ft
from linegauge.plans import lifecycle
from linegauge.sources import runlog
from linegauge.sources.readers import EmptyInput

SPACES = {"logistic_regression": {"C": ("log", 0.5, 2.0)},
          "boosted_trees": {"step": ("log", 0.2, 0.3), "depth": ("int", 3, 3), "sample": ("uniform", 0.9, 1.0),
                            "leaf": ("int", 1, 5)}}
PERIODS = [("202601", "2026-01-01", "2026-01-31"), ("202602", "2026-02-01", "2026-02-28")]


@pytest.fixture(scope="module")
def mart(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(1500):
        start = datetime(2024, 6, 1, 6) + timedelta(hours=float(i) * 10)
        complexity, shift = str(rng.choice(["Low", "Medium", "High"])), str(rng.choice(["Shift A", "Shift B"]))
        machine = str(rng.choice(["Bending", "Welding", "Punching"]))
        late = start >= datetime(2026, 2, 1)
        supplier = "Supplier Z" if late else str(rng.choice(["Supplier A", "Supplier C"]))
        p = 0.3 + 0.5 * (complexity == "High") + 0.15 * (machine == "Bending" and shift == "Shift B")
        rows.append((f"WO-{i}", start, machine, f"M{i % 5}", shift, f"OP{i % 9:03d}", complexity, "16ga Steel",
                     None if i % 7 == 0 else supplier, "Certified", bool(i % 2), int(i % 11),
                     float(rng.normal(2, 0.5)), int(rng.integers(5, 25)), float(rng.integers(-1, 3)),
                     bool(rng.random() < p)))
    return spark.createDataFrame(
        rows, "work_order_id string, actual_start timestamp, machine_type string, machine_id string, shift_code string, "
              "operator_id string, complexity string, material_type string, supplier string, lot_cert_status string, "
              "requires_welding boolean, machine_age_years int, std_labor_hrs double, quantity_ordered int, "
              "schedule_variance_hrs double, defect_flag boolean").cache()


def test_life_cycle(spark, mart, tmp_path):
    store = str(tmp_path / "store")
    lifecycle.prepare_features(mart, store, "2025-06-30", "2025-10-31", test_end="2025-12-31")
    sizes = {s: lifecycle.load_split(spark, store, s).count() for s in ("train", "validation", "test")}
    assert sum(sizes.values()) == mart.where("actual_start < '2026-01-01'").count()
    assert set(lifecycle.load_split(spark, store, "train").columns) == {ft.ID, *ft.FEATURES, ft.TARGET}
    with pytest.raises(EmptyInput):
        lifecycle.load_model(spark, store)

    best = lifecycle.train(spark, store, "run1", trials=1, rounds=6, families=tuple(SPACES), spaces=SPACES)
    assert best.validation_auc > 0.6
    _, version, run = lifecycle.load_model(spark, store)
    assert (version, run) == (1, "run1")
    metrics = {r["metric"]: r["value"] for r in runlog.run_metrics(spark, store, "run1").collect()}
    assert metrics["test_roc_auc"] > 0.55
    pr = spark.read.parquet(f"{store}/artifacts/run1-{best.family}/pr_curve")
    assert pr.where("precision < 0 or precision > 1 or recall < 0 or recall > 1").count() == 0

    summary = lifecycle.score_periods(spark, store, mart, PERIODS, "score1").collect()
    assert {(r["period_label"], r["risk_tier"]) for r in summary} == {
        (p[0], t) for p in PERIODS for t in ("High", "Medium")}
    predicted = lifecycle.load_predictions(spark, store, PERIODS)
    assert predicted.count() == mart.where("actual_start >= '2026-01-01' and actual_start < '2026-03-01'").count()
    assert predicted.where("size(drivers) <> 3 or top_driver_feature is null").count() == 0

    table = {r["period_label"]: r for r in lifecycle.monitor_periods(spark, store, mart, PERIODS, "mon1").collect()}
    assert set(table) == {"202601", "202602"}
    assert table["202601"]["n_features_monitored"] == 17
    drifted = spark.read.parquet(f"{store}/monitoring/feature_drift/mon1").where(
        "period_label = '202602' and drift_detected").collect()
    assert "supplier" in {r["feature"] for r in drifted}
    assert all(r["status"] in ("RETRAIN", "INVESTIGATE", "HEALTHY") for r in table.values())


def test_literal_period_ends(spark, mart):
    whole = lifecycle.period_rows(mart, PERIODS).count()
    literal = lifecycle.period_rows(mart, PERIODS, closed_at_midnight=True).count()
    last_days = mart.where("(to_date(actual_start) = '2026-01-31' or to_date(actual_start) = '2026-02-28') and "
                           "date_trunc('day', actual_start) < actual_start").count()
    assert literal == whole - last_days and last_days > 0
