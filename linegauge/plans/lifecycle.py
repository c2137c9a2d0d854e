"""The model life cycle over stored tables: features, training, scoring of periods, monitoring.

Everything lives below one ``store`` folder: ``features`` (by split), ``models``, ``artifacts``,
``validation_predictions``, ``predictions`` (by period), ``monitoring`` and the run log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.functions.exprs import in_period
from linegauge.operators import drift, evaluate, monitoring, scoring, training
from linegauge.operators import features as ft
from linegauge.operators.attribution import attribute, importance, input_names
from linegauge.sources import runlog, sinks, snapshots
from linegauge.sources.readers import require_rows

MODEL = "defect_risk"
Period = tuple[str, str, str]  # label, first day, last day
NUMBERS = ft.NUMERIC + ft.INTERACTION
# requires_welding is measured as a number
DRIFT_TEXTS = [c for c in ft.CATEGORICAL if c != "requires_welding"]
DRIFT_NUMBERS = [*ft.NUMERIC, "requires_welding"]


def prepare_features(mart: DataFrame, store: str, train_end: str, validation_end: str, **kw) -> str:
    """Feature rows of every split, exported as the next version of the feature snapshot; returns its folder."""
    rows = ft.feature_table(mart, "actual_start", train_end, validation_end, **kw).where(F.col("split").isNotNull())
    snapshots.export(rows, f"{store}/features")
    return f"{store}/features"


def load_split(spark: SparkSession, store: str, split: str) -> DataFrame:
    """One split of the latest version; the filter prunes to its partition."""
    rows = snapshots.read(spark, f"{store}/features", part=split).drop("split")
    return rows.withColumn(ft.TARGET, F.col(ft.TARGET).cast("int"))


def write_artifacts(scored: DataFrame, path: str, label: str = ft.TARGET) -> None:
    """Curves, calibration and confusion of validation scores as tables."""
    rows = scored.select(F.col("probability_1").alias("score"), F.col(label).cast("int").alias("y")).persist()
    try:
        tables = {"pr_curve": evaluate.pr_curve(rows, "score", "y"), "roc_curve": evaluate.roc_curve(rows, "score", "y"),
                  "calibration": evaluate.calibration(rows, "score", "y"),
                  "confusion_matrix": evaluate.confusion(rows, "score", "y", evaluate.HIGH_RISK)}
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{path}/{name}")
    finally:
        rows.unpersist()


def train(spark: SparkSession, store: str, run_id: str, trials: int = 150, rounds: int = training.ROUNDS,
          families: Sequence[str] = tuple(training.SPACES), spaces=None, curve: bool = False) -> training.Trained:
    """Tune every family, keep the best by validation ROC-AUC, test it once, register it."""
    train_rows = require_rows(load_split(spark, store, "train"), "training rows")
    validation = require_rows(load_split(spark, store, "validation"), "validation rows")
    found = []
    for family in families:
        got = training.tune(train_rows, validation, ft.TARGET, family, ft.CATEGORICAL, NUMBERS, trials, rounds=rounds,
                            space=(spaces or training.SPACES)[family], root=f"{store}/model_tables/{run_id}-{family}")
        scored = training.probability(got.model.transform(validation))
        path = f"{store}/artifacts/{run_id}-{family}"
        write_artifacts(scored, path)
        names = input_names(got.model, validation)
        importance(attribute(got.model.transform(validation), got.model, ft.ID), names).write.mode(
            "overwrite").parquet(f"{path}/importance")
        if curve:
            training.learning_curve(train_rows, ft.ID, ft.TARGET, family, got.params, ft.CATEGORICAL,
                                    NUMBERS).write.mode("overwrite").parquet(f"{path}/learning_curve")
        runlog.log_run(spark, store, f"{run_id}-{family}", "trial", family, 0, _metrics(scored, "val_"), got.params)
        found.append(got)
    best = training.best_of(found)
    scoring.validation_reference(best.model, validation, ft.TARGET).write.mode("overwrite").parquet(
        f"{store}/validation_predictions")
    test = load_split(spark, store, "test")
    values = {} if test.isEmpty() else _metrics(training.probability(best.model.transform(test)), "test_")
    latest = runlog.latest_version(spark, store, MODEL).first()
    version = latest["version"] + 1 if latest else 1
    best.model.write().overwrite().save(f"{store}/models/{MODEL}/{version}")
    reference = monitoring.frozen_reference(train_rows, spark.read.parquet(f"{store}/validation_predictions"), ft.TARGET, DRIFT_TEXTS,
                                            DRIFT_NUMBERS, ft.INTERACTION)
    reference.write.mode("overwrite").parquet(f"{store}/references/{MODEL}/{version}")
    runlog.log_run(spark, store, run_id, "training", MODEL, version, values, {"family": best.family, **best.params})
    return best


def _metrics(scored: DataFrame, prefix: str) -> dict[str, float]:
    found = evaluate.metrics(scored, "probability_1", ft.TARGET).first().asDict()
    return {f"{prefix}{k}": v for k, v in found.items() if v is not None}


def load_model(spark: SparkSession, store: str) -> tuple[PipelineModel, int, str]:
    """The registered model with the highest version."""
    row = require_rows(runlog.latest_version(spark, store, MODEL), "registered model").first()
    return PipelineModel.load(f"{store}/models/{MODEL}/{row['version']}"), row["version"], row["run_id"]


def period_label(ts: str, periods: Sequence[Period], closed_at_midnight: bool = False) -> Column:
    out = F.lit(None).cast("string")
    for label, start, end in reversed(periods):
        out = F.when(in_period(ts, start, end, closed_at_midnight), F.lit(label)).otherwise(out)
    return out


def period_rows(mart: DataFrame, periods: Sequence[Period], closed_at_midnight: bool = False) -> DataFrame:
    """Work orders of all periods with their label and features; the outer bounds reach the scan."""
    first, last = min(p[1] for p in periods), max(p[2] for p in periods)
    rows = mart.where(in_period("actual_start", first, last, closed_at_midnight)).withColumn(
        "period_label", period_label("actual_start", periods, closed_at_midnight)).where(
        F.col("period_label").isNotNull())
    return ft.interaction_features(rows).select(ft.ID, "actual_start", *ft.FEATURES, ft.TARGET, "period_label")


def score_periods(spark: SparkSession, store: str, mart: DataFrame, periods: Sequence[Period], run_id: str,
                  closed_at_midnight: bool = False) -> DataFrame:
    """Score all periods in one plan, store predictions by period, return the accuracy by tier."""
    model, version, source_run = load_model(spark, store)
    rows = require_rows(period_rows(mart, periods, closed_at_midnight), "work orders of the periods")
    scored = scoring.score_with_drivers(model, rows, ft.ID, ft.FEATURES, period="period_label")
    sinks.write_partitioned(scoring.predictions(scored, ft.ID, "actual_start", "period_label"),
                            f"{store}/predictions", "period_label")
    summary = scoring.accuracy(load_predictions(spark, store, periods), "period_label")
    sinks.write_csv_summary(summary, f"{store}/accuracy_summary/{run_id}")
    rows = summary.collect()  # two rows per period
    for label, start, end in periods:
        values = {f"{r['risk_tier'].lower()}_tier_{m}": r[m] for r in rows if r["period_label"] == label
                  for m in ("precision", "recall", "jobs_flagged")}
        runlog.log_run(spark, store, f"{run_id}-{label}", "scoring", f"{MODEL}_scoring", version, values,
                       {"period_label": label, "scoring_start": start, "scoring_end": end, "source_run": source_run})
    return summary


def load_predictions(spark: SparkSession, store: str, periods: Sequence[Period]) -> DataFrame:
    """Stored predictions of the periods; labels stay text, partitions are pruned."""
    raw = spark.read.parquet(f"{store}/predictions")
    label = F.col("period_label").cast("string")
    return raw.where(label.isin([p[0] for p in periods])).withColumn("period_label", label)


def monitor_periods(spark: SparkSession, store: str, mart: DataFrame, periods: Sequence[Period], run_id: str,
                    closed_at_midnight: bool = False) -> DataFrame:
    """Every monitoring layer of all periods; stores the table and the drift of each feature.

    What is compared with is the frozen profile of the registered model; no training row is read.
    """
    labels = [p[0] for p in periods]
    version = require_rows(runlog.latest_version(spark, store, MODEL), "registered model").first()["version"]
    profile = spark.read.schema(drift.PROFILE).parquet(f"{store}/references/{MODEL}/{version}")
    current = period_rows(mart, periods, closed_at_midnight)
    predicted = load_predictions(spark, store, periods)
    scores = drift.profile_scores(profile, current, "period_label", labels, DRIFT_TEXTS, [*DRIFT_NUMBERS, *ft.INTERACTION])
    drift.drift_table(scores, "period_label", DRIFT_TEXTS, ft.INTERACTION).write.mode("overwrite").parquet(
        f"{store}/monitoring/feature_drift/{run_id}")
    path = f"{store}/monitoring/periods/{run_id}"
    monitoring.monitoring_table_of(profile, current, predicted, "period_label", labels, "actual_defect_flag", ft.TARGET, DRIFT_TEXTS,
                                   DRIFT_NUMBERS, ft.INTERACTION).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
