"""Batch scoring of periods: probability, tier, drivers, accuracy, run records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.operators.attribution import attribute, input_names, plain_name, with_drivers
from linegauge.operators.evaluate import accuracy_by_tier, risk_tier
from linegauge.operators.features import TARGET
from linegauge.operators.training import probability


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Probability (4 digits) and tier (from the unrounded probability) per row."""
    out = probability(model.transform(df), "_p")
    return out.withColumn("risk_tier", risk_tier("_p")).withColumn("defect_probability", F.round("_p", 4)).drop("_p")


def score_with_drivers(model: PipelineModel, df: DataFrame, key: str, originals: Sequence[str] = (),
                       k: int = 3, period: str | None = None) -> DataFrame:
    """Scores with drivers; linear drivers are measured against the means of the row's ``period``."""
    names = input_names(model, df)
    if originals:
        names = [plain_name(n, originals) for n in names]
    return with_drivers(attribute(score(model, df), model, key, period), names, k)


def predictions(scored: DataFrame, key: str, ts: str, period: str, target: str = TARGET) -> DataFrame:
    """The published columns; all periods together, one partition value per period."""
    return scored.select(key, ts, "defect_probability", "risk_tier", "drivers", "top_driver_feature",
                         "top_driver_direction", F.col(target).cast("int").alias("actual_defect_flag"), period)


def validation_reference(model: PipelineModel, validation: DataFrame, label: str) -> DataFrame:
    """Frozen score distribution of the validation rows."""
    return probability(model.transform(validation), "_p").select(
        F.round("_p", 4).alias("defect_probability"), F.col(label).cast("int").alias(label))


def accuracy(predicted: DataFrame, period: str) -> DataFrame:
    return accuracy_by_tier(predicted, "defect_probability", "actual_defect_flag", [period])
