"""Longitudinal monitoring: performance, target, prediction and feature drift per period.

All periods are computed in one plan keyed by the period label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.functions.exprs import flag, ratio_or_zero, reasons
from linegauge.operators.drift import (
    DRIFT_LIMIT, feature_scores, melt_numbers, merged_counts, profile_mean, profile_scores, value_counts)
from linegauge.operators.evaluate import HIGH_RISK, MEDIUM_RISK

# Limits of the retraining decision.
MIN_HIGH_PRECISION = 0.85
MAX_RATE_SHIFT = 0.10
MAX_DRIFTED_FEATURES = 3


def percent(x: Column, digits: int = 1) -> Column:
    return F.concat(F.format_string(f"%.{digits}f", x * 100), F.lit("%"))


def with_decision(df: DataFrame) -> DataFrame:
    """status, retrain_recommended and reasons from high_precision, target_rate_delta,
    prediction_drift_detected and n_features_drifted.

    Measured performance and target drift lead to RETRAIN; drift of scores or inputs alone
    leads to INVESTIGATE.
    """
    weak = F.col("high_precision") < MIN_HIGH_PRECISION
    shifted = F.col("target_rate_delta") > MAX_RATE_SHIFT
    many = F.col("n_features_drifted") > MAX_DRIFTED_FEATURES
    primary = reasons(
        (weak, F.concat(F.lit("High-tier precision "), percent(F.col("high_precision")),
                        F.lit(f" below {MIN_HIGH_PRECISION:.0%} floor"))),
        (shifted, F.concat(F.lit("Defect rate shifted "), percent(F.col("target_rate_delta")),
                           F.lit(f" from training baseline (> {MAX_RATE_SHIFT:.0%})"))))
    secondary = reasons(
        (F.col("prediction_drift_detected"),
         "Prediction (output) distribution drifted vs validation reference"),
        (many, F.concat(F.col("n_features_drifted").cast("string"),
                        F.lit(f" input features drifted (> {MAX_DRIFTED_FEATURES})"))))
    main = F.size(primary) > 0
    return df.withColumns({
        "status": F.when(main, "RETRAIN").when(F.size(secondary) > 0, "INVESTIGATE").otherwise("HEALTHY"),
        "retrain_recommended": main,
        "reasons": F.array_join(F.concat(primary, secondary), " | "),
    })


def outcomes(predicted: DataFrame, label: str, period: str, train_rate: Column) -> DataFrame:
    """Measured performance and target drift per period, in one aggregate.

    Tiers count cumulatively on the published probability; rates are 0 where undefined.
    """
    y = F.col(label).cast("int")
    aggs = [F.avg(y).alias("_r"), F.sum(y).alias("_p"), F.count("*").alias("n_scored"),
            F.round(F.avg("defect_probability"), 4).alias("cur_pred_mean")]
    for tier, limit in (("high", HIGH_RISK), ("medium", MEDIUM_RISK)):
        hit = F.col("defect_probability") >= limit
        aggs += [F.count_if(hit).alias(f"{tier}_flagged"), F.coalesce(F.sum(F.when(hit, y)), F.lit(0)).alias(f"_{tier}")]
    rows = predicted.groupBy(period).agg(*aggs).withColumn("_t", train_rate)
    delta = F.abs(F.col("_r") - F.col("_t"))
    return rows.select(
        period, "n_scored", "cur_pred_mean", "high_flagged",
        *[F.round(ratio_or_zero(f"_{t}", d), 4).alias(f"{t}_{name}") for t in ("high", "medium")
          for name, d in (("precision", f"{t}_flagged"), ("recall", "_p"))],
        F.col("_t").alias("train_defect_rate"), F.col("_r").alias("period_defect_rate"),
        delta.alias("target_rate_delta"), (delta > MAX_RATE_SHIFT).alias("target_drift_detected"))


def target_drift(predicted: DataFrame, label: str, period: str, train_rate: Column) -> DataFrame:
    """Actual rate per period against the training rate."""
    return outcomes(predicted, label, period, train_rate).select(
        period, "train_defect_rate", "period_defect_rate", "target_rate_delta", "target_drift_detected")


SCORE = "defect_probability"


def monitoring_table(reference: DataFrame, validation_scores: DataFrame, current: DataFrame, predicted: DataFrame,
                     period: str, periods: Sequence[str], label: str, target: str, categorical: Sequence[str],
                     numeric: Sequence[str], interaction: Sequence[str] = ()) -> DataFrame:
    """One row per period with every monitoring layer and the decision.

    The published scores are measured together with the numeric features, and everything
    about the predictions comes from one aggregate: two small results are joined.
    """
    scores = feature_scores(reference, current, period, periods, categorical, [*numeric, *interaction],
                            melt_numbers(validation_scores, [SCORE]), melt_numbers(predicted, [SCORE], [period]))
    train_rate = reference.agg(F.avg(F.col(target).cast("double")).alias("v")).scalar()
    ref_mean = validation_scores.agg(F.round(F.avg(SCORE), 4).alias("v")).scalar()
    return _table(scores, predicted, period, label, train_rate, ref_mean)


def frozen_reference(reference: DataFrame, validation_scores: DataFrame, target: str, categorical: Sequence[str],
                     numeric: Sequence[str], interaction: Sequence[str] = ()) -> DataFrame:
    """All that monitoring needs of the training rows and the validation scores, as one table of value counts."""
    label = reference.select(F.col(target).cast("double").alias(target))
    return merged_counts(value_counts(reference, categorical, [*numeric, *interaction]), value_counts(label, [], [target]),
                         value_counts(validation_scores, [], [SCORE]))


def monitoring_table_of(profile: DataFrame, current: DataFrame, predicted: DataFrame, period: str, periods: Sequence[str],
                        label: str, target: str, categorical: Sequence[str], numeric: Sequence[str],
                        interaction: Sequence[str] = ()) -> DataFrame:
    """``monitoring_table`` against a frozen reference: neither training rows nor validation scores are read."""
    scores = profile_scores(profile, current, period, periods, categorical, [*numeric, *interaction],
                            melt_numbers(predicted, [SCORE], [period]), [SCORE])
    return _table(scores, predicted, period, label, profile_mean(profile, target), F.round(profile_mean(profile, SCORE), 4))


def _table(scores: DataFrame, predicted: DataFrame, period: str, label: str, train_rate: Column, ref_mean: Column) -> DataFrame:
    is_score = F.col("feature") == SCORE
    distances = scores.groupBy(period).agg(
        F.count_if(~is_score).alias("n_features_monitored"),
        F.count_if(~is_score & (F.col("score") >= DRIFT_LIMIT)).alias("n_features_drifted"),
        F.max(F.when(is_score, F.col("score"))).alias("_s"))
    table = outcomes(predicted, label, period, train_rate).join(distances, period).select(
        "*", F.round("_s", 4).alias("prediction_drift_score"), F.lit(DRIFT_LIMIT).alias("prediction_drift_threshold"),
        F.coalesce(F.col("_s") >= DRIFT_LIMIT, F.lit(False)).alias("prediction_drift_detected"), ref_mean.alias("ref_pred_mean")).drop("_s")
    decided = with_decision(table)
    rounded = ("train_defect_rate", "period_defect_rate", "target_rate_delta")
    return decided.select(*[F.round(c, 4).alias(c) if c in rounded else F.col(c) for c in decided.columns])


def drift_matrix(features: DataFrame, period: str, periods: Sequence[str]) -> DataFrame:
    """Feature x period scores with their mean, largest mean first."""
    wide = features.groupBy("feature").pivot(period, list(periods)).agg(F.first("drift_score"))
    mean = features.groupBy("feature").agg(F.avg("drift_score").alias("mean_score"))
    return wide.join(mean, "feature").orderBy(F.desc("mean_score"), "feature")


def trend_flags(table: DataFrame, period: str) -> DataFrame:
    """Per period: which limits are broken, one row per monitoring layer."""
    layer = lambda name, value, limit, bad: F.struct(
        F.lit(name).alias("layer"), value.cast("double").alias("value"), F.lit(float(limit)).alias("limit"),
        flag(bad).alias("alert"))
    c = F.col
    return table.select(period, F.explode(F.array(
        layer("high_precision", c("high_precision"), MIN_HIGH_PRECISION, c("high_precision") < MIN_HIGH_PRECISION),
        layer("target_rate_delta", c("target_rate_delta"), MAX_RATE_SHIFT, c("target_rate_delta") > MAX_RATE_SHIFT),
        layer("prediction_drift_score", c("prediction_drift_score"), 0.1, c("prediction_drift_detected")),
        layer("n_features_drifted", c("n_features_drifted"), MAX_DRIFTED_FEATURES,
              c("n_features_drifted") > MAX_DRIFTED_FEATURES))).alias("r")).select(period, "r.*")


def latest_rules(table: DataFrame, period: str) -> DataFrame:
    """Rule status of the latest period."""
    last = table.agg(F.max(period).alias("v")).scalar()
    return trend_flags(table.where(F.col(period) == last), period).withColumn(
        "rule_status", F.when(F.col("alert"), "TRIGGERED").otherwise("OK"))
