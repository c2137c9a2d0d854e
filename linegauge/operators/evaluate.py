"""Exact classifier metrics as DataFrame aggregates.

Rows are reduced to positives and negatives per distinct score, then accumulated in score
order over value ranges, so no task holds all scores. ``ranges`` = 0 uses one plain window: right
only where the number of distinct scores has a known bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linegauge.functions.exprs import ratio_or_zero, right_closed_bucket
from linegauge.operators.prefix import running_sums, split_points
from linegauge.session import fan_out

# Risk thresholds on the predicted probability.
MEDIUM_RISK, HIGH_RISK = 0.65, 0.75


def score_counts(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    y = F.col(label).cast("int")
    return df.where(F.col(score).isNotNull() & y.isNotNull()).groupBy(*keys, F.col(score).alias("score")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def ranked_scores(df: DataFrame, score: str, label: str, keys: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Per distinct score: positives and negatives at, and at or above, the score, and totals."""
    ranges = fan_out(df.sparkSession) if ranges is None else ranges
    cuts = split_points(df, score, ranges) if ranges else None
    run = running_sums(score_counts(df, score, label, keys), keys, "score", ["pos", "neg"], ranges, cuts)
    at_or_above = lambda m: (F.col(f"{m}_total") - F.col(f"{m}_upto") + F.col(m))
    return run.select(*keys, "score", "pos", "neg", "pos_total", "neg_total",
                      (F.col("neg_upto") - F.col("neg")).alias("neg_below"),
                      at_or_above("pos").alias("tp"), at_or_above("neg").alias("fp"))


def metrics(df: DataFrame, score: str, label: str, threshold: float = 0.5, keys: Sequence[str] = (),
            ranges: int | None = None) -> DataFrame:
    """ROC-AUC, average precision, F1, precision, recall at a threshold; 0 where undefined."""
    r = ranked_scores(df, score, label, keys, ranges)
    area = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2)) / F.max(
        F.nullif(F.col("pos_total").cast("double") * F.col("neg_total"), F.lit(0.0)))  # no 64-bit product of two counts
    ap = F.sum(F.col("pos") / F.nullif("pos_total", F.lit(0)) * F.col("tp") / (F.col("tp") + F.col("fp")))
    above = F.col("score") >= threshold
    out = r.groupBy(*keys).agg(
        area.alias("roc_auc"), F.coalesce(ap, F.lit(0.0)).alias("avg_precision"),
        F.coalesce(F.sum(F.when(above, F.col("pos"))), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum(F.when(above, F.col("neg"))), F.lit(0)).alias("_fp"), F.max("pos_total").alias("_p"))
    precision, recall = ratio_or_zero("_tp", F.col("_tp") + F.col("_fp")), ratio_or_zero("_tp", "_p")
    f1 = ratio_or_zero(2 * F.col("_tp"), F.col("_tp") + F.col("_fp") + F.col("_p"))
    return out.select(*keys, "roc_auc", "avg_precision", f1.alias("f1"), precision.alias("precision"),
                      recall.alias("recall"))


def confusion(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """Actual x predicted counts with their share of the actual class (four rows)."""
    y, p = F.col(label).cast("int"), (F.col(score) >= threshold).cast("int")
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    wide = df.agg(*[F.count(F.when((y == a) & (p == b), 1)).alias(f"_{a}{b}") for a, b in cells])
    items = [F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"_{a}{b}").alias("n"),
                      ratio_or_zero(f"_{a}{b}", F.col(f"_{a}0") + F.col(f"_{a}1")).alias("row_share"))
             for a, b in cells]
    return wide.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def pr_curve(df: DataFrame, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """Precision and recall at every distinct score, and the closing point (1, 0)."""
    r = ranked_scores(df, score, label, (), ranges)
    points = r.select(F.col("score").cast("double").alias("threshold"),
                      (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                      ratio_or_zero("tp", "pos_total").alias("recall"))
    end = df.sparkSession.createDataFrame([(1.0, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)


def roc_curve(df: DataFrame, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """False and true positive rate at every distinct score, and the origin (threshold null)."""
    r = ranked_scores(df, score, label, (), ranges)
    points = r.select(F.col("score").cast("double").alias("threshold"), ratio_or_zero("fp", "neg_total").alias("fpr"),
                      ratio_or_zero("tp", "pos_total").alias("tpr"))
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return points.unionByName(start)


def calibration(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean score against positive fraction per uniform bin; an edge belongs to the lower bin."""
    edges = [i / bins for i in range(1, bins)]
    slot = right_closed_bucket(score, edges, [str(i) for i in range(bins)]).cast("int")
    return df.where(F.col(score).isNotNull()).groupBy(slot.alias("bin")).agg(
        F.avg(score).alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        F.count("*").alias("n"))


def risk_tier(probability: Column | str) -> Column:
    """Low up to 0.65, Medium up to 0.75, High above (unrounded probability)."""
    return right_closed_bucket(probability, [MEDIUM_RISK, HIGH_RISK], ["Low", "Medium", "High"])


def tier_counts(df: DataFrame, tier: str, keys: Sequence[str] = ()) -> DataFrame:
    """Jobs and share per tier (window over at most three rows per key)."""
    counts = df.groupBy(*keys, tier).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(*keys)))


def accuracy_by_tier(df: DataFrame, probability: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Precision and recall of the jobs flagged at or above each tier's threshold.

    Uses the probability as published (rounded) and counts cumulatively: the Medium row
    includes the High jobs.
    """
    y = F.col(label).cast("int")
    tiers = {"High": HIGH_RISK, "Medium": MEDIUM_RISK}
    aggs = [F.count("*").alias("_n"), F.coalesce(F.sum(y), F.lit(0)).alias("_p")]
    for t, limit in tiers.items():
        hit = F.col(probability) >= limit
        aggs += [F.count(F.when(hit, 1)).alias(f"_f{t}"), F.coalesce(F.sum(F.when(hit, y)), F.lit(0)).alias(f"_t{t}")]
    items = [F.struct(
        F.lit(t).alias("risk_tier"), F.lit(limit).alias("threshold"), F.col(f"_f{t}").alias("jobs_flagged"),
        F.col(f"_t{t}").alias("true_positives"), (F.col(f"_f{t}") - F.col(f"_t{t}")).alias("false_positives"),
        F.round(ratio_or_zero(f"_t{t}", f"_f{t}"), 4).alias("precision"),
        F.round(ratio_or_zero(f"_t{t}", "_p"), 4).alias("recall"),
        F.round(ratio_or_zero(f"_f{t}", "_n"), 4).alias("pct_of_total")) for t, limit in tiers.items()]
    return df.groupBy(*keys).agg(*aggs).select(*keys, F.explode(F.array(*items)).alias("r")).select(*keys, "r.*")


def nearest_point(curve: DataFrame, col: str, target: float) -> DataFrame:
    """The curve row closest to a target value; the smaller value wins a tie."""
    cols = curve.columns
    order = F.struct(F.abs(F.col(col) - target), F.col(col))
    return curve.where(F.col(col).isNotNull()).agg(
        F.min_by(F.struct(*cols), order).alias("r")).where(F.col("r").isNotNull()).select("r.*")
