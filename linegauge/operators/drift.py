"""Distribution drift between a reference and one or several periods.

All features and periods are measured in one plan over value counts: rows are melted to
(feature, value), counted map-side, and only counts are compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.operators.prefix import running_sums, split_points
from linegauge.session import fan_out

# A feature has drifted from this distance on; a numeric feature with at most
# this many distinct reference values is compared as a categorical one.
DRIFT_LIMIT = 0.1
FEW_VALUES = 5


def _melt(df: DataFrame, cells: Sequence[tuple[str, Column]], keep: Sequence[str]) -> DataFrame:
    """(feature, value) rows. Written with explode: Spark then sees that the two uses of the
    counts below read the same shuffle, which it does not with unpivot."""
    entries = [F.struct(F.lit(name).alias("feature"), value.alias("value")) for name, value in cells]
    return df.select(*keep, F.explode(F.array(*entries)).alias("_c")).select(*keep, "_c.feature", "_c.value")


def melt_text(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), null_token: str = "UNKNOWN") -> DataFrame:
    """(feature, value) of categorical columns as text; null becomes its own token."""
    return _melt(df, [(c, F.coalesce(F.col(c).cast("string"), F.lit(null_token))) for c in cols], keep)


def melt_numbers(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(feature, value) of numeric columns; missing values and NaN are left out."""
    if not cols:
        return df.select(*keep, F.lit("").alias("feature"), F.lit(0.0).alias("value")).where(F.lit(False))
    return _melt(df, [(c, F.col(c).cast("double")) for c in cols], keep).where(F.col("value").isNotNull() & ~F.isnan("value"))


def side_counts(reference: DataFrame, current: DataFrame, period: str, periods: Sequence[str]) -> DataFrame:
    """(feature, value, n_ref, n_0, n_1, ...): rows of the reference and of every period per value.

    One shuffle for all periods; the reference is counted once, whatever their number, or comes
    counted, with its rows per value in ``n``.
    """
    own = F.col("n") if "n" in reference.columns else F.lit(1).cast("bigint")
    both = reference.select("feature", "value", F.lit(None).cast("string").alias("_p"), own.alias("_n")).unionByName(
        current.select("feature", "value", F.col(period).cast("string").alias("_p"), F.lit(1).cast("bigint").alias("_n")))
    return both.groupBy("feature", "value").agg(
        F.sum(F.when(F.col("_p").isNull(), F.col("_n")).otherwise(0)).alias("n_ref"),
        *[F.count_if(F.col("_p") == p).alias(f"n_{i}") for i, p in enumerate(periods)])


# -- counted references ----------------------------------------------------------

PROFILE = "feature string, text string, number double, n long"


def value_counts(df: DataFrame, categorical: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """(feature, text, number, n): how often every value of every feature occurs, a mergeable profile of ``df``.

    One scan and one shuffle of counts; a value that fills a third of the rows is one row per task.
    """
    parts = []
    if categorical:
        parts.append(melt_text(df, categorical).select("feature", F.col("value").alias("text"), F.lit(None).cast("double").alias("number")))
    if numbers:
        parts.append(melt_numbers(df, numbers).select("feature", F.lit(None).cast("string").alias("text"), F.col("value").alias("number")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy("feature", "text", "number").agg(F.count("*").alias("n"))


def merged_counts(*profiles: DataFrame) -> DataFrame:
    """The profile of all rows that any of the profiles counted."""
    both = reduce(lambda a, b: a.unionByName(b), profiles)
    return both.groupBy("feature", "text", "number").agg(F.sum("n").alias("n"))


def profile_texts(profile: DataFrame, cols: Sequence[str]) -> DataFrame:
    return profile.where(F.col("text").isNotNull() & F.col("feature").isin(list(cols))).select("feature", F.col("text").alias("value"), "n")


def profile_numbers(profile: DataFrame, cols: Sequence[str]) -> DataFrame:
    return profile.where(F.col("number").isNotNull() & F.col("feature").isin(list(cols))).select("feature", F.col("number").alias("value"), "n")


def profile_mean(profile: DataFrame, feature: str) -> Column:
    """Mean of a number of the profile, as a scalar subquery."""
    rows = profile_numbers(profile, [feature])
    return rows.agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("v")).scalar()


def _deviations(ref: DataFrame) -> DataFrame:
    """(feature, _d): population standard deviation about the mean, of rows or of counted values."""
    if "n" not in ref.columns:
        return ref.groupBy("feature").agg(F.stddev_pop("value").alias("_d"))
    means = ref.groupBy("feature").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("_mean"))  # one row per feature
    off = F.col("value") - F.col("_mean")
    return ref.join(means, "feature").groupBy("feature").agg(F.sqrt(F.sum(off * off * F.col("n")) / F.sum("n")).alias("_d"))


def _js(i: int) -> Column:
    """Jensen-Shannon distance (square root, natural log) from counts and totals, as an aggregate.

    Null when either side has no rows.
    """
    p, q = F.try_divide("n_ref", "n_ref_total"), F.try_divide(f"n_{i}", f"n_{i}_total")
    m = (p + q) / 2
    term = lambda x: F.when(x > 0, x * F.log(x / m)).otherwise(F.lit(0.0))
    both = (F.max("n_ref_total") > 0) & (F.max(f"n_{i}_total") > 0)
    return F.when(both, F.sqrt(F.greatest(F.sum(term(p) + term(q)) / 2, F.lit(0.0))))


def _by_period(wide: DataFrame, periods: Sequence[str], period: str, **cols: str) -> DataFrame:
    """One row per (feature, period) from columns suffixed with the period's position."""
    items = [F.struct(F.lit(p).alias(period), *[F.col(f"{src}_{i}").alias(out) for out, src in cols.items()],
                      F.col("n_ref_values")) for i, p in enumerate(periods)]
    return wide.select("feature", F.explode(F.array(*items)).alias("r")).select("feature", "r.*")


def text_distances(reference: DataFrame, current: DataFrame, cols: Sequence[str], period: str,
                   periods: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance of categorical columns: (feature, period, js)."""
    return text_count_distances(melt_text(reference, cols), melt_text(current, cols, [period]), period, periods)


def text_count_distances(ref: DataFrame, cur: DataFrame, period: str, periods: Sequence[str]) -> DataFrame:
    """The same of melted features; the reference may come counted."""
    counts = side_counts(ref, cur, period, periods)
    sides = ["n_ref", *[f"n_{i}" for i in range(len(periods))]]
    totals = counts.groupBy("feature").agg(*[F.sum(n).alias(f"{n}_total") for n in sides])  # one row per feature
    wide = counts.join(totals, "feature").groupBy("feature").agg(
        *[_js(i).alias(f"js_{i}") for i in range(len(periods))],
        F.count_if(F.col("n_ref") > 0).alias("n_ref_values"))
    return _by_period(wide, periods, period, js="js")


def number_distances(ref: DataFrame, cur: DataFrame, period: str, periods: Sequence[str]) -> DataFrame:
    """Both distances of melted numeric features: (feature, period, js, w, n_ref_values).

    w is Wasserstein-1 over max(population standard deviation of the reference, 0.001). The
    cumulative counts of all periods come from one pass over value ranges, balanced over
    both sides. The deviation is taken about the mean, so a large offset costs no digits. A side
    without rows gives null.
    """
    ranges = fan_out(ref.sparkSession)
    cuts = split_points(ref.select("value").unionByName(cur.select("value")), "value", ranges)
    sides = ["n_ref", *[f"n_{i}" for i in range(len(periods))]]
    run = running_sums(side_counts(ref, cur, period, periods), ["feature"], "value", sides, ranges, cuts)
    cdf = lambda n: F.try_divide(f"{n}_upto", f"{n}_total")
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    sums = run.groupBy("feature").agg(
        *[_js(i).alias(f"js_{i}") for i in range(len(periods))],
        *[F.sum(F.abs(cdf("n_ref") - cdf(f"n_{i}")) * step).alias(f"_w_{i}") for i in range(len(periods))],
        F.count_if(F.col("n_ref") > 0).alias("n_ref_values"))
    wide = sums.join(_deviations(ref), "feature", "left").withColumn("_d", F.greatest("_d", F.lit(0.001)))
    wide = wide.select("*", *[(F.col(f"_w_{i}") / F.col("_d")).alias(f"w_{i}") for i in range(len(periods))])
    return _by_period(wide, periods, period, js="js", w="w")


def js_distance(reference: DataFrame, current: DataFrame, cols: Sequence[str], period: str,
                periods: Sequence[str]) -> DataFrame:
    return text_distances(reference, current, cols, period, periods).select(
        period, "feature", F.col("js").alias("distance"))


def wasserstein(reference: DataFrame, current: DataFrame, cols: Sequence[str], period: str,
                periods: Sequence[str]) -> DataFrame:
    ref, cur = melt_numbers(reference, cols), melt_numbers(current, cols, [period])
    return number_distances(ref, cur, period, periods).select(period, "feature", F.col("w").alias("distance"))


def feature_scores(reference: DataFrame, current: DataFrame, period: str, periods: Sequence[str],
                   categorical: Sequence[str], numbers: Sequence[str], ref_extra: DataFrame | None = None,
                   cur_extra: DataFrame | None = None) -> DataFrame:
    """(period, feature, score, test_method) of all features.

    Melted numbers of other frames (such as published scores) may ride along in the extras,
    so that they share the passes and the shuffle.
    """
    ref_numbers = melt_numbers(reference, numbers)
    return _scores(melt_text(reference, categorical) if categorical else None,
                   ref_numbers if ref_extra is None else ref_numbers.unionByName(ref_extra),
                   current, period, periods, categorical, numbers, cur_extra)


def profile_scores(profile: DataFrame, current: DataFrame, period: str, periods: Sequence[str], categorical: Sequence[str],
                   numbers: Sequence[str], cur_extra: DataFrame | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """``feature_scores`` against a counted reference; ``extra`` names its numbers that ``cur_extra`` holds."""
    return _scores(profile_texts(profile, categorical), profile_numbers(profile, [*numbers, *extra]), current, period, periods, categorical,
                   numbers, cur_extra)


def _scores(ref_texts: DataFrame | None, ref_numbers: DataFrame, current: DataFrame, period: str, periods: Sequence[str],
            categorical: Sequence[str], numbers: Sequence[str], cur_extra: DataFrame | None) -> DataFrame:
    by_js, by_w = F.lit("Jensen-Shannon distance"), F.lit("Wasserstein distance (normed)")
    parts = []
    if categorical:
        parts.append(text_count_distances(ref_texts, melt_text(current, categorical, [period]), period, periods).select(
            period, "feature", F.col("js").alias("score"), by_js.alias("test_method")))
    cur = melt_numbers(current, numbers, [period])
    if cur_extra is not None:
        cur = cur.unionByName(cur_extra)
    if numbers or cur_extra is not None:
        few = F.col("n_ref_values") <= FEW_VALUES
        parts.append(number_distances(ref_numbers, cur, period, periods).select(
            period, "feature", F.when(few, F.col("js")).otherwise(F.col("w")).alias("score"),
            F.when(few, by_js).otherwise(by_w).alias("test_method")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def feature_drift(reference: DataFrame, current: DataFrame, period: str, periods: Sequence[str],
                  categorical: Sequence[str], numeric: Sequence[str], interaction: Sequence[str] = (),
                  limit: float = DRIFT_LIMIT) -> DataFrame:
    """Drift table: period, feature, type, detected, score, method, threshold.

    Categorical features use the Jensen-Shannon distance, numeric ones the normed
    Wasserstein distance unless the reference has only a few distinct values. The limit is
    compared with the unrounded score.
    """
    return drift_table(feature_scores(reference, current, period, periods, categorical, [*numeric, *interaction]), period, categorical,
                       interaction, limit)


def drift_table(scores: DataFrame, period: str, categorical: Sequence[str], interaction: Sequence[str] = (), limit: float = DRIFT_LIMIT) -> DataFrame:
    """Scores of all features with their type and verdict."""
    return scores.select(
        period, "feature", _kind(categorical, interaction).alias("feature_type"),
        F.coalesce(F.col("score") >= limit, F.lit(False)).alias("drift_detected"), F.round("score", 4).alias("drift_score"), "test_method",
        F.lit(limit).alias("threshold"))


def _kind(categorical: Sequence[str], interaction: Sequence[str]) -> Column:
    f = F.col("feature")
    out = F.lit("numerical")
    if interaction:
        out = F.when(f.isin(list(interaction)), "interaction").otherwise(out)
    if categorical:
        out = F.when(f.isin(list(categorical)), "categorical").otherwise(out)
    return out


def prediction_drift(reference: DataFrame, current: DataFrame, score: str, period: str, periods: Sequence[str],
                     limit: float = DRIFT_LIMIT) -> DataFrame:
    """Score distribution of each period against a frozen reference, with both means."""
    w = wasserstein(reference, current, [score], period, periods).select(period, "distance")
    means = current.groupBy(period).agg(F.avg(score).alias("cur_mean"), F.count("*").alias("n_scored"))
    ref_mean = reference.agg(F.avg(score).alias("v")).scalar()
    return w.join(means, period).select(
        period, "n_scored", F.round("distance", 4).alias("prediction_drift_score"),
        F.lit(limit).alias("prediction_drift_threshold"),
        F.coalesce(F.col("distance") >= limit, F.lit(False)).alias("prediction_drift_detected"),
        F.round(ref_mean, 4).alias("ref_pred_mean"), F.round("cur_mean", 4).alias("cur_pred_mean"))
