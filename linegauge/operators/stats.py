"""Correlation, regression and two-sample tests from one-pass aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, corr) for every pair of columns, pairwise non-null, in one aggregate."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(_d(a), _d(b)).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    items = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("corr"))
             for i, (a, b) in enumerate(pairs)]
    return wide.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def correlation_with(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Columns with their correlation with a target, strongest first."""
    wide = df.agg(*[F.corr(_d(c), _d(target)).alias(f"_{i}") for i, c in enumerate(cols)])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("corr")) for i, c in enumerate(cols)]
    return (wide.select(F.explode(F.array(*items)).alias("r")).select("r.*", F.abs("r.corr").alias("strength"))
            .orderBy(F.desc_nulls_last("strength"), "column"))


def regression(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.regr_slope(_d(y), _d(x)).alias("slope"), F.regr_intercept(_d(y), _d(x)).alias("intercept"),
        F.corr(_d(x), _d(y)).alias("r"), F.regr_count(_d(y), _d(x)).alias("n"))


# -- p-values: an expression on aggregated rows -----------------------------------

#: Half steps of the continued fraction; below 1e-14 after 50 at any degrees of freedom.
HALF_STEPS = 200
#: Steps by which the gamma functions' argument is raised before their ratio's series is used.
RAISED = 12


def _log_gamma_ratio(a: Column) -> Column:
    """ln(gamma(a + 1/2) / gamma(a)), without the difference of two large numbers."""
    z = a + RAISED
    series = F.log(z) / 2 - 1 / (8 * z) + 1 / (192 * z ** 3) - 1 / (640 * z ** 5) + F.lit(17.0) / (14336 * z ** 7)
    lowered = reduce(lambda x, y: x + y, [F.log((a + i) / (a + i + 0.5)) for i in range(RAISED)])
    return series + lowered


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, evaluated forwards by a fixed number of half steps."""
    def coefficient(k: Column) -> Column:
        m = F.floor(k / 2)
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(k % 2 == 0, even).otherwise(odd)

    def apart(v: Column) -> Column:  # from zero
        return F.when(F.abs(v) < 1e-300, F.lit(1e-300)).otherwise(v)

    def step(s: Column, k: Column) -> Column:
        d, c = 1 / apart(1 + coefficient(k) * s["d"]), apart(1 + coefficient(k) / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["value"] * c * d).alias("value"))

    first = 1 / apart(1 + coefficient(F.lit(1)))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("value"))
    return F.aggregate(F.sequence(F.lit(2), F.lit(HALF_STEPS)), start, step, lambda s: s["value"])


def p_two_sided(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t, in built-in functions; null where t or a positive df is missing."""
    a, b, square = df / 2, F.lit(0.5), t * t
    x, rest = df / (df + square), square / (df + square)
    front = F.exp(_log_gamma_ratio(a) - 0.5 * math.log(math.pi) - a * F.log1p(square / df) + b * F.log(rest))
    tail = F.when(x < (a + 1) / (a + b + 2), front * _beta_fraction(a, b, x) / a).otherwise(
        1 - front * _beta_fraction(b, a, rest) / b)
    known = (df > 0) & t.isNotNull() & ~F.isnan(t)
    return F.when(known & (t == 0), 1.0).when(known & (F.abs(t) > 1e150), 0.0).when(known, tail)


def welch(df: DataFrame, value: str, in_a: Column, in_b: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Welch's t, degrees of freedom and two-sided p of group a against group b."""
    a, b = F.when(in_a, _d(value)), F.when(in_b, _d(value))
    m = df.groupBy(*keys).agg(F.avg(a).alias("mean_a"), F.avg(b).alias("mean_b"), F.var_samp(a).alias("_va"),
                              F.var_samp(b).alias("_vb"), F.count(a).alias("n_a"), F.count(b).alias("n_b"))
    sa, sb = F.col("_va") / F.col("n_a"), F.col("_vb") / F.col("n_b")
    t = (F.col("mean_a") - F.col("mean_b")) / F.sqrt(sa + sb)
    dof = (sa + sb) ** 2 / (sa ** 2 / (F.col("n_a") - 1) + sb ** 2 / (F.col("n_b") - 1))
    out = m.select(*keys, "mean_a", "mean_b", "n_a", "n_b", t.alias("t"), dof.alias("df"))
    return out.withColumn("p", p_two_sided(F.col("t"), F.col("df")))


def point_biserial(df: DataFrame, target: str, cols: Sequence[str], min_r: float = 0.03,
                   max_p: float = 0.05) -> DataFrame:
    """Correlation of a 0/1 target with numeric columns, p-value and the signal rule."""
    y = _d(target)
    wide = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.corr(y, _d(c)).alias(f"_r{i}"), F.count(F.when(y.isNotNull() & _d(c).isNotNull(), 1)).alias(f"_n{i}"))])
    items = [F.struct(F.lit(c).alias("column"), F.col(f"_r{i}").alias("r"), F.col(f"_n{i}").alias("n"))
             for i, c in enumerate(cols)]
    out = wide.select(F.explode(F.array(*items)).alias("x")).select("x.*")
    r, dof = F.col("r"), F.col("n") - 2
    out = out.withColumn("t", r * F.sqrt(dof / (1 - r * r))).withColumn("p", p_two_sided(F.col("t"), dof))
    return out.withColumn("signal", F.coalesce((F.abs("r") > min_r) & (F.col("p") < max_p), F.lit(False)))


def categorical_signal(df: DataFrame, target: str, cols: Sequence[str], min_range: float = 0.02) -> DataFrame:
    """Spread of group rates of a 0/1 target per categorical column; YES above the limit."""
    y = _d(target)
    long = df.select(y.alias("_y"), *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        ["_y"], list(cols), "column", "value").where(F.col("value").isNotNull())
    rates = long.groupBy("column", "value").agg(F.avg("_y").alias("rate"))
    out = rates.groupBy("column").agg(F.count("*").alias("n_groups"), F.min("rate").alias("min_rate"),
                                      F.max("rate").alias("max_rate"))
    spread = F.col("max_rate") - F.col("min_rate")
    return out.withColumn("range", spread).withColumn("signal", F.when(spread > min_range, "YES").otherwise("NO"))


def feature_summary(df: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Type, null percentage, distinct values and correlation with the target, per feature."""
    from linegauge.operators.profile import schema_summary

    shape = schema_summary(df, [*numeric, *categorical]).select(
        F.col("column").alias("feature"), "null_pct", "n_unique")
    corr = correlation_with(df, target, numeric).select(F.col("column").alias("feature"), "corr")
    kind = F.when(F.col("feature").isin(list(numeric)), "numeric").otherwise("categorical")
    return shape.join(corr, "feature", "left").select("feature", kind.alias("kind"), "null_pct", "n_unique", "corr")
