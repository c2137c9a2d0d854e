import math
from datetime import date

import numpy as np
import pytest
from conftest import one
from pyspark.sql import functions as F

from linegauge.operators import rates, stats, timeseries
from linegauge.plans import kpi


def closed_p(t, n):
    """Two-sided p-value for a whole number of degrees of freedom, by the finite trigonometric sums."""
    angle = math.atan(abs(t) / math.sqrt(n))
    term, total = 1.0 if n % 2 == 0 else math.cos(angle), 0.0
    for k in range(n // 2):
        total += term
        term *= math.cos(angle) ** 2 * ((2 * k + 1) / (2 * k + 2) if n % 2 == 0 else (2 * k + 2) / (2 * k + 3))
    return 1 - (math.sin(angle) * total if n % 2 == 0 else 2 / math.pi * (angle + math.sin(angle) * total))


def test_t_distribution_against_closed_forms(spark):
    # (t, df, p): table values beside the closed forms
    cases = [(1.0, 1.0, 0.5), (math.sqrt(2), 2.0, 1 - math.sqrt(0.5)), (2.228138852, 10.0, 0.05), (1.959963985, 1e7, 0.05000003), (0.0, 5.0, 1.0),
             (1e200, 3.0, 0.0), (float("inf"), 3.0, 0.0), (None, 3.0, None), (1.0, None, None), (1.0, 0.0, None), (float("nan"), 3.0, None)]
    cases += [(t, float(n), closed_p(t, n)) for n in (1, 2, 3, 4, 5, 7, 29, 30, 101, 1000) for t in (-0.3, 0.7, 1.5, 1.9, 2.5, 7.0)]
    df = spark.createDataFrame(cases, "t double, df double, want double").withColumn("p", stats.p_two_sided(F.col("t"), F.col("df")))
    for r in df.collect():
        assert r["p"] == (None if r["want"] is None else pytest.approx(r["want"], abs=2e-8)), r
    assert "Python" not in df._jdf.queryExecution().toString()


def test_welch(spark):
    a, b = [1.0, 2.0, 3.0, 4.0, 5.0], [2.0, 4.0, 6.0, 8.0, 10.0, 12.0]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b], "g string, v double")
    r = one(stats.welch(df, "v", F.col("g") == "a", F.col("g") == "b"))
    va, vb = np.var(a, ddof=1) / 5, np.var(b, ddof=1) / 6
    assert r["t"] == pytest.approx((3 - 7) / math.sqrt(va + vb))
    assert r["df"] == pytest.approx((va + vb) ** 2 / (va ** 2 / 4 + vb ** 2 / 5))
    assert 0.02 < r["p"] < 0.08


def test_correlations_and_regression(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=200)
    y = 3 * x + rng.normal(size=200)
    t = (y > 0).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in zip(x, y, t)], "x double, y double, t int")
    m = {(r["a"], r["b"]): r["corr"] for r in stats.correlation_matrix(df, ["x", "y", "t"]).collect()}
    assert m[("x", "y")] == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert [r["column"] for r in stats.correlation_with(df, "t", ["x", "y"]).collect()] == ["y", "x"]
    r = one(stats.regression(df, "y", "x"))
    slope, intercept = np.polyfit(x, y, 1)
    assert (r["slope"], r["intercept"]) == (pytest.approx(slope), pytest.approx(intercept))
    pb = {r["column"]: r for r in stats.point_biserial(df, "t", ["x"]).collect()}["x"]
    assert pb["signal"] and pb["p"] < 1e-6 and pb["r"] == pytest.approx(np.corrcoef(t, x)[0, 1])


def test_categorical_signal(spark):
    df = spark.createDataFrame([("a", "k", 1), ("a", "k", 1), ("b", "k", 0), (None, "k", 1)], "c string, d string, y int")
    got = {r["column"]: r for r in stats.categorical_signal(df, "y", ["c", "d"]).collect()}
    assert (got["c"]["range"], got["c"]["signal"], got["c"]["n_groups"]) == (1.0, "YES", 2)
    assert (got["d"]["range"], got["d"]["signal"]) == (0.0, "NO")


def test_series_summary_equals_numpy(spark):
    rng = np.random.default_rng(2)
    n = [int(v) for v in rng.integers(50, 150, 30)]
    months = [date(2022 + i // 12, 1 + i % 12, 1) for i in range(30)]
    series = spark.createDataFrame(list(zip(months, n)), "m date, n long")
    r = one(timeseries.series_summary(series, "m", "n"))
    s = np.array(n, float)
    assert (r["mean"], r["median"], r["std"]) == (pytest.approx(s.mean()), pytest.approx(np.median(s)),
                                                  pytest.approx(s.std(ddof=1)))
    assert (r["min_month"], r["max_month"]) == (months[int(s.argmin())], months[int(s.argmax())])
    assert r["acf1"] == pytest.approx(np.corrcoef(s[1:], s[:-1])[0, 1])
    assert r["slope"] == pytest.approx(np.polyfit(range(30), s, 1)[0])
    of_year = [np.mean([v for v, m in zip(n, months) if m.month == k]) for k in range(1, 13)]
    assert r["seasonal_strength"] == pytest.approx(np.var(of_year, ddof=1) / s.var(ddof=1))
    short = one(timeseries.series_summary(series.limit(5), "m", "n"))
    assert short["seasonal_strength"] is None


def test_weighted_and_mean_rates_differ(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 0, 90), ("b", 0, 0)], "g string, f int, i int")
    got = {r["g"]: r for r in rates.rates_by(df, ["g"], "f", "i", 2).collect()}
    assert (got["a"]["weighted_rate"], got["a"]["mean_rate"], got["a"]["low_n"]) == (0.01, 0.05, False)
    assert (got["b"]["weighted_rate"], got["b"]["mean_rate"], got["b"]["n"], got["b"]["low_n"]) == (0.0, None, 0, True)
    assert got["b"]["overall_mean"] == 0.05


def test_week_window_leaves_the_last_day_out(spark):
    df = spark.createDataFrame(
        [("2024-03-15 10:00:00", 100, 5), ("2024-03-14 23:00:00", 10, 1), ("2024-03-08 00:00:00", 20, 2),
         ("2024-03-07 23:59:59", 40, 4), ("2024-02-10 08:00:00", 8, 0), ("2023-03-20 08:00:00", 16, 1),
         ("2022-04-01 00:00:00", 32, 3)],
        "ts string, i int, f int").withColumn("ts", F.col("ts").cast("timestamp"))
    df = df.withColumn("m", F.trunc("ts", "month"))
    last = rates.scalars_of(df, {"m": F.max("m"), "d": F.date_trunc("day", F.max("ts"))})
    windows = timeseries.period_windows(last["m"], last["d"], F.col("m"), F.col("ts"))
    got = {(r["window"], r["period"]): r["i"] for r in timeseries.compare_periods(df, windows, {"i": F.col("i")}).collect()}
    assert got == {("week", "current"): 30.0, ("week", "prior"): 40.0, ("month", "current"): 170.0,
                   ("month", "prior"): 8.0, ("ttm", "current"): 178.0, ("ttm", "prior"): 48.0}


def test_chart_tables(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), "a", 10, 1), (date(2024, 1, 1), "b", 10, 3), (date(2024, 3, 1), "a", 5, 1),
                                (date(2022, 1, 1), "a", 5, 5)], "m date, d string, i int, f int")
    stack = {(r["m"], r["d"]): (r["value"], r["share"], r["offset"]) for r in kpi.monthly_stack(df, "m", "d", "f").collect()}
    assert stack[(date(2024, 1, 1), "b")] == (3, 0.75, 1) and (date(2022, 1, 1), "a") not in stack
    lines = {(r["d"], r["m"]): r["rate"] for r in kpi.rate_lines(df, "m", "d", "i", "f").collect()}
    assert len(lines) == 6 and lines[("b", date(2024, 2, 1))] is None and lines[("a", date(2024, 3, 1))] == 0.2
    assert one(kpi.monthly_rate(df.where("d = 'b'"), "m", "i", "f"))["rate"] == 0.3
    split = one(kpi.cost_split(spark.createDataFrame([(1, 3.0, 1.0)], "m int, a double, b double"), "m", "a", "b"))
    assert (split["material_share"], split["labor_share"]) == (0.75, 0.25)
