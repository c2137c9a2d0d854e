"""Operators that avoid a global order must equal the plain computation, hot keys included."""

import math
from bisect import bisect_right

import numpy as np
import pytest
from pyspark.sql import functions as F

from linegauge.operators import dedup, quantiles
from linegauge.operators.prefix import range_number, running_sums, split_points


def _skewed(n=4000, seed=1):
    """A third of all rows under one key, half of them with one value; some null keys."""
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.34, "hot", rng.choice(list("abcdef"), n))
    values = np.where(rng.random(n) < 0.3, 7.0, np.round(rng.lognormal(2, 2, n), 3))
    return [(None if k == "f" else str(k), float(v)) for k, v in zip(keys, values)]


@pytest.mark.parametrize("ranges", [0, 1, 3, 16, 64])
def test_exact_quantiles_equal_numpy(spark, ranges):
    data = _skewed()
    df = spark.createDataFrame(data + [("a", None)], "k string, v double").repartition(5)
    probs = {"p0": 0.0, "p01": 0.01, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "v", probs, ranges).collect()}
    assert set(got) == {k for k, _ in data}
    for key, row in got.items():
        values = [v for k, v in data if k == key]
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantile_without_key_and_of_nothing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 102)], "v double")
    assert quantiles.exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == 51.0
    empty = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_quantiles(empty, [], "v", {"m": 0.5}).count() in (0, 1)


@pytest.mark.parametrize("ranges", [0, 2, 32])
def test_running_sums_equal_plain_accumulation(spark, ranges):
    data = _skewed()
    df = spark.createDataFrame(data, "k string, v double")
    cells = df.groupBy("k", "v").agg(F.count("*").alias("n"))
    got = running_sums(cells, ["k"], "v", ["n"], ranges).collect()
    for key in {k for k, _ in data}:
        values = sorted(v for k, v in data if k == key)
        mine = sorted((r for r in got if r["k"] == key), key=lambda r: r["v"])
        assert [r["v"] for r in mine] == sorted(set(values))
        for i, r in enumerate(mine):
            assert r["n_upto"] == np.searchsorted(values, r["v"], side="right")
            assert r["n_total"] == len(values)
            assert r["next_v"] == (mine[i + 1]["v"] if i + 1 < len(mine) else None)


def test_range_number_of_many_cuts(spark):
    df = spark.createDataFrame([(v / 2,) for v in range(-4, 9000)] + [(float("inf"),), (float("-inf"),), (float("nan"),), (None,)], "v double")
    for n in (0, 1, 2, 3, 7, 8, 511, 4001):
        cuts = [float(i) for i in range(n)]
        for r in df.select("v", range_number("v", cuts).alias("r")).collect():
            above = r["v"] is None or math.isnan(r["v"])
            assert r["r"] == (n if above else bisect_right(cuts, r["v"])), (n, r)


def test_a_range_number_is_as_short_for_many_cuts_as_for_few(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("v"))
    nodes = lambda n: df.select(range_number("v", [float(i) for i in range(n)]).alias("r"))._jdf.queryExecution().analyzed().toString().count("CASE")
    assert nodes(4000) == nodes(10) == 1


def test_split_points_cut_into_even_parts(spark):
    values = spark.range(0, 40_000, 1, 300).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    cuts = split_points(values, "v", 50)
    assert len(cuts) == 49 and cuts == sorted(cuts)
    sizes = values.groupBy(range_number("v", cuts).alias("r")).count().collect()
    assert len(sizes) == 50 and max(r["count"] for r in sizes) < 2 * 800
    assert split_points(values.limit(0), "v", 5) == [] and split_points(values, "v", 1) == []
    assert split_points(values.select(F.lit(None).cast("double").alias("v")), "v", 5) == []


def test_box_stats_and_histogram(spark):
    data = [("g", float(v)) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]]
    df = spark.createDataFrame(data, "g string, v double")
    box = quantiles.box_stats(df, ["g"], "v").first()
    assert (box["q1"], box["median"], box["q3"]) == (3.25, 5.5, 7.75)
    assert (box["whisker_low"], box["whisker_high"], box["outliers"], box["n"]) == (1.0, 9.0, 1, 10)
    hist = {r["bin"]: r for r in quantiles.histogram(df, "v", 0.0, 10.0, 5, density=True).collect()}
    assert {b: r["n"] for b, r in hist.items()} == {0: 1, 1: 2, 2: 2, 3: 2, 4: 2}
    assert sum(r["density"] * 2 for r in hist.values()) == pytest.approx(1)
    own = {r["bin"]: r["n"] for r in quantiles.histogram(df, "v", bins=3).collect()}
    assert own == {0: 9, 2: 1}  # the column's own range: no value is left out
    same = quantiles.histogram(df.limit(1).withColumn("v", F.lit(4.0)), "v", bins=3).first()
    assert (same["bin"], same["n"], same["bin_start"]) == (0, 1, 4.0)
    assert quantiles.histogram(df.limit(0), "v").isEmpty()


def test_box_stats_without_keys(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 100]] + [(None,)], "v double")
    box = quantiles.box_stats(df, [], "v").first()
    assert (box["q1"], box["median"], box["q3"], box["outliers"], box["n"]) == (3.25, 5.5, 7.75, 1, 10)


def test_keep_first_uses_text_order_by_default(spark):
    df = spark.createDataFrame([("w", "INSP-9"), ("w", "INSP-10"), ("z", None), ("z", "INSP-1")], "k string, i string")
    got = {r["k"]: r["i"] for r in dedup.keep_first(df, ["k"], "i").collect()}
    assert got == {"w": "INSP-10", "z": "INSP-1"}
    number = F.split("i", "-")[1].cast("int").asc_nulls_last()
    assert {r["k"]: r["i"] for r in dedup.keep_first(df, ["k"], number).collect()}["w"] == "INSP-9"
    plan = dedup.keep_first(df, ["k"], "i")._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_duplicate_marks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    marked = dedup.mark_duplicates(df, ["k", "v"])
    assert sorted((r["k"], r["is_duplicate"]) for r in marked.collect()) == [
        (1, True), (1, True), (2, True), (2, True), (3, False)]
    assert tuple(dedup.duplicate_rows(df).first()) == (5, 4, 3)
    assert dedup.duplicate_groups(df, ["k"]).count() == 2
