import random
from datetime import date, timedelta

from conftest import one, rows
from pyspark.sql import functions as F

from linegauge.operators import joins


def test_eligible_lots_equal_brute_force(spark):
    rng = random.Random(3)
    start = date(2023, 1, 1)
    lots = [(rng.choice(["x", "x", "y"]), start + timedelta(days=rng.randint(0, 40)), f"L{i:04d}") for i in range(400)]
    lots += [("x", start + timedelta(days=20), f"H{i:04d}") for i in range(200)]  # one day holds a third
    demand = [(i, rng.choice(["x", "y", "none"]), start + timedelta(days=rng.randint(-5, 50))) for i in range(200)]
    out = joins.eligible_lots(spark.createDataFrame(demand, "id int, m string, d date"),
                              spark.createDataFrame(lots, "m string, r date, lot string"), "m", "d", "r", "lot", keep=60)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(demand)
    for i, m, d in demand:
        ok = sorted((r, lot) for lm, r, lot in lots if lm == m and r <= d)[-60:]
        row = got[i]
        assert row["eligible"] == len(ok)
        assert row["newest_lot"] == (ok[-1][1] if ok else None)
        assert row["newest_receipt"] == (ok[-1][0] if ok else None)
        assert row["oldest_lot"] == (ok[0][1] if ok else None)


def test_key_match_counts_nulls_and_orphans(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("q",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "p string")
    got = one(joins.key_match(child, "k", parent, "p"))
    assert (got["total_rows"], got["matched_rows"], got["null_rows"]) == (5, 3, 1)
    assert (got["distinct_keys"], got["orphan_keys"], got["sample_orphan"]) == (3, 1, "q")
    assert got["row_match_pct"] == 60.0
    assert rows(joins.orphans(child, "k", parent, "p")) == [("q", 1)]
    many = spark.createDataFrame([(f"z{i}",) for i in range(9)], "k string")
    assert [r[0] for r in rows(joins.orphan_sample(many, "k", parent, "p"))] == [f"z{i}" for i in range(6)]


def test_lots_without_day_or_group_are_never_eligible(spark):
    day = date(2023, 1, 5)
    lots = spark.createDataFrame([("x", day, "L1"), ("x", None, "L2"), (None, day, "L3"), ("x", day, "L4")], "m string, r date, lot string")
    got = one(joins.eligible_lots(spark.createDataFrame([(1, "x", day)], "id int, m string, d date"), lots, "m", "d", "r", "lot"))
    assert (got["eligible"], got["newest_lot"], got["oldest_lot"]) == (2, "L4", "L1")


def test_spine_and_gaps(spark):
    series = spark.createDataFrame([(date(2023, 11, 1), 5), (date(2024, 2, 1), 7)], "m date, n int")
    spine = joins.month_spine(series, "m")
    assert sorted(rows(joins.on_spine(series, "m", spine))) == [
        (date(2023, 11, 1), 5), (date(2023, 12, 1), None), (date(2024, 1, 1), None), (date(2024, 2, 1), 7)]
    from linegauge.operators.quality import month_gaps
    assert sorted(r[0] for r in rows(month_gaps(series, "m"))) == [date(2023, 12, 1), date(2024, 1, 1)]


def test_join_first_and_renamed(spark):
    left = spark.createDataFrame([(1, "s"), (2, "t")], "k int, v string")
    right = spark.createDataFrame([(1, "b"), (1, "a")], "k int, v string")
    assert sorted(rows(joins.join_renamed(left, right.where("v = 'a'"), "k"))) == [(1, "s", "a"), (2, "t", None)]
    out = joins.join_first(left.withColumnRenamed("v", "w"), right, "k", "v")
    assert sorted(rows(out)) == [(1, "s", "a"), (2, "t", None)]


def test_totals_default_to_zero(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    facts = spark.createDataFrame([(1, 2.5), (1, 1.0)], "k int, c double")
    assert sorted(rows(joins.with_total(left, facts, "k", "c", "t"))) == [(1, 3.5), (2, 0.0)]
    segment = joins.in_segment(facts, left.withColumn("z", F.lit(True)), "k", F.col("z"))
    assert segment.count() == 2
