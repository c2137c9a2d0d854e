import re
from collections import Counter
from datetime import date, datetime


from conftest import one, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linegauge.operators import profile, quality as q


def test_basic_checks(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, None, -1.0), (2, "b", None), (None, "z", 60.0)],
                               "k int, c string, x double")
    got = {r["column"]: (r["total"], r["failed"], r["status"]) for r in q.not_null(df, "t", ["k", "c"]).collect()}
    assert got == {"k": (4, 1, "FAIL"), "c": (4, 1, "FAIL")}
    assert one(q.unique(df, "t", "k"))["failed"] == 1
    assert one(q.accepted_values(df, "t", "c", ["a", "b"]))["failed"] == 1
    scoped = one(q.accepted_values(df, "t", "c", ["a", "b"], F.col("x") < 10))
    assert (scoped["total"], scoped["failed"], scoped["status"]) == (2, 0, "PASS")
    assert one(q.expression_holds(df, "t", "x > 0", F.col("x") > 0))["failed"] == 2  # false and null
    b = one(q.bounds(df, "t", {"x": (0, 50)}))
    assert (b["below"], b["above"], b["min"], b["max"], b["violation_pct"]) == (1, 1, -1.0, 60.0, 50.0)
    parent = spark.createDataFrame([(1,)], "k int")
    rel = one(q.relationship(df, "t", "k", parent, "k"))
    assert (rel["total"], rel["failed"]) == (3, 1)
    key = one(q.key_report(df, "t", "k"))
    assert (key["total"], key["unique_values"], key["dupes"], key["status"]) == (4, 2, 2, "FAIL")
    nulls = {r["column"]: r["status"] for r in q.null_rate(df, "t", {"k": True, "c": False}).collect()}
    assert nulls == {"k": "STRUCT", "c": "FAIL"}


def test_checks_of_an_empty_frame(spark):
    empty = spark.createDataFrame([], "k int, x double")
    assert one(q.not_null(empty, "t", ["k"]))["status"] == "PASS"
    assert one(q.unique(empty, "t", "k"))["total"] == 0
    assert one(q.bounds(empty, "t", {"x": (0, 1)}))["min"] is None


def test_splits_and_balance(spark):
    df = spark.createDataFrame([("train", datetime(2024, 1, 1), 1), ("train", datetime(2024, 2, 1), 0),
                                ("validation", datetime(2024, 2, 1), 1), ("test", datetime(2024, 5, 1), 1)],
                               "split string, ts timestamp, y int")
    order = {r["split"]: r["in_order"] for r in q.split_order(df, "split", "ts", ["train", "validation", "test"]).collect()}
    assert order == {"train": True, "validation": False, "test": True}
    bal = one(q.class_balance(df, "y", 0.2, 0.8, 3))
    assert (bal["positives"], bal["negatives"], bal["odds"], bal["class_weight"]) == (3, 1, 3.0, 1 / 3)
    assert bal["balance_ok"] and bal["size_ok"]


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "a")], "k int, c string")
    got = {r["column"]: (r["present"], r["type_ok"]) for r in q.schema_check(
        df, {"k": T.NumericType, "c": T.IntegerType, "no": None}).collect()}
    assert got == {"k": (True, True), "c": (True, False), "no": (False, False)}
    assert q.same_columns(df, df.withColumn("z", F.lit(1))) == (False, [], ["z"])


def test_feature_quality(spark):
    ref = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    cur = spark.createDataFrame([("a", 1.0), ("new", None), ("new", 3.0), (None, 4.0)], "c string, x double")
    got = {r["feature"]: r for r in q.feature_quality(ref, cur, ["c"], ["x"]).collect()}
    assert (got["c"]["null_pct"], got["c"]["n_distinct"], got["c"]["unseen"]) == (25.0, 2, 1)
    assert (got["x"]["null_pct"], got["x"]["n_distinct"], got["x"]["unseen"]) == (25.0, 3, 0)


def test_schema_summary(spark):
    long = "x" * 200
    df = spark.createDataFrame([(1, long, None), (2, long + "y", None), (2, None, None)], "k int, t string, n double")
    got = {r["column"]: r for r in profile.schema_summary(df).collect()}
    assert (got["k"]["n_unique"], got["k"]["null_severity"], got["k"]["sample"]) == (2, None, "1")
    assert (got["t"]["n_unique"], got["t"]["null_count"], got["t"]["null_severity"]) == (2, 1, "HIGH")
    assert got["t"]["sample"] == "x" * 60
    assert got["n"]["sample"] == "(all null)" and got["n"]["dtype"] == "double"


def test_spelling_variants(spark):
    df = spark.createDataFrame([("Burr",), ("burr",), ("BURR",), ("Dim",), (" Dim",), (" Dim",), (None,)], "c string")
    case = one(profile.case_variants(df, ["c"]))
    assert (case["folded"], case["variants"], case["n_rows"]) == ("burr", 3, 3)
    space = one(profile.whitespace_variants(df, ["c"]))
    assert (space["value"], space["n"], space["rows_affected"]) == (" Dim", 2, 2)


def test_type_inference(spark):
    data = [("Yes", str(i), f"2024-01-{i + 1:02d}", "x", f"w{i}", None) for i in range(20)]
    data += [("no", "n/a", "2024-02-01", "y", "w", None)]
    df = spark.createDataFrame(data, "b string, n string, d string, c string, t string, z string")
    got = {r["column"]: (r["intended_type"], round(r["confidence"], 1), r["source"]) for r in profile.infer_types(
        df, list("bndctz"), {"t": "id"}).collect()}
    assert got["b"] == ("boolean", 100.0, "inferred")
    assert got["n"] == ("numeric", 95.2, "inferred")
    assert got["d"] == ("datetime", 100.0, "inferred")
    assert got["c"] == ("categorical", 100.0, "inferred")
    assert got["t"] == ("id", 100.0, "override")
    assert "z" not in got  # nothing to infer from


def _near_by_brute_force(data, cols):
    exact = Counter(data)
    out = {}
    for i, c in enumerate(cols):
        rest = Counter(r[:i] + r[i + 1:] for r in data)
        n = sum(1 for r in data if rest[r[:i] + r[i + 1:]] > 1 and exact[r] == 1)
        if n:
            out[c] = n
    return out


def test_duplicates_equal_brute_force(spark):
    import random
    rng = random.Random(5)
    data = [(rng.randint(0, 3), rng.choice(["a", "b", None]), rng.choice([0.5, 1.5, None])) for _ in range(60)]
    data += [(9, "hot", 1.0)] * 40
    df = spark.createDataFrame(data, "x int, y string, z double")
    sizes = Counter(data)
    exact = one(profile.exact_duplicates(df, ["x", "y", "z"]))
    assert exact["total_rows"] == 100
    assert exact["dup_rows"] == sum(n for n in sizes.values() if n > 1)
    got = {r["differing_col"]: r["dup_rows"] for r in profile.near_duplicates(df, ["x", "y", "z"]).collect()}
    assert got == _near_by_brute_force(data, ["x", "y", "z"])


def test_near_duplicates_shuffle_prints_only(spark, capsys):
    rows = [(1, "a", 0.5, None), (1, "a", 0.5, None), (1, "b", 0.5, None), (None, "a", 1.0, "x"), (2, "a", 1.0, "x"), (3, "q", None, "a"), (3, "q", 7.0, None)]
    df = spark.createDataFrame(rows, "i int, s string, d double, t string")
    out = profile.near_duplicates(df, df.columns)
    assert {r["differing_col"]: r["dup_rows"] for r in out.collect()} == _near_by_brute_force(rows, df.columns)
    out.explain("extended")
    plan = capsys.readouterr().out.partition("== Physical Plan ==")[2]
    dealt = re.findall(r"hashpartitioning\(([^)]*), \d+\)", plan)
    assert len(dealt) >= 5 and all(re.sub(r"#\d+L?", "", d) == "h1, h2" for d in dealt)
    assert "Generate" not in plan and profile.near_duplicates(df.limit(0), df.columns).isEmpty()


def test_fold_case_is_optional(spark):
    df = spark.createDataFrame([("A", 1), (" a", 1)], "c string, n int")
    assert one(profile.exact_duplicates(df, ["c", "n"]))["dup_rows"] == 0
    assert one(profile.exact_duplicates(df, ["c", "n"], fold_case=True))["dup_rows"] == 2


def test_agreement_and_advice(spark):
    t = lambda m: datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([("w1", 5, t(0), "x"), ("w1", 6, t(30), "X "), ("w2", 1, t(0), "q"), ("w2", 1, t(0), "q"),
                                ("w3", 1, t(0), "alone")], "k string, n int, ts timestamp, c string")
    got = {r["column"]: r for r in profile.field_agreement(df, ["k"], ["n"], ["ts"], ["c"]).collect()}
    assert (got["n"]["pct_identical"], got["n"]["max_diff"], got["n"]["note"]) == (50.0, 1.0, "minor variation")
    assert (got["ts"]["max_diff"], got["ts"]["p95_diff"], got["ts"]["note"]) == (30.0, 28.5, "minor variation")
    assert (got["c"]["max_diff"], got["c"]["note"]) == (None, "always identical")
    advice = profile.dedup_advice(profile.field_agreement(df, ["k"], ["n"], ["ts"], ["c"]), 1)
    assert one(advice)["advice"] == "keep first by key"
    assert one(profile.dedup_advice(profile.field_agreement(df, ["k"], ["n"]), 0))["advice"] == "select distinct"


def test_sample_groups(spark):
    df = spark.createDataFrame([(i % 4, i) for i in range(9)] + [(7, 100)], "k int, id int")
    got = profile.sample_groups(df, ["k"], "id", 2).collect()
    assert sorted((r["dup_group"], r["id"]) for r in got) == [(1, 0), (1, 4), (1, 8), (2, 1), (2, 5)]
    assert {r["group_size"] for r in got} == {2, 3}


def test_month_type_of_gaps(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 3, 1),), (None,)], "m date")
    assert rows(q.month_gaps(df, "m")) == [(date(2024, 2, 1),)]
