
from conftest import one, rows
from pyspark.sql import functions as F

from linegauge.functions import codes, nested
from linegauge.functions import exprs as x

SHIFTS = [("Shift A", "06:00:00", "13:59:59"), ("Shift B", "14:00:00", "21:59:59")]


def _ts(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp").alias("t"))


def test_shift_windows_are_closed_to_the_microsecond(spark):
    df = _ts(spark, "2024-01-01 06:00:00", "2024-01-01 13:59:59", "2024-01-01 13:59:59.5", "2024-01-01 05:59:59",
             "2024-01-01 21:59:59", "2024-01-01 22:00:00", None)
    assert [r[0] for r in rows(df.select(x.clock_bucket("t", SHIFTS)))] == [
        "Shift A", "Shift A", None, None, "Shift B", None, None]


def test_hours_crossed_counts_boundaries(spark):
    df = spark.createDataFrame([("2024-01-01 13:50:00", "2024-01-01 14:10:00"),
                                ("2024-01-01 14:00:00", "2024-01-01 14:59:59"),
                                ("2024-01-01 02:10:00", "2024-01-01 00:50:00"), (None, "2024-01-01 00:50:00")],
                               "a string, b string")
    got = rows(df.select(x.hours_crossed(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))))
    assert [g[0] for g in got] == [1, 0, -2, None]


def test_period_end_day(spark):
    df = _ts(spark, "2026-01-31 00:00:00", "2026-01-31 09:00:00", "2026-02-01 00:00:00")
    whole = rows(df.select(x.in_period("t", "2026-01-01", "2026-01-31")))
    literal = rows(df.select(x.in_period("t", "2026-01-01", "2026-01-31", closed_at_midnight=True)))
    assert [w[0] for w in whole] == [True, True, False]
    assert [w[0] for w in literal] == [True, False, False]


def test_ratio_and_flags(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 3), (1, None)], "a int, b int")
    assert [r[0] for r in rows(df.select(x.ratio("a", "b")))] == [0.5, None, None, None]
    assert [r[0] for r in rows(df.select(x.flag(F.col("b") > 1)))] == [True, False, True, False]
    assert [r[0] for r in rows(df.select(x.flag(F.col("b") > 1, True)))] == [True, False, True, True]
    assert [r[0] for r in rows(df.select(x.ratio_or_zero("b", "a")))] == [2.0, 0.0, 0.0, None]


def test_right_closed_bucket_edges(spark):
    df = spark.createDataFrame([(0.65,), (0.6500001,), (0.75,), (0.7500001,), (0.0,), (None,)], "p double")
    got = [r[0] for r in rows(df.select(x.right_closed_bucket("p", [0.65, 0.75], ["Low", "Medium", "High"])))]
    assert got == ["Low", "Medium", "Medium", "High", "Low", None]


def test_change(spark):
    df = spark.createDataFrame([(12.0, 10.0), (8.0, 10.0), (1.0, 0.0), (5.0, -10.0)], "c double, p double")
    got = rows(df.select(x.relative_change("c", "p"), x.change_arrow("c", "p"), x.change_verdict("c", "p", True)))
    assert got == [(0.2, "up", "bad"), (-0.2, "down", "good"), (None, "", "neutral"), (1.5, "up", "bad")]


def test_text_helpers(spark):
    df = spark.createDataFrame([(" Ab ", None, "is_high_complexity", "cat__supplier", "16ga Steel")],
                               "a string, b string, c string, d string, e string")
    got = one(df.select(
        x.normalised("a").alias("n"), x.normalised("b").alias("z"), x.title_text("c").alias("t"),
        x.after_prefix("d").alias("p"), x.gauge_number("e").alias("g"), x.gauge_number("c").alias("no"),
        x.has_outer_space("a").alias("s"), x.composite_label("e", "b").alias("l"),
        x.fingerprint_text(["a", "b"], fold_case=True).alias("f"), x.minutes_between(
            F.lit("2024-01-01 00:01:30").cast("timestamp"), F.lit("2024-01-01").cast("timestamp")).alias("m")))
    assert got == {"n": "ab", "z": "__null__", "t": "Is High Complexity", "p": "supplier", "g": 16, "no": None,
                   "s": True, "l": "16ga Steel | (no shift)", "f": "a=ab|b=__null__", "m": 1.5}


def test_canonical_ids(spark):
    df = spark.createDataFrame([(v,) for v in ("P1234", "p-1234", "PART-1234", "P 1234", "P-1234", "Q-1", None)],
                               "v string")
    assert [r[0] for r in rows(df.select(codes.canonical_part("v")))] == ["P-1234"] * 5 + ["Q-1", None]
    lots = spark.createDataFrame([(v,) for v in ("LOT1234", "1234", "L-1234", "LOT-1234")], "v string")
    assert [r[0] for r in rows(lots.select(codes.canonical_lot("v")))] == ["LOT-1234"] * 4


def test_every_spelling_maps_to_its_code(spark):
    for spellings, empty in ((codes.DEFECT_SPELLINGS, "None"), (codes.SCRAP_REASON_SPELLINGS, "UNKNOWN")):
        flat = [(v, c) for c, vs in spellings.items() for v in vs]
        df = spark.createDataFrame(flat, "v string, want string")
        assert df.where(~codes.to_vocabulary("v", spellings, empty).eqNullSafe(F.col("want"))).count() == 0
        table = codes.vocabulary_table(spark, spellings)
        mapped = codes.map_to_vocabulary(df.unionByName(spark.createDataFrame(
            [("strange", None)], "v string, want string")), "v", table)
        assert mapped.where("not (code <=> want)").count() == 0
        assert [r["v"] for r in mapped.where("code_unmatched").collect()] == ["strange"]


def test_repair_ids(spark):
    people = spark.createDataFrame([("OP1", "Ann"), ("OP2", "Bob")], "id string, name string")
    df = spark.createDataFrame([("OP2",), ("Ann",), ("Zoe",), (None,)], "raw string")
    got = codes.repair_ids(df, "raw", people, "id", "name", r"^OP\d+$", "op").collect()
    assert {r["raw"]: r["op"] for r in got} == {"OP2": "OP2", "Ann": "OP1", "Zoe": None, None: None}


def test_drivers_round_trip(spark):
    df = spark.createDataFrame([(1, 0.5, -0.7, 0.5)], "id int, a double, b double, c double")
    top = df.select(nested.top_drivers(F.array(
        nested.driver("c", F.col("c"), "c"), nested.driver("a", F.col("a"), "a"),
        nested.driver("b", F.col("b"), "b")), 2).alias("d"))
    assert [(d["feature"], d["direction"]) for d in top.first()["d"]] == [
        ("b", "decreases_risk"), ("a", "increases_risk")]  # the tie goes to the smaller name
    text = top.select(F.to_json("d").alias("j"))
    assert text.select(nested.parse_drivers("j").alias("d")).first()["d"][0]["feature"] == "b"
    bad = spark.createDataFrame([("not json",), (None,)], "j string").select(nested.parse_drivers("j").alias("d"))
    assert [r["d"] for r in bad.collect()] == [[], []]
    sentence = top.select(nested.driver_sentence(F.col("d"), {"b": "Bee"}).alias("s")).first()["s"]
    assert sentence == "Bee (decreases risk); A (increases risk)"
