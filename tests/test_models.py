import itertools
import math

import numpy as np
import pytest
from conftest import one
from pyspark.sql import functions as F

from linegauge.operators import attribution, drift, evaluate, features, monitoring, scoring, training, trees


def _sample(spark, n=200, seed=42):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        c, x, z = str(rng.choice(["Low", "Medium", "High"])), float(rng.normal()), float(rng.integers(1, 25))
        p = 1 / (1 + math.exp(-(1.5 * (c == "High") + 1.2 * x - 0.4)))
        rows.append((i, c, x, z, int(rng.random() < p)))
    return spark.createDataFrame(rows, "id long, complexity string, x double, qty double, y int")


# -- metrics --------------------------------------------------------------------

def _auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("ranges", [0, 7])
def test_metrics_equal_definitions(spark, ranges):
    rng = np.random.default_rng(1)
    s = [float(v) for v in np.round(rng.beta(2, 2, 300), 2)]
    y = [int(v) for v in rng.random(300) < 0.55]
    df = spark.createDataFrame(list(zip(s, y)), "s double, y int")
    m = one(evaluate.metrics(df, "s", "y", 0.5, ranges=ranges))
    assert m["roc_auc"] == pytest.approx(_auc(s, y))
    reverse = one(evaluate.metrics(df.withColumn("s", -F.col("s")), "s", "y", ranges=ranges))
    assert reverse["roc_auc"] == pytest.approx(1 - m["roc_auc"])
    ap, seen = 0.0, 0
    for cut in sorted(set(s), reverse=True):
        tp = sum(1 for a, b in zip(s, y) if a >= cut and b)
        ap += (tp - seen) / sum(y) * tp / sum(1 for a in s if a >= cut)
        seen = tp
    assert m["avg_precision"] == pytest.approx(ap)
    tp = sum(1 for a, b in zip(s, y) if a >= 0.5 and b)
    assert m["recall"] == pytest.approx(tp / sum(y))
    assert m["precision"] == pytest.approx(tp / sum(a >= 0.5 for a in s))
    cells = {(r["actual"], r["predicted"]): r["n"] for r in evaluate.confusion(df, "s", "y", 0.5).collect()}
    assert sum(cells.values()) == 300 and cells[(1, 1)] == tp


def test_perfect_scores_and_undefined_cases(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.1, 0)], "s double, y int")
    m = one(evaluate.metrics(df, "s", "y"))
    assert all(m[k] == 1.0 for k in m)
    none = one(evaluate.metrics(df.withColumn("s", F.col("s") / 10), "s", "y"))
    assert (none["f1"], none["precision"], none["recall"]) == (0.0, 0.0, 0.0)
    assert one(evaluate.metrics(df.where("y = 1"), "s", "y"))["roc_auc"] is None


def test_counts_beyond_64_bits_when_multiplied(spark):
    big = spark.createDataFrame([(0.9, 4 * 10 ** 9, 10 ** 9), (0.1, 10 ** 9, 4 * 10 ** 9)], "score double, pos long, neg long")
    import unittest.mock as mock

    with mock.patch.object(evaluate, "score_counts", lambda *a: big):
        m = one(evaluate.metrics(big.withColumn("y", F.lit(1)), "score", "y", ranges=0))
    assert m["roc_auc"] == pytest.approx(0.8 * 0.8 + 0.5 * (0.8 * 0.2 + 0.2 * 0.8))


def test_curves_and_calibration(spark):
    df = spark.createDataFrame([(0.1, 0), (0.1, 1), (0.4, 0), (0.9, 1)], "s double, y int")
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in evaluate.pr_curve(df, "s", "y").collect()}
    assert pr == {0.1: (0.5, 1.0), 0.4: (0.5, 0.5), 0.9: (1.0, 0.5), 1.0: (1.0, 0.0)}
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df, "s", "y").collect()}
    assert roc == {None: (0, 0), 0.9: (0, 0.5), 0.4: (0.5, 0.5), 0.1: (1, 1)}
    cal = {r["bin"]: r["n"] for r in evaluate.calibration(df, "s", "y").collect()}
    assert cal == {0: 2, 3: 1, 8: 1}  # an edge belongs to the lower bin, empty bins are left out
    near = one(evaluate.nearest_point(evaluate.pr_curve(df, "s", "y"), "threshold", 0.5))
    assert near["threshold"] == 0.4


def test_tiers_and_accuracy_at_the_thresholds(spark):
    df = spark.createDataFrame([("p", 0.65, 1), ("p", 0.75, 0), ("p", 0.76, 1), ("p", 0.2, 1)], "k string, s double, y int")
    tiers = {r["s"]: r["t"] for r in df.select("s", evaluate.risk_tier("s").alias("t")).collect()}
    assert tiers == {0.65: "Low", 0.75: "Medium", 0.76: "High", 0.2: "Low"}
    acc = {r["risk_tier"]: r for r in evaluate.accuracy_by_tier(df, "s", "y", ["k"]).collect()}
    assert (acc["High"]["jobs_flagged"], acc["High"]["precision"], acc["High"]["recall"]) == (2, 0.5, 0.3333)
    assert (acc["Medium"]["jobs_flagged"], acc["Medium"]["pct_of_total"]) == (3, 0.75)  # cumulative


# -- features -------------------------------------------------------------------

def test_interactions_and_split(spark):
    df = spark.createDataFrame(
        [("Bending", "Shift B", "High", "Supplier C", "16ga Steel", "OP007"), ("Bending", None, None, None, None, None),
         ("Welding", "Shift B", "Low", "Supplier C", "12ga Steel", "OP001")],
        "machine_type string, shift_code string, complexity string, supplier string, material_type string, operator_id string")
    got = [tuple(r) for r in features.interaction_features(df).select(*features.INTERACTION).collect()]
    assert got == [(1, 1, 1, 1), (0, 0, 0, 0), (0, 0, 0, 0)]
    ts = spark.createDataFrame([("2024-12-31 08:00:00",), ("2025-06-30 00:00:00",), ("2026-02-01 00:00:00",), (None,)],
                               "t string").select(F.col("t").cast("timestamp").alias("t"))
    def split(**kw):
        return [r[0] for r in ts.select(features.time_split("t", "2024-12-31", "2025-06-30", **kw)).collect()]
    assert split() == ["train", "validation", "test", None]
    assert split(closed_at_midnight=True) == ["validation", "validation", "test", None]
    assert split(test_end="2025-12-31") == ["train", "validation", None, None]


def test_encoders_handle_unseen(spark):
    train = spark.createDataFrame([("b", 1.0), ("a", 3.0), ("b", 5.0)], "c string, x double")
    new = spark.createDataFrame([("a", 1.0), ("zz", 3.0), (None, 5.0)], "c string, x double")
    assert [r["c_code"] for r in features.vocabulary_encoder(train, ["c"]).transform(new).orderBy("x").collect()] == [0.0, -1.0, -1.0]
    linear = features.fit_stages(features.linear_stages(["c"], ["x"]), train).transform(new)
    hot = [list(r["features"].toArray()) for r in linear.collect()]
    assert [h[:2] for h in hot] == [[1, 0], [0, 0], [0, 0]]
    assert hot[1][2] == pytest.approx(0.0)
    z = [r["x_z"] for r in features.standardised(train, ["x"]).collect()]
    assert np.std(z) == pytest.approx(1.0)
    roles = {r["column"]: r["role"] for r in features.column_audit(train, ["gone"], ["x"], "c").collect()}
    assert roles == {"c": "target", "x": "non_predictive", "gone": "leakage"}


def test_vocabularies_are_tables(spark, tmp_path):
    known = [(f"v{i * 37 % 501}", i % 3) for i in range(900)] + [(None, None), ("", 7), ("é" * 500, 1), ("é" * 500 + "a", 1)]
    rows = known + [("new", 99)]
    encoder = features.vocabulary_encoder(spark.createDataFrame(known, "c string, d int"), ["c", "d"], str(tmp_path))
    encoder.write().save(f"{tmp_path}/encoder")
    frame = spark.createDataFrame(rows, "c string, d int").withColumn("value", F.lit("mine")).withColumn("code", F.lit(3))
    got = features.VocabularyEncoder.load(f"{tmp_path}/encoder").transform(frame)
    places = [{v: float(n) for n, v in enumerate(sorted({str(r[k]) for r in known if r[k] is not None}, key=str.encode))} for k in (0, 1)]
    want = [(c, d, places[0].get(c, -1.0), places[1].get(str(d), -1.0)) for c, d in rows]
    key = lambda r: tuple(map(repr, r))
    assert sorted((tuple(r) for r in got.select("c", "d", "c_code", "d_code").collect()), key=key) == sorted(want, key=key)
    assert features.vocabulary_encoder(frame, []).transform(frame).columns == frame.columns


# -- training and attribution -------------------------------------------------------

SPACE = {
    "logistic_regression": {"C": ("log", 0.1, 10.0)},
    "random_forest": {"trees": ("int", 4, 6), "depth": ("int", 3, 3), "leaf": ("int", 1, 5), "subset": ("choice", ["sqrt"])},
    "boosted_trees": {"step": ("log", 0.1, 0.3), "depth": ("int", 2, 3), "sample": ("uniform", 0.8, 1.0),
                      "columns": ("uniform", 0.6, 1.0), "leaf": ("int", 1, 5)},
}


@pytest.fixture(scope="module")
def trained(spark):
    df = _sample(spark, 600).cache()
    train, valid = df.where("id < 400"), df.where("id >= 400")
    return df, valid, {f: training.tune(train, valid, "y", f, ["complexity"], ["x", "qty"], trials=2, rounds=4,
                                        space=SPACE[f]) for f in SPACE}


def test_all_families_learn(spark, trained):
    df, valid, found = trained
    for t in found.values():
        assert t.validation_auc > 0.6
        scored = scoring.score(t.model, valid)
        assert scored.where("defect_probability < 0 or defect_probability > 1").count() == 0
        assert scored.count() == valid.count()
    table = training.comparison(spark, list(found.values())).collect()
    assert table[0]["family"] == training.best_of(list(found.values())).family


def test_search_is_reproducible(spark, trained):
    df, valid, found = trained
    again = training.tune(df.where("id < 400"), valid, "y", "logistic_regression", ["complexity"], ["x", "qty"], trials=2,
                          space=SPACE["logistic_regression"])
    assert again.params == found["logistic_regression"].params
    assert again.validation_auc == pytest.approx(found["logistic_regression"].validation_auc)


def _expectation(rules, x, known):
    """Value of the path-dependent game: unknown inputs follow the cover shares."""
    total = 0.0
    for value, path in rules:
        p = 1.0
        for f, (low, high, missing, share) in path.items():
            p *= share if f not in known else float(missing) if math.isnan(x[f]) else float(low < x[f] <= high)
        total += value * p
    return total


def _inputs(model, df):
    scorer = model.stages[-1]
    rows = model.transform(df).select("probability", *scorer.getInputCols()).collect()
    x = np.array([[np.nan if r[c] is None else r[c] for c in scorer.getInputCols()] for r in rows], float)
    return scorer, x, [r["probability"][1] for r in rows]


def _assert_shapley(scorer, x, probabilities):
    rules = attribution.ensemble_rules(scorer)
    got = attribution.leaf_contributions(x, rules)
    d = x.shape[1]
    for i in range(len(x)):
        for f in range(d):
            others = [j for j in range(d) if j != f]
            want = sum(math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d)
                       * (_expectation(rules, x[i], {*s, f}) - _expectation(rules, x[i], set(s)))
                       for k in range(d) for s in itertools.combinations(others, k))
            assert got[i, f] == pytest.approx(want, abs=1e-9)
        p = probabilities[i]
        scale = math.log(p / (1 - p)) if scorer.getOrDefault("logit") else p
        assert got[i].sum() + _expectation(rules, x[i], set()) == pytest.approx(scale, abs=1e-6)


@pytest.mark.parametrize("family", ["random_forest", "boosted_trees"])
def test_tree_attribution_equals_subset_enumeration(trained, family):
    df, _, found = trained
    _assert_shapley(*_inputs(found[family].model, df.limit(8)))


# -- trees as tables ----------------------------------------------------------------

def _with_gaps(spark, n=400):
    """y depends on whether x is missing, and on its being exactly 0 the other way round."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        x = [None, 0.0, float(rng.normal()), float("nan")][i % 4]
        p = 0.9 if x is None or x != x else 0.1 if x == 0 else 0.5 + 0.3 * (x > 0)
        rows.append((i, str(rng.choice(["a", "b"])), x, float(i % 5), int(rng.random() < p)))
    return spark.createDataFrame(rows, "id long, c string, x double, q double, y int")


@pytest.mark.parametrize("family", ["random_forest", "boosted_trees"])
def test_missing_numbers_are_no_zeros(spark, tmp_path, family):
    df = _with_gaps(spark).cache()
    space = {**SPACE[family], "leaf": ("int", 1, 1), "subset": ("choice", ["0.5"]), "trees": ("int", 8, 8)}
    got = training.tune(df, df, "y", family, ["c"], ["x", "q"], trials=1, rounds=5, space=space, root=str(tmp_path / "tables"))
    got.model.write().save(str(tmp_path / "model"))
    model = type(got.model).load(str(tmp_path / "model"))
    mean = {r["kind"]: r["p"] for r in training.probability(model.transform(df)).groupBy(
        F.when(F.col("x").isNull() | F.isnan("x"), "missing").when(F.col("x") == 0, "zero").otherwise("other").alias("kind")).agg(
        F.avg("probability_1").alias("p")).collect()}
    assert mean["missing"] > 0.55 and mean["zero"] < mean["missing"] - 0.15
    scorer, x, p = _inputs(model, df.where("id < 8"))
    assert np.isnan(x[:, 1]).sum() == 4
    _assert_shapley(scorer, x, p)
    scored = scoring.score_with_drivers(model, df, "id", ["c", "x", "q"])
    tops = {r["top_driver_feature"] for r in scored.where("x IS NULL").select("top_driver_feature").collect()}
    assert tops == {"x"}
    assert {d["feature"] for d in scored.first()["drivers"]} == {"c", "x", "q"}


def test_node_tables_score_like_the_forest_they_come_from(spark):
    df = _sample(spark, 300).cache()
    prep = training.Preparation(df, "random_forest", ["complexity"], ["x", "qty"])
    vectors = prep.vectors(df).withColumn("y", F.col("y").cast("double"))
    fitted = training.forest({"trees": 7, "depth": 6, "leaf": 2, "subset": "sqrt"}).fit(vectors)
    want = {r["id"]: r["probability_1"] for r in training.probability(fitted.transform(vectors)).collect()}
    got = training.probability(prep.forest_model(spark, fitted).transform(df)).collect()
    assert {r["id"]: r["probability_1"] for r in got} == pytest.approx(want)


def _margins(rows, x):
    """Running sums after every tree, walked node by node."""
    out, total = [], 0.0
    for number in sorted({r[0] for r in rows}):
        nodes = {r[1]: r for r in rows if r[0] == number}
        at = nodes[0]
        while at[2] is not None:
            v = x[at[2]]
            at = nodes[at[5] if (at[4] if v is None or v != v else v <= at[3]) else at[6]]
        total += at[7]
        out.append(total)
    return out


def test_boosting_ends_at_the_best_round(spark):
    df = _with_gaps(spark, 300)
    prep = training.Preparation(df, "boosted_trees", ["c"], ["x", "q"])
    rows = prep.vectors(df).withColumns({"y": F.col("y").cast("double"), "weight": F.lit(1.0), "held_out": F.col("id") % 3 == 0}).cache()
    params = {"step": 0.5, "depth": 3, "sample": 0.9, "columns": 0.7, "leaf": 2}
    every, aucs = trees.boost(rows, params, prep.slots, 8, 8)
    held = rows.where("held_out").select("c_code", "x", "q", "y").collect()
    full, _ = trees.boost(rows, params, prep.slots, 8, None)
    sums = [_margins(full, r[:3]) for r in held]
    want = [_auc([s[n] for s in sums], [r["y"] for r in held]) for n in range(8)]
    assert aucs == pytest.approx(want)
    best = max(range(8), key=lambda n: (want[n], -n))
    assert max(r[0] for r in every) == best and every == [r for r in full if r[0] <= best]
    short, _ = trees.boost(rows, params, prep.slots, 8, 2)
    assert max(r[0] for r in short) == trees.best_round(want, 2)[0]
    used = [{r[2] for r in full if r[0] == n and r[2] is not None} for n in range(8)]
    assert all(len(u) <= 2 for u in used) and set().union(*used) == {0, 1, 2}


def test_patience():
    assert trees.best_round([0.5, 0.6, 0.6, 0.55, 0.9], 2) == (1, True)
    assert trees.best_round([0.5, 0.6, 0.6, 0.55, 0.9], 4) == (4, False)
    assert trees.best_round([], 3) == (0, False)


def test_drivers_of_a_linear_model(trained):
    df, _, found = trained
    model = found["logistic_regression"].model
    scored = scoring.score_with_drivers(model, df, "id", ["complexity", "x", "qty"])
    got = scored.select("drivers", "top_driver_feature", "top_driver_direction").first()
    assert len(got["drivers"]) == 3
    sizes = [abs(d["contribution"]) for d in got["drivers"]]
    assert sizes == sorted(sizes, reverse=True)
    assert got["top_driver_feature"] == got["drivers"][0]["feature"]
    names = attribution.input_names(model, df)
    imp = attribution.importance(attribution.attribute(model.transform(df), model, "id"), names).collect()
    assert len(imp) == len(names) and imp[0]["mean_abs_contribution"] >= imp[-1]["mean_abs_contribution"]


def test_drivers_of_a_period_do_not_depend_on_other_periods(trained):
    from pyspark.sql import functions as F

    df, _, found = trained
    model = found["logistic_regression"].model
    both = df.withColumn("p", F.when(F.col("x") > 0, "high").otherwise("low"))
    names = ["complexity", "x", "qty"]

    def drivers(rows):
        scored = scoring.score_with_drivers(model, rows, "id", names, period="p")
        return {r["id"]: r["drivers"] for r in scored.where("p = 'low'").select("id", "drivers").collect()}

    alone, beside = drivers(both.where("p = 'low'")), drivers(both)
    assert alone.keys() == beside.keys() and len(alone) > 10
    for i, own in alone.items():
        assert [d["contribution"] for d in own] == pytest.approx([d["contribution"] for d in beside[i]], abs=1e-3)


def test_auc_uses_raw_scores(spark):
    rows = [(0.5 + i * 1e-9, i % 2 if i < 10 else 1) for i in range(20)]
    df = spark.createDataFrame(rows, "probability_1 double, y int")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum(p > n for p in pos for n in neg) / len(pos) / len(neg)
    assert training.auc(df, "y") == pytest.approx(want)


@pytest.mark.parametrize("family", list(SPACE))
def test_learning_curve(spark, family):
    params = {"C": 1.0, "step": 0.2, "depth": 2, "sample": 1.0, "leaf": 1, "trees": 3, "subset": "sqrt"}
    out = training.learning_curve(_sample(spark, 300), "id", "y", family, params, ["complexity"], ["x", "qty"],
                                  sizes=[0.5, 1.0], folds=2, rounds=2).collect()
    assert [(r["size"], r["train_size"]) for r in out] == [(0.5, 75.0), (1.0, 150.0)]
    assert all(0 <= r["val_roc_auc"] <= 1 for r in out)


def test_learning_curve_fits_few_partitions_and_ranks_all_models_at_once(spark):
    import unittest.mock as mock

    parts, calls, real, fit = [], [], evaluate.metrics, training.logistic

    class Fit:
        def __init__(self, *a):
            self.own = fit(*a)

        def fit(self, rows):
            parts.append(rows.rdd.getNumPartitions())
            return self.own.fit(rows)

    def counted(*a, **b):
        calls.append(b.get("keys"))
        return real(*a, **b)

    df, sizes = _sample(spark, 300), [0.5, 1.0]
    with mock.patch.object(training, "metrics", counted), mock.patch.object(training, "logistic", Fit):
        out = training.learning_curve(df, "id", "y", "logistic_regression", {"C": 1.0}, ["complexity"], ["x", "qty"], sizes, folds=2).collect()
    assert len(calls) == 1 and len(parts) == 4
    assert max(parts) < int(spark.conf.get("spark.sql.shuffle.partitions"))

    # the same points from single fits, each ranked by the definition
    folded = training.class_folds(df.select("id", "y", "complexity", "x", "qty"), "id", "y", 2).cache()
    prep = training.Preparation(folded, "logistic_regression", ["complexity"], ["x", "qty"])
    rows = prep.vectors(folded).withColumn("y", F.col("y").cast("double")).cache()

    def area(model, part):
        scored = training.probability(model.transform(part)).select("probability_1", "y").collect()
        return _auc([r[0] for r in scored], [r[1] for r in scored])

    for r, n in zip(out, training.curve_sizes(folded, 2, sizes)):
        models = [training.logistic({"C": 1.0}, n).fit(rows.where(f"place_{f} < {n}")) for f in (0, 1)]
        train = [area(m, rows.where(f"place_{f} < {n}")) for f, m in enumerate(models)]
        held = [area(m, rows.where(f"fold = {f}")) for f, m in enumerate(models)]
        assert (r["train_size"], r["train_roc_auc"], r["val_roc_auc"]) == (n, pytest.approx(np.mean(train), abs=1e-3), pytest.approx(np.mean(held), abs=1e-3))
        assert r["val_roc_auc_std"] == pytest.approx(np.std(held), abs=1e-3)


@pytest.mark.parametrize("ranges", [1, 9])
def test_folds_keep_class_shares_and_prefixes_are_exact(spark, ranges):
    rows = [(i // 2 if i < 40 else i, int(i % 7 == 0)) for i in range(301)] + [(None, 1)]
    got = [r.asDict() for r in training.class_folds(spark.createDataFrame(rows, "id long, y int"), "id", "y", 3, ranges).collect()]
    assert len(got) == len(rows)
    for y in (0, 1):
        sizes = [sum(r["y"] == y and r["fold"] == f for r in got) for f in range(3)]
        assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    for f in range(3):
        places = sorted(r[f"place_{f}"] for r in got if r["fold"] != f)
        assert places == list(range(len(places))) and all(r[f"place_{f}"] is None for r in got if r["fold"] == f)


# -- drift and monitoring -----------------------------------------------------------

def _periods(spark):
    rng = np.random.default_rng(9)
    ref = [("ref", str(rng.choice(["a", "b"])), float(rng.normal()), int(rng.random() < 0.5)) for _ in range(400)]
    same = [("same", c, x, b) for _, c, x, b in ref]
    far = [("far", "new", x + 3, 1) for _, _, x, _ in ref]
    schema = "period string, c string, x double, b int"
    return spark.createDataFrame(ref, schema), spark.createDataFrame(same + far, schema), np.array([r[2] for r in ref])


def test_distances(spark):
    ref, cur, x = _periods(spark)
    js = {r["period"]: r["distance"] for r in drift.js_distance(ref, cur, ["c"], "period", ["same", "far"]).collect()}
    assert js["same"] == pytest.approx(0, abs=1e-9) and js["far"] == pytest.approx(math.sqrt(math.log(2)))
    w = {r["period"]: r["distance"] for r in drift.wasserstein(ref, cur, ["x"], "period", ["same", "far"]).collect()}
    assert w["same"] == pytest.approx(0, abs=1e-9) and w["far"] == pytest.approx(3 / x.std())


def test_js_is_symmetric(spark):
    a = spark.createDataFrame([("p", "x")] * 3 + [("p", "y")], "period string, c string")
    b = spark.createDataFrame([("p", "x")] + [("p", None)] * 4, "period string, c string")
    there = drift.js_distance(a, b, ["c"], "period", ["p"]).first()["distance"]
    back = drift.js_distance(b, a, ["c"], "period", ["p"]).first()["distance"]
    assert there == pytest.approx(back) and 0 < there <= math.sqrt(math.log(2))


def test_distances_without_rows_with_offset_and_nan(spark):
    ref, cur, x = _periods(spark)
    periods = ["same", "far", "none"]
    js = {r["period"]: r["distance"] for r in drift.js_distance(ref, cur, ["c"], "period", periods).collect()}
    assert js["none"] is None and js["same"] == pytest.approx(0, abs=1e-9)
    shifted = [d.selectExpr("period", "x + 1.7e9 AS x", "IF(b = 1, double('NaN'), x) AS n", "CAST(NULL AS DOUBLE) AS gone") for d in (ref, cur)]
    w = {(r["period"], r["feature"]): r["distance"] for r in
         drift.wasserstein(*shifted, ["x", "n", "gone"], "period", periods).collect()}
    assert w["far", "x"] == pytest.approx(3 / x.std(), rel=1e-4) and w["none", "x"] is None
    assert w["same", "n"] == pytest.approx(0, abs=1e-9) and w.get(("far", "gone")) is None
    table = drift.feature_drift(ref, cur, "period", periods, ["c"], ["x"], ["b"]).collect()
    assert not any(r["drift_detected"] for r in table if r["period"] == "none")


def test_drift_table_chooses_methods(spark):
    ref, cur, _ = _periods(spark)
    table = drift.feature_drift(ref, cur, "period", ["same", "far"], ["c"], ["x"], ["b"]).collect()
    far = {r["feature"]: r for r in table if r["period"] == "far"}
    assert len(table) == 6 and all(r["drift_detected"] for r in far.values())
    assert far["x"]["test_method"].startswith("Wasserstein") and far["b"]["test_method"].startswith("Jensen")
    assert (far["c"]["feature_type"], far["x"]["feature_type"], far["b"]["feature_type"]) == (
        "categorical", "numerical", "interaction")
    assert not any(r["drift_detected"] for r in table if r["period"] == "same")


def test_decision_rules(spark):
    cases = [("bad", 0.84, 0.05, True, 4), ("shift", 0.9, 0.11, False, 0), ("scores", 0.9, 0.1, True, 3),
             ("inputs", 0.85, 0.0, False, 4), ("fine", 0.85, 0.1, False, 3)]
    df = spark.createDataFrame(cases, "k string, high_precision double, target_rate_delta double, "
                                      "prediction_drift_detected boolean, n_features_drifted int")
    got = {r["k"]: r for r in monitoring.with_decision(df).collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        "bad": "RETRAIN", "shift": "RETRAIN", "scores": "INVESTIGATE", "inputs": "INVESTIGATE", "fine": "HEALTHY"}
    assert got["bad"]["reasons"] == (
        "High-tier precision 84.0% below 85% floor | Prediction (output) distribution drifted vs validation reference | "
        "4 input features drifted (> 3)")
    assert got["shift"]["reasons"] == "Defect rate shifted 11.0% from training baseline (> 10%)"
    assert got["fine"]["reasons"] == "" and not got["fine"]["retrain_recommended"]
