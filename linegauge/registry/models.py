"""Encoders, exact metrics, training, attribution, scoring on labelled documents."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from linegauge.operators import attribution, evaluate, features, scoring, training, trees
from linegauge.registry.base import ORDER_LINES, SCORED, day, order_lines, query, scored_documents, table
from linegauge.session import cut_lineage, scratch_path
from linegauge.sources import runlog

# -- features -------------------------------------------------------------------


@query("interaction_features", "M1", f"""
WITH {ORDER_LINES}
SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN p_type = 'LARGE' AND o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_bending_shift_b,
  CASE WHEN p_size > 40 THEN 1 ELSE 0 END AS is_high_complexity,
  CASE WHEN l_tax > 0.05 AND l_returnflag IN ('A', 'R') THEN 1 ELSE 0 END AS is_supplier_c_thin_gauge,
  CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS is_lapsed_cert_op
FROM ol JOIN part ON l_partkey = p_partkey
""")
def interaction_features(spark, sf):
    c = F.col
    rows = order_lines(spark, sf).join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey")).select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(c("p_type") == "LARGE", "Bending").otherwise(c("p_type")).alias("machine_type"),
        F.when(c("o_orderstatus") == "F", "Shift B").alias("shift_code"),
        F.when(c("p_size") > 40, "High").alias("complexity"),
        F.when(c("l_tax") > 0.05, "Supplier C").alias("supplier"),
        F.when(c("l_returnflag") == "A", "14ga Steel").when(c("l_returnflag") == "R", "16ga Steel").alias(
            "material_type"),
        F.when(c("l_linenumber") == 7, "OP007").alias("operator_id"))
    return features.interaction_features(rows).select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *features.INTERACTION)


@query("time_split", "M2 M3", """
SELECT CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' WHEN o_orderdate < TIMESTAMP '2000-07-01' THEN
  'validation' WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN 'test' ELSE '(none)' END AS split,
  CASE WHEN o_orderdate <= TIMESTAMP '1998-12-31' THEN 'train' WHEN o_orderdate <= TIMESTAMP '2000-06-30' THEN
  'validation' ELSE 'test' END AS literal_split, count(*) AS n FROM orders GROUP BY 1, 2
""")
def split_by_time(spark, sf):
    split = features.time_split("o_orderdate", "1998-12-31", "2000-06-30", "2000-12-31")
    literal = features.time_split("o_orderdate", "1998-12-31", "2000-06-30", closed_at_midnight=True)
    return table(spark, sf, "orders").groupBy(
        F.coalesce(split, F.lit("(none)")).alias("split"), literal.alias("literal_split")).agg(
        F.count("*").alias("n"))


@query("encode_ordinal", "M5", """
WITH v AS (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part
  WHERE p_size = 1)), b AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT
  p_brand FROM part WHERE p_size = 1))
SELECT p_partkey, CAST(coalesce(v.code, -1) AS DOUBLE) AS p_name_code, CAST(coalesce(b.code, -1) AS DOUBLE) AS
  p_brand_code FROM part LEFT JOIN v USING (p_name) LEFT JOIN b USING (p_brand)
""")
def encode_ordinal(spark, sf):
    part = table(spark, sf, "part")
    encoder = features.vocabulary_encoder(part.where("p_size = 1"), ["p_name", "p_brand"])
    return encoder.transform(part).select("p_partkey", "p_name_code", "p_brand_code")


@query("encode_long_categories", "M5", """
WITH v AS (SELECT text, row_number() OVER (ORDER BY text) - 1 AS code FROM (SELECT DISTINCT text FROM documents
  JOIN labels USING (doc_id)))
SELECT doc_id, CAST(coalesce(v.code, -1) AS DOUBLE) AS text_code FROM documents LEFT JOIN v USING (text)
""")
def encode_long_categories(spark, sf):
    """Whole texts as categories, known from the labelled documents; texts of other documents only are unseen."""
    docs = table(spark, sf, "documents")
    known = features.category_codes(docs.join(table(spark, sf, "labels"), "doc_id"), ["text"])
    return features.with_codes(docs.select("doc_id", "text"), known, ["text"]).select("doc_id", "text_code")


AUDIT_LEAKAGE = ["l_returnflag", "l_linestatus", "l_receiptdate", "l_discount", "gone_after_production"]
AUDIT_NON_PREDICTIVE = ["l_orderkey", "l_linenumber", "o_orderkey", "o_comment"]


@query("column_audit", "M4", f"""
WITH have AS (SELECT column_name AS c FROM information_schema.columns WHERE table_name = 'lineitem'),
listed AS (SELECT unnest({AUDIT_LEAKAGE!r}) AS c, 'leakage' AS role UNION ALL SELECT unnest({AUDIT_NON_PREDICTIVE!r}), 'non_predictive'),
stats AS (UNPIVOT (SELECT count(COLUMNS(*)) FROM lineitem) ON COLUMNS(*) INTO NAME c VALUE n_values)
SELECT coalesce(have.c, listed.c) AS "column", CASE WHEN listed.c = 'l_linestatus' THEN 'target' ELSE
  coalesce(role, 'candidate') END AS role, have.c IS NOT NULL AS present, coalesce(n_values, 0) AS n_values
FROM have FULL JOIN listed ON have.c = listed.c LEFT JOIN stats ON stats.c = have.c
""")
def column_audit(spark, sf):
    """Roles of the order lines' own columns by lists of leaking and non-predictive columns, and how many values each has."""
    rows = table(spark, sf, "lineitem")
    roles = features.column_audit(rows, AUDIT_LEAKAGE, AUDIT_NON_PREDICTIVE, "l_linestatus")
    filled = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).unpivot([], rows.columns, "column", "n_values")
    return roles.join(filled, "column", "left").withColumn("n_values", F.coalesce("n_values", F.lit(0)))


@query("encode_onehot_scale", "M6 M7", """
SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS economy, CASE WHEN p_type = 'LARGE' THEN 1 ELSE 0
  END AS large, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part), 6) AS size_z,
  round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_pop(p_retailprice) FROM part), 6)
  AS price_z FROM part
""")
def encode_onehot_scale(spark, sf):
    scaled = features.standardised(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    hot = features.one_hot(scaled, {"p_type": ["ECONOMY", "LARGE"]})
    return hot.select("p_partkey", F.col("`p_type=ECONOMY`").alias("economy"), F.col("`p_type=LARGE`").alias("large"),
                      F.round("p_size_z", 6).alias("size_z"), F.round("p_retailprice_z", 6).alias("price_z"))


# -- metrics --------------------------------------------------------------------

RANKED = f"""
{SCORED}, s AS (SELECT score, CAST(sum(quality) AS DOUBLE) AS pos, CAST(sum(1 - quality) AS DOUBLE) AS neg FROM sd
  GROUP BY 1),
r AS (SELECT score, pos, neg, sum(pos) OVER () AS p, sum(neg) OVER () AS n,
  coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
  sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM s)
"""


@query("metrics_exact", "M13", f"""
WITH {RANKED}, a AS (SELECT sum(pos * (below + neg / 2)) / (max(p) * max(n)) AS roc_auc,
  sum(pos / p * tp / (tp + fp)) AS avg_precision, sum(pos) FILTER (WHERE score >= 0.5) AS tp,
  sum(neg) FILTER (WHERE score >= 0.5) AS fp, max(p) AS p FROM r)
SELECT round(roc_auc, 6) AS roc_auc, round(avg_precision, 6) AS avg_precision, round(2 * tp / (tp + fp + p), 6) AS f1,
  round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM a
""")
def metrics_exact(spark, sf):
    out = evaluate.metrics(scored_documents(spark, sf), "score", "quality")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("metrics_unrounded", "M13", """
WITH s AS (SELECT l_extendedprice / 100000.0 AS score, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y
  FROM lineitem), g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY 1),
r AS (SELECT *, sum(pos) OVER () AS p, sum(neg) OVER () AS n, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN
  UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(sum(pos * (below + neg / 2)) / (max(p) * max(n)), 6) AS roc_auc FROM r
""")
def metrics_unrounded(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.col("l_extendedprice") / 100000.0).alias("score"),
                                               (F.col("l_returnflag") == "R").alias("y"))
    return evaluate.metrics(rows, "score", "y").select(F.round("roc_auc", 6).alias("roc_auc"))


@query("confusion", "M14", f"""
WITH {SCORED}, c AS (SELECT quality AS a, CASE WHEN score >= 0.75 THEN 1 ELSE 0 END AS b FROM sd),
cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, b))
SELECT CAST(cells.a AS INTEGER) AS actual, CAST(cells.b AS INTEGER) AS predicted, count(c.a) AS n,
  round(count(c.a) / sum(count(c.a)) OVER (PARTITION BY cells.a), 6) AS row_share
FROM cells LEFT JOIN c ON c.a = cells.a AND c.b = cells.b GROUP BY cells.a, cells.b
""")
def confusion(spark, sf):
    return evaluate.confusion(scored_documents(spark, sf), "score", "quality", 0.75).withColumn(
        "row_share", F.round("row_share", 6))


@query("pr_curve", "M15 W12", f"""
WITH {RANKED} SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM r
UNION ALL SELECT 1.0, 1.0, 0.0
""")
def pr_curve(spark, sf):
    out = evaluate.pr_curve(scored_documents(spark, sf), "score", "quality")
    return out.withColumns({"precision": F.round("precision", 6), "recall": F.round("recall", 6)})


@query("roc_curve", "M16 W12", f"""
WITH {RANKED} SELECT score AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM r
UNION ALL SELECT NULL, 0.0, 0.0
""")
def roc_curve(spark, sf):
    out = evaluate.roc_curve(scored_documents(spark, sf), "score", "quality")
    return out.withColumns({"fpr": F.round("fpr", 6), "tpr": F.round("tpr", 6)})


@query("calibration", "M17", f"""
WITH {SCORED}, b AS (SELECT *, CASE {' '.join(f'WHEN score <= {i / 10} THEN {i - 1}' for i in range(1, 10))} ELSE 9 END
  AS bin FROM sd)
SELECT CAST(bin AS INTEGER) AS bin, round(avg(score), 6) AS mean_predicted, round(avg(quality), 6) AS
  fraction_positive, count(*) AS n FROM b GROUP BY 1
""")
def calibration(spark, sf):
    out = evaluate.calibration(scored_documents(spark, sf), "score", "quality")
    return out.withColumns({c: F.round(c, 6) for c in ("mean_predicted", "fraction_positive")})


@query("accuracy_by_tier", "M25 N6", f"""
WITH {SCORED}, t(risk_tier, threshold) AS (VALUES ('High', 0.75), ('Medium', 0.65)),
g AS (SELECT lang, risk_tier, max(threshold) AS threshold, count(*) FILTER (WHERE score >= threshold) AS f,
  coalesce(sum(quality) FILTER (WHERE score >= threshold), 0) AS tp, sum(quality) AS p, count(*) AS n
  FROM sd, t GROUP BY 1, 2)
SELECT lang, risk_tier, CAST(threshold AS DOUBLE) AS threshold, f AS jobs_flagged, CAST(tp AS BIGINT) AS
  true_positives, CAST(f - tp AS BIGINT) AS false_positives, round(CASE WHEN f > 0 THEN tp / f ELSE 0 END, 4) AS
  precision, round(CASE WHEN p > 0 THEN tp / p ELSE 0 END, 4) AS recall, round(f / n, 4) AS pct_of_total FROM g
""")
def accuracy_by_tier(spark, sf):
    return evaluate.accuracy_by_tier(scored_documents(spark, sf), "score", "quality", ["lang"])


# -- models ---------------------------------------------------------------------

CATEGORICAL, NUMERIC, LABEL, KEY = ["lang", "source"], ["n_chars", "n_words", "n_lines"], "quality", "doc_id"
#: What the registered training queries search: trials, and rounds of boosting. The operator's defaults are in ``training``.
TRIALS, ROUNDS = 1, 6


def _documents(spark, sf):
    """Labelled documents with text features; whole texts are read. A text of one line has no number of lines."""
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        (F.length("text") - F.length(F.replace("text", F.lit(" "))) + 1).cast("double").alias("n_words"),
        F.nullif(lines, F.lit(1)).cast("double").alias("n_lines"))
    part = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % 4
    split = F.when(part == 0, "validation").otherwise("train")
    return table(spark, sf, "labels").select("doc_id", "quality").join(docs, "doc_id").withColumn("split", split)


MODEL_ROWS = """
md AS (SELECT l.doc_id, l.quality, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars,
         length(text) - length(replace(text, ' ', '')) + 1 AS n_words,
         nullif(length(text) - length(replace(text, chr(10), '')) + 1, 1) AS n_lines,
         ('0x' || substr(md5(CAST(l.doc_id AS VARCHAR)), 1, 8))::BIGINT % 4 = 0 AS held_out
       FROM labels l JOIN documents d USING (doc_id)),
lv AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS lang_code FROM (SELECT DISTINCT lang FROM md WHERE lang IS NOT NULL)),
sv AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS source_code FROM (SELECT DISTINCT source FROM md WHERE source IS NOT NULL)),
x AS (SELECT md.*, coalesce(lang_code, -1) AS lang_code, coalesce(source_code, -1) AS source_code
      FROM md LEFT JOIN lv USING (lang) LEFT JOIN sv USING (source))
"""


def _sides(spark, sf):
    rows = _documents(spark, sf)
    return rows.where("split = 'train'"), rows.where("split = 'validation'")


def _trained(spark, sf, family, trials=TRIALS):
    train, validation = _sides(spark, sf)
    return training.tune(train, validation, LABEL, family, CATEGORICAL, NUMERIC, trials=trials, rounds=ROUNDS)


def _report(spark, sf, family):
    got = _trained(spark, sf, family)
    _, validation = _sides(spark, sf)
    scored = training.probability(got.model.transform(validation))
    out = evaluate.metrics(scored, "probability_1", LABEL)
    return out.select(F.lit(family).alias("family"), *[F.round(c, 4).alias(c) for c in out.columns])


@query("train_lr", "M8")
def train_lr(spark, sf):
    return _report(spark, sf, "logistic_regression")


@query("train_rf", "M9")
def train_rf(spark, sf):
    return _report(spark, sf, "random_forest")


@query("train_gbt", "M10 M12")
def train_gbt(spark, sf):
    return _report(spark, sf, "boosted_trees")


# With one category as the only input a fitted model must give every category its share of positives, which SQL knows.

@query("fit_lr_shares", "M6 M8", f"""
WITH {MODEL_ROWS} SELECT coalesce(lang, 'UNKNOWN') AS lang, round(avg(quality), 3) AS p, CAST(0 AS DOUBLE) AS spread, count(*) AS n FROM x GROUP BY 1
""")
def fit_lr_shares(spark, sf):
    rows = _documents(spark, sf)
    got = training.tune(rows, rows, LABEL, "logistic_regression", ["lang"], [], trials=1, space={"C": ("choice", [1e6])})
    return _shares(got.model.transform(rows))


@query("fit_rf_shares", "M5 M9", f"""
WITH {MODEL_ROWS} SELECT coalesce(lang, 'UNKNOWN') AS lang, round(avg(quality), 3) AS p, CAST(0 AS DOUBLE) AS spread, count(*) AS n FROM x GROUP BY 1
""")
def fit_rf_shares(spark, sf):
    rows = _documents(spark, sf)
    space = {"trees": ("choice", [1]), "depth": ("choice", [8]), "leaf": ("choice", [1]), "subset": ("choice", ["all"]), "bootstrap": ("choice", [False])}
    return _shares(training.tune(rows, rows, LABEL, "random_forest", ["lang"], [], trials=1, space=space).model.transform(rows))


@query("fit_gbt_shares", "M5 M10 M12", f"""
WITH {MODEL_ROWS}, w AS (SELECT count(*) FILTER (WHERE quality = 0) / count(*) FILTER (WHERE quality = 1) AS w FROM x)
SELECT coalesce(lang, 'UNKNOWN') AS lang, round(sum(quality) * w / (sum(quality) * w + sum(1 - quality)), 3) AS p, CAST(0 AS DOUBLE) AS spread,
  count(*) AS n FROM x, w GROUP BY 1, w
""")
def fit_gbt_shares(spark, sf):
    """Newton steps of rate 1 lead to the share of positives, weighted by the class odds; one class alone takes a step per digit or so."""
    rows = _documents(spark, sf)
    prep = training.Preparation(rows, "boosted_trees", ["lang"], [])
    weight = F.when(F.col(LABEL) == 1, training.positive_weight(rows, LABEL)).otherwise(1.0)
    vectors = prep.vectors(rows).select("features", F.col(LABEL).cast("double").alias("y"), weight.alias("weight"), F.lit(False).alias("held_out"))
    nodes, _ = trees.boost(vectors, {"step": 1.0, "depth": 4, "sample": 1.0, "columns": 1.0, "leaf": 1}, prep.slots, 12, None)
    return _shares(prep.boosted_model(spark, nodes).transform(rows))


def _shares(scored):
    p = training.probability(scored).groupBy(F.coalesce("lang", F.lit("UNKNOWN")).alias("lang")).agg(
        F.round(F.avg("probability_1"), 3).alias("p"), F.round(F.max("probability_1") - F.min("probability_1"), 3).alias("spread"),
        F.count("*").alias("n"))
    return p.withColumn("spread", F.abs("spread"))


def _auc_sql(name: str, score: str) -> str:
    return (f"SELECT '{name}' AS candidate, (SELECT sum(CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0 END) / count(*) FROM "
            f"(SELECT {score} AS s FROM v WHERE quality = 1) a, (SELECT {score} AS s FROM v WHERE quality = 0) b) AS auc")


@query("search_candidates", "M11 M13 M20", f"""
WITH {MODEL_ROWS}, t AS (SELECT * FROM x WHERE NOT held_out),
l AS (SELECT lang, avg(quality) AS by_lang FROM t GROUP BY 1), s AS (SELECT source, avg(quality) AS by_source FROM t GROUP BY 1),
v AS (SELECT x.quality, by_lang, by_source FROM x LEFT JOIN l USING (lang) LEFT JOIN s USING (source) WHERE held_out),
a AS ({_auc_sql('lang', 'by_lang')} UNION ALL {_auc_sql('source', 'by_source')})
SELECT candidate, round(auc, 4) AS validation_auc, auc = (SELECT max(auc) FROM a) AS selected FROM a
""")
def search_candidates(spark, sf):
    """One-input forests of a single tree, fitted on the training side, compared on the validation side."""
    train, validation = _sides(spark, sf)
    space = {"trees": ("choice", [1]), "depth": ("choice", [12]), "leaf": ("choice", [1]), "subset": ("choice", ["all"]), "bootstrap": ("choice", [False])}
    found = {c: training.tune(train, validation, LABEL, "random_forest", [c], [], trials=1, space=space) for c in ("lang", "source")}
    best = training.best_of(list(found.values()))
    rows = [(c, t.validation_auc, t is best) for c, t in found.items()]
    return spark.createDataFrame(rows, "candidate string, validation_auc double, selected boolean").withColumn(
        "validation_auc", F.round("validation_auc", 4))


@query("tune", "M11 M20 O7")
def tune(spark, sf):
    found = [_trained(spark, sf, f) for f in training.SPACES]
    best = training.best_of(found).family
    return training.comparison(spark, found).select(
        "family", F.round("validation_auc", 4).alias("validation_auc"), (F.col("family") == best).alias("selected"))


@query("learning_curve", "M18")
def learning_curve(spark, sf):
    out = training.learning_curve(_documents(spark, sf), KEY, LABEL, "logistic_regression", {"C": 1.0}, CATEGORICAL,
                                  NUMERIC)
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


CURVE_PARTS = [0.1 + 0.9 * i / 7 for i in range(8)]


@query("learning_curve_rows", "M18", f"""
WITH o AS (SELECT doc_id, quality, ('0x' || substr(md5('{training.SEED}:' || doc_id), 1, {training.ORDER_DIGITS}))::BIGINT AS h FROM labels),
d AS (SELECT *, (row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) - 1) % 3 AS own FROM o),
t AS (SELECT f.fold, doc_id, quality, row_number() OVER (PARTITION BY f.fold ORDER BY h, quality, doc_id) - 1 AS place
      FROM d, (SELECT unnest(range(0, 3)) AS fold) f WHERE own <> f.fold),
s AS (SELECT part, CAST(floor(part * (SELECT count(*) FROM d WHERE own <> 0) + 1e-9) AS BIGINT) AS n FROM (SELECT unnest({CURVE_PARTS!r}) AS part))
SELECT CAST(fold AS INTEGER) AS fold, n AS wanted, count(*) AS n_train, CAST(sum(quality) AS BIGINT) AS n_positive, CAST(sum(doc_id) AS BIGINT) AS id_sum
FROM t, s WHERE place < n GROUP BY fold, n
""")
def learning_curve_rows(spark, sf):
    """Rows, positives and the sum of ids that every fold and size of the learning curve trains on."""
    folded = training.class_folds(table(spark, sf, "labels").select(KEY, LABEL), KEY, LABEL, 3)
    folded = cut_lineage(folded)
    steps = training.curve_sizes(folded, 3, CURVE_PARTS)
    places = F.array(*[F.struct(F.lit(f).alias("fold"), F.col(f"place_{f}").alias("place")) for f in range(3)])
    each = folded.select(KEY, LABEL, F.inline(places)).where(F.col("place").isNotNull())
    each = each.withColumn("wanted", F.explode(F.lit(steps))).where(F.col("place") < F.col("wanted"))
    return each.groupBy("fold", F.col("wanted").cast("bigint").alias("wanted")).agg(
        F.count("*").alias("n_train"), F.sum(F.col(LABEL).cast("bigint")).alias("n_positive"), F.sum(KEY).alias("id_sum"))


# A small fixed model over codes of lang and source and three numbers: tree, node, input, cut, missing goes left,
# left, right, value, rows. It is stored and loaded like any other, so SQL can tell its results.
INPUTS = ["lang_code", "source_code", "n_chars", "n_words", "n_lines"]
MODEL_NODES = [
    (0, 0, 2, 900.0, False, 1, 2, None, 100.0), (0, 1, None, None, None, None, None, -0.8, 40.0),
    (0, 2, 3, 400.0, False, 3, 4, None, 60.0), (0, 3, None, None, None, None, None, 0.6, 24.0),
    (0, 4, None, None, None, None, None, 1.2, 36.0),
    (1, 0, 4, 6.0, False, 1, 2, None, 100.0), (1, 1, None, None, None, None, None, 0.4, 30.0),
    (1, 2, 0, 1.0, True, 3, 4, None, 70.0), (1, 3, None, None, None, None, None, 0.2, 42.0),
    (1, 4, None, None, None, None, None, -0.6, 28.0),
    (2, 0, 1, 2.0, True, 1, 2, None, 50.0), (2, 1, 4, 3.0, True, 3, 4, None, 25.0),
    (2, 2, None, None, None, None, None, 0.2, 25.0), (2, 3, None, None, None, None, None, -0.2, 15.0),
    (2, 4, None, None, None, None, None, 0.8, 10.0)]

# leaf value, first input, its side, its share, second input, its side, its share
MODEL_LEAVES = [
    (-0.8, "n_chars", "n_chars <= 900", 0.4, None, "TRUE", 1.0),
    (0.6, "n_chars", "n_chars > 900", 0.6, "n_words", "n_words <= 400", 0.4),
    (1.2, "n_chars", "n_chars > 900", 0.6, "n_words", "n_words > 400", 0.6),
    (0.4, "n_lines", "coalesce(n_lines <= 6, FALSE)", 0.3, None, "TRUE", 1.0),
    (0.2, "n_lines", "coalesce(n_lines > 6, TRUE)", 0.7, "lang", "lang_code <= 1", 0.6),
    (-0.6, "n_lines", "coalesce(n_lines > 6, TRUE)", 0.7, "lang", "lang_code > 1", 0.4),
    (-0.2, "source", "source_code <= 2", 0.5, "n_lines", "coalesce(n_lines <= 3, TRUE)", 0.6),
    (0.8, "source", "source_code <= 2", 0.5, "n_lines", "coalesce(n_lines > 3, FALSE)", 0.4),
    (0.2, "source", "source_code > 2", 0.5, None, "TRUE", 1.0)]


def _leaf_sql(value, one, side_one, share_one, two, side_two, share_two):
    second = f"'{two}'" if two else "NULL"
    return (f"SELECT doc_id, {value} AS v, '{one}' AS f1, CAST({side_one} AS INTEGER) AS i1, {share_one} AS z1, {second} AS f2, "
            f"CAST({side_two} AS INTEGER) AS i2, {share_two} AS z2 FROM x")


MODEL_SQL = MODEL_ROWS + f""",
leaves AS ({" UNION ALL ".join(_leaf_sql(*leaf) for leaf in MODEL_LEAVES)}),
p AS (SELECT doc_id, 1 / (1 + exp(-sum(v * i1 * i2))) AS p FROM leaves GROUP BY doc_id),
scored AS (SELECT x.*, p, CASE WHEN p <= 0.65 THEN 'Low' WHEN p <= 0.75 THEN 'Medium' ELSE 'High' END AS risk_tier FROM x JOIN p USING (doc_id)),
names AS (SELECT unnest(['lang', 'source', 'n_chars', 'n_words', 'n_lines']) AS feature),
phi AS (SELECT doc_id, f1 AS feature, v * (i1 - z1) * CASE WHEN f2 IS NULL THEN 1 ELSE (i2 + z2) / 2 END AS c FROM leaves
        UNION ALL SELECT doc_id, f2, v * (i2 - z2) * (i1 + z1) / 2 FROM leaves WHERE f2 IS NOT NULL),
contributions AS (SELECT doc_id, feature, sum(coalesce(c, 0)) AS c FROM x CROSS JOIN names LEFT JOIN phi USING (doc_id, feature) GROUP BY 1, 2)
"""


def _stored_model(spark, sf):
    """The fixed model with the vocabulary of the labelled documents, stored and loaded again."""
    root = scratch_path(spark, "fixed-model")
    encoder = features.vocabulary_encoder(_documents(spark, sf), CATEGORICAL, root)
    path = trees.stored_nodes(spark.createDataFrame(MODEL_NODES, trees.NODES), root)
    PipelineModel([encoder, trees.TreeScorer(path=path, inputCols=INPUTS, logit=True)]).write().save(f"{root}/model")
    return PipelineModel.load(f"{root}/model")


@query("importance", "M19", f"""
WITH {MODEL_SQL} SELECT feature, round(avg(abs(c)), 6) AS mean_abs_contribution FROM contributions GROUP BY feature
""")
def importance(spark, sf):
    model, rows = _stored_model(spark, sf), _documents(spark, sf)
    names = [attribution.plain_name(n, CATEGORICAL + NUMERIC) for n in attribution.input_names(model, rows)]
    out = attribution.importance(attribution.attribute(model.transform(rows), model, KEY), names)
    return out.withColumn("mean_abs_contribution", F.round("mean_abs_contribution", 6))


def _scored(spark, sf):
    return scoring.score_with_drivers(_stored_model(spark, sf), _documents(spark, sf), KEY, CATEGORICAL + NUMERIC)


@query("drivers", "M24 W10 F28 F29 F32", f"""
WITH {MODEL_SQL}, ranked AS (SELECT doc_id, feature, c, row_number() OVER (PARTITION BY doc_id ORDER BY -abs(round(c, 4)), feature) AS n
  FROM contributions),
said AS (SELECT *, CASE feature WHEN 'n_chars' THEN 'Text length' WHEN 'n_words' THEN 'Word count' WHEN 'n_lines' THEN 'Line count'
  WHEN 'lang' THEN 'Lang' ELSE 'Source' END || CASE WHEN c > 1e-9 THEN ' (increases risk)' ELSE ' (decreases risk)' END AS words
  FROM ranked WHERE n <= 3)
SELECT doc_id, max(feature) FILTER (WHERE n = 1) AS top_driver_feature, max(CASE WHEN c > 1e-9 THEN 'increases_risk' ELSE
  'decreases_risk' END) FILTER (WHERE n = 1) AS top_driver_direction, string_agg(words, '; ' ORDER BY n) AS sentence, CAST(count(*) AS
  INTEGER) AS n_drivers FROM said GROUP BY doc_id
""")
def drivers(spark, sf):
    from linegauge.functions.nested import driver_sentence

    labels = {"n_chars": "Text length", "n_words": "Word count", "n_lines": "Line count"}
    return _scored(spark, sf).select(KEY, "top_driver_feature", "top_driver_direction",
                                     driver_sentence(F.col("drivers"), labels).alias("sentence"),
                                     F.size("drivers").alias("n_drivers"))


@query("score_batch", "M22 M23 S5 S6", f"""
WITH {MODEL_SQL} SELECT '2026' || lang AS period_label, risk_tier, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (PARTITION BY '2026' || lang), 6) AS share FROM scored GROUP BY 1, 2
""")
def score_batch(spark, sf):
    from linegauge.sources.sinks import write_partitioned

    out = _scored(spark, sf).select(KEY, "lang", "defect_probability", "risk_tier", "drivers", "top_driver_feature",
                                    F.col(LABEL).alias("actual_defect_flag"), F.concat(F.lit("2026"), "lang").alias("period_label"))
    path = write_partitioned(out, scratch_path(spark, "predictions"), "period_label")
    back = spark.read.parquet(path)
    return evaluate.tier_counts(back, "risk_tier", ["period_label"]).withColumn("share", F.round("share", 6))


@query("stored_scores", "M22", f"""
WITH {MODEL_SQL} SELECT doc_id, round(p, 4) AS defect_probability, risk_tier FROM scored
""")
def stored_scores(spark, sf):
    return scoring.score(_stored_model(spark, sf), _documents(spark, sf)).select(KEY, "defect_probability", "risk_tier")


@query("validation_reference", "M21", f"""
WITH {MODEL_SQL} SELECT round(p, 4) AS defect_probability, CAST(quality AS INTEGER) AS quality FROM scored WHERE held_out
""")
def validation_reference(spark, sf):
    _, validation = _sides(spark, sf)
    return scoring.validation_reference(_stored_model(spark, sf), validation, LABEL)


@query("feature_export", "M3", """
WITH r AS (SELECT o_orderkey, o_totalprice, o_orderdate, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' WHEN
  o_orderdate < TIMESTAMP '2000-07-01' THEN 'validation' ELSE 'test' END AS split, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y
  FROM orders WHERE o_orderdate IS NOT NULL)
SELECT split, CAST(2 AS BIGINT) AS version, count(*) AS n, count(*) AS n_listed, CAST(sum(o_orderkey) AS BIGINT) AS id_sum,
  CAST(sum(y) AS BIGINT) AS n_positive, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS value_sum, 3 AS n_features,
  strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM r GROUP BY split
""")
def feature_export(spark, sf):
    """Feature rows exported twice as a snapshot, the second version read back by split: rows, features and time order."""
    from linegauge.sources import snapshots

    orders = table(spark, sf, "orders")
    rows = orders.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate", (F.col("o_orderstatus") == "F").cast("int").alias("y"),
                         features.time_split("o_orderdate", "1998-12-31", "2000-06-30").alias("split"))
    rows = rows.where("split IS NOT NULL")
    root = scratch_path(spark, "feature-snapshots")
    snapshots.export(rows.limit(0), root, "split")
    snapshots.export(rows, root, "split")
    back = snapshots.read(spark, root)
    found = back.groupBy("split").agg(
        F.count("*").alias("n"), F.sum("o_orderkey").alias("id_sum"), F.sum("y").alias("n_positive"),
        F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), 2).alias("value_sum"),
        day(F.min("o_orderdate")).alias("first_day"), day(F.max("o_orderdate")).alias("last_day"))
    listed = snapshots.manifest(spark, root).select("split", "version", F.col("n").alias("n_listed"))
    n_features = len([c for c in back.columns if c not in ("o_orderkey", "y", "split")])
    return found.join(listed, "split").withColumn("n_features", F.lit(n_features)).select(
        "split", "version", "n", "n_listed", "id_sum", "n_positive", "value_sum", "n_features", "first_day", "last_day")


@query("model_log", "M26 S12", f"""
WITH {RANKED}, a AS (SELECT round(sum(pos * (below + neg / 2)) / (max(p) * max(n)), 4) AS roc_auc FROM r)
SELECT run_id, CAST(version AS BIGINT) AS version, version = 2 AS is_latest, roc_auc FROM a,
  (VALUES ('run-1', 1), ('run-2', 2)) t(run_id, version)
""")
def model_log(spark, sf):
    root = scratch_path(spark, "runs")
    values = evaluate.metrics(scored_documents(spark, sf), "score", LABEL).first().asDict()
    for version in (1, 2):
        runlog.log_run(spark, root, f"run-{version}", "training", "quality", version, values, {"family": "text length"})
    latest = runlog.latest_version(spark, root, "quality").select("run_id").scalar()
    return runlog.version_history(spark, root, "quality").select(
        "run_id", "version", (F.col("run_id") == latest).alias("is_latest"),
        F.round(F.col("metrics")["roc_auc"], 4).alias("roc_auc"))


