"""Training: three model families, seeded search on a fixed validation split, learning curve.

Fits are Spark ML jobs over the training DataFrame; trials are independent and submitted
from a few driver threads. Prepared vectors are persisted once (memory and disk), never
collected.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from threading import Lock

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linegauge.operators import trees
from linegauge.operators.evaluate import metrics
from linegauge.operators.features import fit_stages, linear_stages, vocabulary_encoder
from linegauge.operators.prefix import running_sums
from linegauge.session import cut_lineage, fan_out

SEED = 42


@dataclass
class Trained:
    family: str
    params: dict
    model: PipelineModel
    validation_auc: float


def probability(df: DataFrame, out: str = "probability_1") -> DataFrame:
    """Probability of the positive class; a forest's prediction is one."""
    return df.withColumn(out, vector_to_array("probability")[1] if "probability" in df.columns else F.col("prediction"))


def positive_weight(df: DataFrame, label: str) -> float:
    """Negatives per positive in the training rows."""
    y = F.col(label).cast("int")
    row = df.agg(F.coalesce(F.sum(y), F.lit(0)).alias("p"), F.count(label).alias("n")).first()
    return (row["n"] - row["p"]) / max(row["p"], 1)


def auc(scored: DataFrame, label: str) -> float:
    return metrics(scored, "probability_1", label).first()["roc_auc"] or 0.0


def draw(rng: random.Random, space: Mapping[str, tuple]) -> dict:
    """One parameter set: ('log', a, b), ('uniform', a, b), ('int', a, b) or ('choice', values)."""
    def one(kind: str, *args):
        if kind == "log":
            return math.exp(rng.uniform(math.log(args[0]), math.log(args[1])))
        if kind == "uniform":
            return rng.uniform(*args)
        if kind == "int":
            return rng.randint(*args)
        return rng.choice(args[0])

    return {name: one(*spec) for name, spec in space.items()}


# Search spaces of the three families.
SPACES = {
    "logistic_regression": {"C": ("log", 1e-3, 100.0)},
    "random_forest": {"trees": ("int", 100, 500), "depth": ("int", 3, 20), "leaf": ("int", 1, 50),
                      "subset": ("choice", ["sqrt", "log2", "0.5"])},
    "boosted_trees": {"step": ("log", 0.01, 0.3), "depth": ("int", 3, 10), "sample": ("uniform", 0.6, 1.0),
                      "columns": ("uniform", 0.6, 1.0), "leaf": ("int", 1, 10)},
}
#: Most rounds of boosting, and rounds without a higher validation ROC-AUC after which it ends.
ROUNDS, PATIENCE = 1000, 30
#: Rounds of boosting where nothing is held out to end it early.
CURVE_ROUNDS = 200


def logistic(p: Mapping, n_rows: int) -> LogisticRegression:
    # penalty 1 / (C n) on the summed loss is 1 / C on the mean loss per row
    return LogisticRegression(labelCol="y", regParam=1.0 / (p["C"] * max(n_rows, 1)), elasticNetParam=0.0,
                              standardization=False, maxIter=100)


def forest(p: Mapping) -> RandomForestRegressor:
    """Trees whose leaves hold the share of positives; of two classes, variance ranks splits as the Gini impurity does.

    A classifier's trees are cut back where two leaves have the same majority, which loses their shares.
    """
    return RandomForestRegressor(labelCol="y", numTrees=p["trees"], maxDepth=p["depth"], minInstancesPerNode=p["leaf"],
                                 featureSubsetStrategy=p["subset"], bootstrap=p.get("bootstrap", True), seed=SEED)


class Preparation:
    """Fitted encoders of one family: ``vectors`` for fitting, and the stages a stored model begins with."""

    def __init__(self, train: DataFrame, family: str, categorical: Sequence[str], numeric: Sequence[str], root: str | None = None):
        self.family, self.root = family, root
        if family == "logistic_regression":
            self.stages = fit_stages(linear_stages(categorical, numeric), train).stages
            return
        encoder = vocabulary_encoder(train, categorical, root)
        self.stages = [encoder]
        self.codes, self.numbers = encoder.getOutputCols(), list(numeric)
        self.slots = trees.slots_of(len(self.codes), len(self.numbers))

    def vectors(self, df: DataFrame) -> DataFrame:
        """``df`` with features; for trees these are slots."""
        out = PipelineModel(self.stages).transform(df)
        return out if self.family == "logistic_regression" else out.withColumn("features", trees.slot_vector(self.codes, self.numbers))

    def tree_model(self, nodes: DataFrame, logit: bool) -> PipelineModel:
        path = trees.stored_nodes(nodes, self.root)
        return PipelineModel([*self.stages, trees.TreeScorer(path=path, inputCols=[*self.codes, *self.numbers], logit=logit)])

    def boosted_model(self, spark, rows: Sequence[tuple]) -> PipelineModel:
        return self.tree_model(spark.createDataFrame(rows, trees.NODES), True)

    def forest_model(self, spark, model) -> PipelineModel:
        return self.tree_model(trees.forest_nodes(spark, model, self.slots), False)


def tune(train: DataFrame, validation: DataFrame, label: str, family: str, categorical: Sequence[str],
         numeric: Sequence[str], trials: int = 150, parallelism: int = 4, rounds: int = ROUNDS,
         space: Mapping[str, tuple] | None = None, patience: int = PATIENCE, root: str | None = None) -> Trained:
    """Seeded random search; the best validation ROC-AUC wins.

    Boosted trees see the validation rows only to end early, and are weighted by the class odds of the
    training rows. Missing numbers go to the better side of each split of a tree; the linear family
    takes them for 0. Tables of a tree model are stored below ``root``, or in the scratch folder.
    """
    spark = train.sparkSession
    # fitting the encoders takes several passes; the rows are computed once
    train = train.select(*categorical, *numeric, label).persist(StorageLevel.MEMORY_AND_DISK)
    cached = [train]
    rng = random.Random(SEED)
    params = [draw(rng, space or SPACES[family]) for _ in range(trials)]
    best: list = []  # value, trial and model of the best so far; the others are dropped as they come
    lock = Lock()
    try:
        prep = Preparation(train, family, categorical, numeric, root)
        y = F.col(label).cast("double").alias("y")
        weight = positive_weight(train, label) if family == "boosted_trees" else 1.0
        n_rows = train.count()

        def vectors(df: DataFrame, held_out: bool) -> DataFrame:
            w = F.when(F.col(label).cast("int") == 1, weight).otherwise(1.0).alias("weight")
            return prep.vectors(df).select("features", y, w, F.lit(held_out).alias("held_out"))

        fit_rows, held_out = vectors(train, False), vectors(validation, True)
        if family == "boosted_trees":
            both = fit_rows.unionByName(held_out).persist(StorageLevel.MEMORY_AND_DISK)
            cached.append(both)
        else:
            fit_rows, held_out = (rows.persist(StorageLevel.MEMORY_AND_DISK) for rows in (fit_rows, held_out))
            cached += [fit_rows, held_out]

        def run(trial: int) -> None:
            p = params[trial]
            if family == "boosted_trees":
                model, aucs = trees.boost(both, p, prep.slots, rounds, patience, SEED)
                value = max(aucs, default=0.0)
            else:
                model = (logistic(p, n_rows) if family == "logistic_regression" else forest(p)).fit(fit_rows)
                value = auc(probability(model.transform(held_out)), "y")
            with lock:
                if not best or (value, -trial) > (best[0], -best[1]):
                    best[:] = [value, trial, model]

        with ThreadPoolExecutor(parallelism) as pool:
            list(pool.map(run, range(trials)))
    finally:
        for rows in cached:
            rows.unpersist()
    value, trial, model = best
    found = params[trial]
    if family == "logistic_regression":
        return Trained(family, found, PipelineModel([*prep.stages, model]), value)
    if family == "random_forest":
        return Trained(family, found, prep.forest_model(spark, model), value)
    return Trained(family, {**found, "rounds": 1 + max((r[0] for r in model), default=-1)}, prep.boosted_model(spark, model), value)


def best_of(candidates: Sequence[Trained]) -> Trained:
    return max(candidates, key=lambda t: t.validation_auc)


def comparison(spark, candidates: Sequence[Trained]) -> DataFrame:
    """Model families by validation ROC-AUC, best first."""
    rows = [(t.family, float(t.validation_auc), {k: str(v) for k, v in t.params.items()}) for t in candidates]
    return spark.createDataFrame(rows, "family string, validation_auc double, params map<string,string>").orderBy(
        F.desc("validation_auc"), "family")


def fold_of(key: str, folds: int) -> Column:
    """Fold of a row by the hash of its id: stable under retries and repartitioning."""
    return F.pmod(F.xxhash64(F.lit(SEED), F.col(key)), F.lit(folds))


#: Hex digits of the hash that puts rows in an order of their own.
ORDER_DIGITS = 13


def class_folds(df: DataFrame, key: str, label: str, folds: int = 3, ranges: int | None = None) -> DataFrame:
    """``df`` with fold, and place_<f>: the row's place among those trained on when fold f is held out.

    Rows are put in the order of a hash of their id (then of the id). Every class deals its rows out to
    the folds in turn, so all folds have the same class shares and sizes up to one row per class, and
    the first n places are exactly n rows. Ranks are running counts over ranges of the hash, so no task
    orders all rows of a class.
    """
    ranges = fan_out(df.sparkSession) if ranges is None else ranges
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    order = F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), text).cast("binary")), 1, ORDER_DIGITS), 16, 10).cast("bigint")
    rows = df.withColumn("_order", order)

    def before(counts: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
        """Per (keys, _order), the sums of all smaller hashes."""
        run = running_sums(counts, keys, "_order", measures, ranges)
        return run.select(*keys, "_order", *[(F.col(f"{m}_upto") - F.col(m)).alias(f"_before_{m}") for m in measures])

    sizes = before(rows.groupBy(label, "_order").agg(F.count("*").alias("n")), [label], ["n"])
    # rows of one hash are few: two of them meet once in 2^52
    rank = F.col("_before_n") + F.row_number().over(W.partitionBy(label, "_order").orderBy(key)) - 1
    dealt = rows.join(sizes, [label, "_order"]).withColumn("fold", (rank % folds).cast("int")).drop("_before_n")
    own = [(F.col("fold") != f).cast("bigint").alias(f"m{f}") for f in range(folds)]
    marked = dealt.select("*", *own)
    measures = [f"m{f}" for f in range(folds)]
    sizes = before(marked.groupBy("_order").agg(*[F.sum(m).alias(m) for m in measures]), [], measures)
    inside = W.partitionBy("_order").orderBy(label, key).rowsBetween(W.unboundedPreceding, W.currentRow)
    places = [F.when(F.col(m) == 1, F.col(f"_before_{m}") + F.sum(m).over(inside) - 1).alias(f"place_{f}") for f, m in enumerate(measures)]
    return marked.join(sizes, "_order").select(*df.columns, "fold", *places)


def curve_sizes(folded: DataFrame, folds: int, sizes: Sequence[float]) -> list[int]:
    """Rows of every prefix: parts of the smallest training side, that of fold 0."""
    most = folded.where("fold <> 0").count() if folds > 1 else folded.count()
    return [max(1, int(size * most + 1e-9)) for size in sizes]


def learning_curve(df: DataFrame, key: str, label: str, family: str, params: Mapping, categorical: Sequence[str],
                   numeric: Sequence[str], sizes: Sequence[float] | None = None, folds: int = 3,
                   parallelism: int = 4, rounds: int = CURVE_ROUNDS) -> DataFrame:
    """Mean and spread of train and validation ROC-AUC by train size (8 sizes x 3 folds with equal class shares).

    Boosted trees have ``rounds`` rounds here, as nothing is held out to end them early.
    """
    sizes = sizes or [0.1 + 0.9 * i / 7 for i in range(8)]
    folded = class_folds(df.where(F.col(label).isNotNull()).select(key, label, *categorical, *numeric), key, label, folds)
    # every iteration of a fit has a task per partition: stored, there are as many as the rows need; cached, one per shuffle partition
    folded = cut_lineage(folded)
    spark = df.sparkSession
    prep = Preparation(folded, family, categorical, numeric)
    rows = prep.vectors(folded).select("features", F.col(label).cast("double").alias("y"), "fold", *[f"place_{f}" for f in range(folds)],
                                       F.lit(1.0).alias("weight"), F.lit(False).alias("held_out"),
                                       *([] if family == "logistic_regression" else [*prep.codes, *prep.numbers]))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        jobs = [(f, float(s), n) for s, n in zip(sizes, curve_sizes(folded, folds, sizes)) for f in range(folds)]

        def run(job: tuple[int, float, int]) -> DataFrame:
            fold, size, n = job
            inside = rows.where(F.col(f"place_{fold}") < n)
            if family == "boosted_trees":
                nodes, _ = trees.boost(inside, params, prep.slots, rounds, None, SEED)
                fitted = prep.boosted_model(spark, nodes).stages[-1]
            else:
                fitted = (logistic(params, n) if family == "logistic_regression" else forest(params)).fit(inside)
            out = F.col("fold") == fold
            both = rows.where((F.col(f"place_{fold}") < n) | out).withColumn("validation", out)
            return probability(fitted.transform(both)).select(
                F.lit(size).alias("size"), F.lit(fold).alias("held_fold"), "validation", "probability_1", "y")

        with ThreadPoolExecutor(parallelism) as pool:
            # all models' rows are ranked in one pass, not a pass per model and side
            scored = cut_lineage(reduce(DataFrame.unionAll, pool.map(run, jobs)))
    finally:
        rows.unpersist()
    areas = metrics(scored, "probability_1", "y", keys=["size", "held_fold", "validation"])
    side = lambda validation: F.max(F.when(F.col("validation") == validation, F.col("roc_auc")))
    areas = areas.groupBy("size", "held_fold").agg(side(False).alias("train_auc"), side(True).alias("validation_auc"))
    points = spark.createDataFrame(jobs, "held_fold int, size double, n long").join(areas, ["size", "held_fold"], "left").fillna(
        0.0, ["train_auc", "validation_auc"])
    return points.groupBy("size").agg(
        F.avg("n").alias("train_size"), F.avg("train_auc").alias("train_roc_auc"),
        F.stddev_pop("train_auc").alias("train_roc_auc_std"), F.avg("validation_auc").alias("val_roc_auc"),
        F.stddev_pop("validation_auc").alias("val_roc_auc_std")).orderBy("size")
