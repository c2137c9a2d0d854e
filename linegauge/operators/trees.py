"""Tree ensembles as tables: fitting, early stopping, storing and scoring.

A model is a table of nodes over named inputs (codes of categories, plain numbers). A missing number
goes to the side of a split that its training rows showed to be better. Spark's trees do not know
missing numbers, so they are fitted on two slots per number, one with missing as the least and one
with missing as the greatest value: a split on the first sends missing left, one on the second right.
In the node table both are the same input again. Node tables grow with the trees' number and depth
only, never with the data.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.operators.evaluate import metrics
from linegauge.session import cut_lineage, scratch_path

#: Stands for a missing number in the slots that trees are fitted on; no measured number is as large.
BEYOND = 1e300
NODES = "tree int, node int, feature int, cut double, missing_left boolean, left int, right int, value double, cover double"
#: Rounds of boosting between two looks at the held-out rows, and between two cuts of the lineage.
LOOK_EVERY = 10

Slot = tuple[int, bool]  # input, and whether a missing value goes left


def slots_of(n_codes: int, n_numbers: int) -> list[Slot]:
    """One slot per code (never missing), two per number."""
    return [(i, True) for i in range(n_codes)] + [(n_codes + i, left) for i in range(n_numbers) for left in (True, False)]


def slot_vector(codes: Sequence[str], numbers: Sequence[str]) -> Column:
    """The vector trees are fitted on; null and NaN are missing."""
    def filled(c: str, value: float) -> Column:
        x = F.col(c).cast("double")
        return F.when(x.isNull() | F.isnan(x), value).otherwise(x)

    pairs = [filled(c, v) for c in numbers for v in (-BEYOND, BEYOND)]
    return array_to_vector(F.array(*[F.col(c).cast("double") for c in codes], *pairs))


# -- node tables -----------------------------------------------------------------

def forest_nodes(spark: SparkSession, model, slots: Sequence[Slot]) -> DataFrame:
    """Nodes of a fitted random forest regressor, read from its stored form; leaves hold their part of the mean."""
    path = scratch_path(spark, "forest")
    model.write().save(path)
    slot = F.get(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(left).alias("left")) for f, left in slots]), F.col("split.featureIndex"))
    inner = lambda c: F.when(F.col("leftChild") >= 0, c)
    return spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*").select(
        "tree", F.col("id").alias("node"), inner(slot["feature"]).alias("feature"),
        inner(F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("cut"), inner(slot["left"]).alias("missing_left"),
        inner(F.col("leftChild")).alias("left"), inner(F.col("rightChild")).alias("right"),
        F.when(F.col("leftChild") < 0, F.col("prediction") / model.getNumTrees).alias("value"),
        F.get("impurityStats", F.lit(0)).alias("cover"))


def tree_nodes(tree, number: int, slots: Sequence[Slot], scale: float) -> list[tuple]:
    """Rows of ``NODES`` of one fitted regression tree, numbered from the root in preorder."""
    rows: list[tuple] = []

    def add(node) -> int:
        at = len(rows)
        rows.append(())
        cover = float(node.impurityStats().count())
        if node.subtreeDepth() == 0:
            rows[at] = (number, at, None, None, None, None, None, scale * float(node.prediction()), cover)
            return at
        split = node.split()
        feature, missing_left = slots[int(split.featureIndex())]
        left, right = add(node.leftChild()), add(node.rightChild())
        rows[at] = (number, at, feature, float(split.threshold()), missing_left, left, right, None, cover)
        return at

    add(tree._java_obj.rootNode())
    return rows


class NodeArrays:
    """Nodes of all trees in arrays; children are places in these arrays, leaves have feature -1."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
        first = np.flatnonzero(nodes["tree"].diff().fillna(1).to_numpy() != 0)
        offset = np.repeat(first, np.diff(np.r_[first, len(nodes)]))
        self.roots = first
        self.feature = nodes["feature"].fillna(-1).to_numpy().astype(np.int64)
        self.cut = nodes["cut"].fillna(0.0).to_numpy().astype(float)
        self.missing_left = nodes["missing_left"].eq(True).to_numpy()
        self.left, self.right = (nodes[side].fillna(0).to_numpy().astype(np.int64) + offset for side in ("left", "right"))
        self.value = nodes["value"].fillna(0.0).to_numpy().astype(float)
        self.cover = nodes["cover"].to_numpy().astype(float)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves every row of ``x`` (NaN: missing) falls into."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while (inner := self.feature[at] >= 0).any():
                v = x[rows, np.maximum(self.feature[at], 0)]
                left = np.where(np.isnan(v), self.missing_left[at], v <= self.cut[at])
                at = np.where(inner, np.where(left, self.left[at], self.right[at]), at)
            total += self.value[at]
        return total

    def leaves(self) -> Iterator[tuple[float, dict]]:
        """(value, {input: (lower, upper, missing, share)}) of every leaf.

        A value is on the leaf's side of its input's splits if lower < value <= upper, a missing one if
        ``missing``; ``share`` is the part of the training rows that follows these splits.
        """
        for root in self.roots:
            todo: list[tuple[int, dict]] = [(int(root), {})]
            while todo:
                at, path = todo.pop()
                f = int(self.feature[at])
                if f < 0:
                    yield float(self.value[at]), path
                    continue
                low, high, missing, share = path.get(f, (-np.inf, np.inf, True, 1.0))
                cut, to_left = self.cut[at], bool(self.missing_left[at])
                for child, a, b, m in ((int(self.left[at]), low, min(high, cut), missing and to_left),
                                       (int(self.right[at]), max(low, cut), high, missing and not to_left)):
                    part = self.cover[child] / self.cover[at] if self.cover[at] > 0 else 0.0
                    todo.append((child, {**path, f: (a, b, m, share * part)}))


class TreeScorer(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Probability of rows by a stored node table: the sum of base and leaves, on the log-odds scale if ``logit``."""

    path = Param(Params._dummy(), "path", "folder of the node table", TypeConverters.toString)
    base = Param(Params._dummy(), "base", "what the leaves' values are added to", TypeConverters.toFloat)
    logit = Param(Params._dummy(), "logit", "whether the sum is a log-odds", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, path=None, inputCols=None, base=None, logit=None):
        super().__init__()
        self._setDefault(base=0.0, logit=True)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def node_arrays(self) -> NodeArrays:
        """The model's nodes; their number has the bound of the model's trees and depth."""
        return NodeArrays(SparkSession.active().read.schema(NODES).parquet(self.getOrDefault(self.path)).toPandas())

    def _transform(self, df: DataFrame) -> DataFrame:
        nodes = df.sparkSession.sparkContext.broadcast(self.node_arrays())

        @F.pandas_udf("double")
        def leaf_sum(*inputs: pd.Series) -> pd.Series:
            return pd.Series(nodes.value.sums(np.column_stack([s.to_numpy(float, na_value=np.nan) for s in inputs])))

        total = F.lit(self.getOrDefault(self.base)) + leaf_sum(*[F.col(c).cast("double") for c in self.getInputCols()])
        p = 1 / (1 + F.exp(-total)) if self.getOrDefault(self.logit) else total
        return df.withColumn("_p", p).withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))).drop("_p")


# -- boosting --------------------------------------------------------------------

def best_round(aucs: Sequence[float], patience: int) -> tuple[int, bool]:
    """The first round with the highest value before ``patience`` rounds brought no higher one, and whether they did."""
    best = 0
    for n, value in enumerate(aucs):
        if value > aucs[best]:
            best = n
        elif n - best >= patience:
            return best, True
    return best, False


def boost(rows: DataFrame, params: Mapping, slots: Sequence[Slot], rounds: int, patience: int | None = 30, seed: int = 42) -> tuple[list[tuple], list[float]]:
    """Boosted trees on the log-odds: node rows up to the best round, and the held-out ROC-AUC of every round looked at.

    ``rows`` has features (slots), y (0 or 1), weight and held_out. Each round fits a regression tree to the
    Newton step of the logistic loss on a sample of rows and inputs; every row carries its running sum
    and, between two looks, the sums after each round, so that the ROC-AUC of all these rounds comes from
    one pass over the held-out rows. Without ``patience`` all rounds count.
    """
    rng = random.Random(seed)
    names = sorted({f for f, _ in slots})
    state = rows.select("features", "y", "weight", "held_out", F.lit(0.0).alias("total"), F.array().cast("array<double>").alias("recent"))
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[list[tuple]] = []
    aucs: list[float] = []
    try:
        for n in range(rounds):
            chosen = set(rng.sample(names, max(1, round(params.get("columns", 1.0) * len(names)))))
            places = [i for i, (f, _) in enumerate(slots) if f in chosen]
            p = 1 / (1 + F.exp(-F.col("total")))
            curve = F.greatest(p * (1 - p), F.lit(1e-16))
            sliced = VectorSlicer(inputCol="features", outputCol="some", indices=places).transform(
                state.withColumns({"step": (F.col("y") - p) / curve, "curve": F.col("weight") * curve}))
            sample = sliced.where(~F.col("held_out") & (F.rand(seed + n) < params["sample"]))
            tree = DecisionTreeRegressor(featuresCol="some", labelCol="step", weightCol="curve", maxDepth=params["depth"],
                                         minInstancesPerNode=params["leaf"], maxBins=64, seed=seed).fit(sample)
            trees.append(tree_nodes(tree, n, [slots[i] for i in places], params["step"]))
            after = F.col("total") + params["step"] * F.col("prediction")
            new = tree.transform(sliced).select("features", "y", "weight", "held_out", after.alias("total"),
                                                F.concat("recent", F.array(after)).alias("recent"))
            look = len(trees) % LOOK_EVERY == 0 or len(trees) == rounds
            if look and patience is not None:
                aucs += round_aucs(new.where("held_out"))
                if best_round(aucs, patience)[1]:
                    break
            if look:
                new = cut_lineage(new.withColumn("recent", F.array().cast("array<double>")))
            new = new.persist(StorageLevel.MEMORY_AND_DISK)
            new.count()  # filled before what it comes from is given up
            state.unpersist()
            state = new
    finally:
        state.unpersist()
    best = trees if patience is None else trees[:best_round(aucs, patience)[0] + 1]
    return [row for tree in best for row in tree], aucs


def round_aucs(held_out: DataFrame) -> list[float]:
    """ROC-AUC after each of the recent rounds, in their order, from one pass."""
    each = held_out.select("y", F.posexplode("recent").alias("round", "score"))
    found = metrics(each, "score", "y", keys=["round"]).select("round", "roc_auc").collect()  # one row per recent round
    return [r["roc_auc"] or 0.0 for r in sorted(found, key=lambda r: r["round"])]


def stored_nodes(nodes: DataFrame, root: str | None = None) -> str:
    """Folder of the node table, below ``root`` or in the scratch folder."""
    path = f"{root}/nodes" if root else scratch_path(nodes.sparkSession, "nodes")
    nodes.write.mode("overwrite").parquet(path)
    return path
