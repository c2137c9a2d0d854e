"""Per-row driver attribution: exact Shapley values of linear and tree models.

Linear: coefficient times distance from the mean. Trees: path-dependent Shapley values per
leaf, vectorised over the rows of an Arrow batch; the flattened ensemble travels to the
tasks as a broadcast variable whose size depends on the model (leaves x depth), not on the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.functions.nested import driver, top_drivers
from linegauge.operators.trees import TreeScorer

# Numbers in one block of leaves x path x rows.
BLOCK_CELLS = 1 << 20


def input_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Name of every input of a tree model, or of every slot of a linear one's vector, by the vector's own attributes."""
    if isinstance(model.stages[-1], TreeScorer):
        return model.stages[-1].getInputCols()
    meta = model.transform(df.limit(0)).schema["features"].metadata["ml_attr"]
    slots = {a["idx"]: a["name"] for group in meta["attrs"].values() for a in group}
    assembled = [c for c in model.stages[-2].getInputCols()]
    return [slots.get(i, assembled[i] if i < len(assembled) else f"f{i}") for i in range(meta["num_attrs"])]


def plain_name(slot: str, originals: Sequence[str]) -> str:
    """Original column behind an encoded slot."""
    hits = [o for o in originals if slot == o or slot.startswith(f"{o}_")]
    return max(hits, key=len) if hits else slot


# -- trees ---------------------------------------------------------------------

Leaf = tuple[float, dict]  # value, {input: (lower, upper, missing, share)}


def ensemble_rules(model: TreeScorer) -> list[Leaf]:
    """All leaves of a stored ensemble on its additive scale: log-odds of boosted trees, probability of forests."""
    return list(model.node_arrays().leaves())


def leaf_groups(rules: Sequence[Leaf]) -> list[tuple[np.ndarray, ...]]:
    """Leaves by path length: values and (leaf x path) arrays of inputs, bounds, missing and shares."""
    by_length: dict[int, list] = {}
    for value, path in rules:
        if path and value != 0.0:
            by_length.setdefault(len(path), []).append((value, list(path.items())))
    groups = []
    for leaves in by_length.values():
        column = lambda k, kind=float: np.array([[p[1][k] for p in path] for _, path in leaves], kind)
        inputs = np.array([[p[0] for p in path] for _, path in leaves], int)
        groups.append((np.array([v for v, _ in leaves]), inputs, column(0), column(1), column(2, bool), column(3)))
    return groups


def leaf_contributions(x: np.ndarray, rules: Sequence[Leaf]) -> np.ndarray:
    """Shapley values (rows x inputs; NaN is missing) summed over leaves.

    A leaf pays its value when every input on its path is either known and on the leaf's side of its
    splits, or unknown with probability ``share``. For an input i the weighted sum over
    subsets of the other path inputs is a polynomial in the subset size, built up one
    input at a time. All leaves of one path length are worked through together, a block of
    them at a time so that the arrays stay small.
    """
    n, width = x.shape
    out = np.zeros((width, n))
    for values, inputs, low, high, missing, share in leaf_groups(rules):
        d = inputs.shape[1]
        weights = [factorial(k) * factorial(d - k - 1) / factorial(d) for k in range(d)]
        block = max(1, BLOCK_CELLS // (n * d))
        for at in range(0, values.size, block):
            part = slice(at, at + block)
            f, z = inputs[part], share[part, :, None]
            cells = x.T[f]
            within = (cells > low[part, :, None]) & (cells <= high[part, :, None])
            inside = np.where(np.isnan(cells), missing[part, :, None], within).astype(float)
            for i in range(d):
                poly = np.zeros((d, f.shape[0], n))
                poly[0] = 1.0
                for j in range(d):
                    if j != i:
                        poly[1:] = poly[1:] * z[:, j] + poly[:-1] * inside[:, j]
                        poly[0] *= z[:, j]
                gain = values[part, None] * (inside[:, i] - z[:, i]) * np.tensordot(weights, poly, 1)
                np.add.at(out, f[:, i], gain)
    return out.T


# -- both families -------------------------------------------------------------

def linear_attribution(scored: DataFrame, model: LogisticRegressionModel, period: str | None = None) -> DataFrame:
    """Coefficient x (value - mean) per feature; means are those of the row's period.

    Each period is explained by itself, so its drivers are the same whatever is scored beside it.
    Without ``period`` all rows are one.
    """
    n = model.numFeatures
    rows = scored.withColumn("_x", vector_to_array("features"))
    means = F.array(*[F.avg(F.col("_x")[i]) for i in range(n)]).alias("_m")
    if period is None:
        rows = rows.withColumn("_m", rows.agg(means).scalar())
    else:
        per_period = rows.groupBy(F.col(period).alias("_period")).agg(means)
        rows = rows.join(per_period, F.col(period).eqNullSafe(F.col("_period")), "left").drop("_period")
    coef = [float(c) for c in model.coefficients.toArray()]
    return rows.withColumn("contributions", F.array(*[
        F.lit(c) * (F.col("_x")[i] - F.col("_m")[i]) for i, c in enumerate(coef)])).drop("_x", "_m")


def attribute(scored: DataFrame, model: PipelineModel, key: str, period: str | None = None) -> DataFrame:
    """``scored`` with one ``contributions`` array per row."""
    last = model.stages[-1]
    if isinstance(last, LogisticRegressionModel):
        return linear_attribution(scored, last, period)
    rules = scored.sparkSession.sparkContext.broadcast(ensemble_rules(last))

    @F.pandas_udf("array<double>")
    def contributions(*inputs: pd.Series) -> pd.Series:
        x = np.column_stack([s.to_numpy(float, na_value=np.nan) for s in inputs])
        return pd.Series(list(leaf_contributions(x, rules.value))) if len(x) else pd.Series([], dtype=object)

    inputs = [F.col(c).cast("double") for c in last.getInputCols()]
    return scored.withColumn("features", F.array(*inputs)).withColumn("contributions", contributions(*inputs))


def with_drivers(attributed: DataFrame, names: Sequence[str], k: int = 3) -> DataFrame:
    """Top-k drivers and the flat columns of the first one."""
    x = F.col("features") if attributed.schema["features"].dataType.typeName() == "array" else vector_to_array("features")
    entries = F.array(*[driver(n, F.get("_x", F.lit(i)), F.get("contributions", F.lit(i)))
                        for i, n in enumerate(names)])
    out = attributed.withColumn("_x", x).withColumn("drivers", top_drivers(entries, k)).drop("_x", "contributions")
    return out.withColumn("top_driver_feature", F.get("drivers", F.lit(0))["feature"]).withColumn(
        "top_driver_direction", F.get("drivers", F.lit(0))["direction"])


def importance(attributed: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature, largest first (one row per task is shuffled)."""
    wide = attributed.agg(*[F.avg(F.abs(F.get("contributions", F.lit(i)))).alias(f"_{i}") for i in range(len(names))])
    items = [F.struct(F.lit(n).alias("feature"), F.col(f"_{i}").alias("mean_abs_contribution"))
             for i, n in enumerate(names)]
    return wide.select(F.explode(F.array(*items)).alias("r")).select("r.*").orderBy(
        F.desc("mean_abs_contribution"), "feature")
