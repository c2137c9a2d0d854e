"""Centroid clustering of vectors with scalar lookup tables.

Components are whole numbers. In every round, a task tabulates, for each dimension, the squared
difference between every value that occurs there and every centroid; a vector's distances are then
gathers from these tables and their sum, without a product per vector. Tables cover the values of one
Arrow batch, so they stay small whatever the range of the data. Only the centroids (k x dimensions
numbers) travel to the tasks; a task sends back one row of sums per centroid.

Vectors with another number of components, or with a null or non-finite one, are left out, as is a
null vector. Components beyond +-2^27 after scaling are set to that bound, so that distances fit into
64 bits; sums of distances stop at the largest 64-bit number. A null id counts as the empty text in
the choice of the first centroids; equal ids are ordered by their vectors, and repeated rows may both
become centroids. Equal distances go to the smaller number; a centroid without vectors stays. With
fewer vectors than k, all of them are centroids. An empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.llm.common import stored

CLUSTERS = 40
DIMENSIONS = 64
ROUNDS = 5
SCALE = 256
SEED = 2
#: Largest component: squared differences of 64 such components add up to 2^62.
LARGEST = 1 << 27
LARGEST_SUM = (1 << 63) - 1
#: Vectors whose distances are summed at once, so that the sums stay in the processor's cache.
BLOCK = 1024


def whole_vectors(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", dimensions: int = DIMENSIONS) -> DataFrame:
    """key and q, the scaled components rounded down, of the vectors that are kept."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * SCALE, F.lit(-float(LARGEST))),
                                                          F.lit(float(LARGEST)))).cast("int"))
    kept = F.col(vector).isNotNull() & (F.size(vector) == dimensions) & finite
    return rows.where(kept).select(F.col(key).cast("bigint").alias(key), whole.alias("q"))


def first_centroids(vectors: DataFrame, key: str = "vec_id", clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, in the order of these hashes."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    chosen = vectors.select(F.sha2(text.cast("binary"), 256).alias("hash"), "q").orderBy("hash", "q").limit(clusters)
    return np.array([r.q for r in chosen.collect()], np.int64)


def tables_of(values: np.ndarray, centroids: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per dimension, the squared differences of every occurring value (row) to every centroid, and each vector's row."""
    tables, rows = [], []
    for d in range(values.shape[1]):
        occurring, row = np.unique(values[:, d], return_inverse=True)
        tables.append((occurring[:, None].astype(np.int64) - centroids[:, d]) ** 2)
        rows.append(row)
    if sum(int(t.max()) for t in tables) < 1 << 31:  # then every sum fits as well
        tables = [t.astype(np.int32) for t in tables]
    return tables, rows


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of every vector's nearest centroid, by table gathers and sums."""
    tables, rows = tables_of(values, centroids)
    number, distance = np.empty(len(values), np.int32), np.empty(len(values), np.int64)
    for at in range(0, len(values), BLOCK):
        part = slice(at, at + BLOCK)
        total = tables[0][rows[0][part]]
        for table, row in zip(tables[1:], rows[1:]):
            total += table[row[part]]
        number[part] = best = total.argmin(axis=1)
        distance[part] = np.take_along_axis(total, best[:, None], axis=1)[:, 0]
    return number, distance


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def cluster_sums(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task, the number and the component sums of the vectors nearest to each centroid."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch, centroids.shape[1])
            number, _ = nearest(values, centroids)
            order = np.argsort(number, kind="stable")
            met, starts = np.unique(number[order], return_index=True)
            sums[met] += np.add.reduceat(values[order].astype(np.int64), starts, axis=0)
            count += np.bincount(number, minlength=len(centroids))
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(count[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))],
                                         ["cluster", "n", "sums"])

    return add


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the rounded-down means of their vectors; those without any stay."""
    dimensions = centroids.shape[1]
    sums = vectors.select("q").mapInArrow(cluster_sums(centroids), "cluster int, n bigint, sums array<bigint>")
    total = sums.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(d))) for d in range(dimensions)]).alias("sums"))
    out = centroids.copy()
    for r in total.collect():  # at most one row per centroid
        out[r.cluster] = [s // r.n for s in r.sums]
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray, key: str = "vec_id") -> DataFrame:
    """key, cluster and distance of every vector."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, distance = nearest(_matrix(batch, centroids.shape[1]), centroids)
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(number), pa.array(distance)], [key, "cluster", "distance"])

    return vectors.select(key, "q").mapInArrow(assign, f"{key} bigint, cluster int, distance bigint")


def _total(distance: Column) -> Column:
    return F.least(F.sum(distance.cast("decimal(38,0)")), F.lit(LARGEST_SUM).cast("decimal(38,0)")).cast("bigint")


def cluster(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", clusters: int = CLUSTERS, dimensions: int = DIMENSIONS,
            rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """Per kept vector key, cluster, distance, cluster_inertia and inertia; and the final centroids."""
    vectors = stored(whole_vectors(rows, vector, key, dimensions), "whole-vectors")
    centroids = first_centroids(vectors, key, clusters, seed)
    if not len(centroids):
        nothing = vectors.select(key, F.lit(0).alias("cluster"), *[F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")])
        return nothing, centroids.reshape(0, dimensions)
    centroids = reduce(lambda c, _: moved(vectors, c), range(rounds), centroids)
    last = stored(assigned(vectors, centroids, key), "assigned-vectors")
    by_cluster = last.groupBy("cluster").agg(_total(F.col("distance")).alias("cluster_inertia"))
    inertia = last.agg(_total(F.col("distance"))).first()[0]
    of_cluster = F.broadcast(by_cluster)  # at most one row per centroid
    out = last.join(of_cluster, "cluster").withColumn("inertia", F.lit(inertia).cast("bigint"))
    return out.select(key, "cluster", "distance", "cluster_inertia", "inertia"), centroids


def with_centroid_digests(result: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds centroid_sha256, the digest of the comma-joined components of each row's centroid."""
    if not len(centroids):
        return result.withColumn("centroid_sha256", F.lit(""))
    texts = F.array(*[F.lit(",".join(map(str, c))) for c in centroids.tolist()])
    return result.withColumn("centroid_sha256", F.sha2(F.get(texts, F.col("cluster")).cast("binary"), 256))
