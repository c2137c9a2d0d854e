"""SimHash near-duplicates through an inverted index over byte positions with count filtering.

A fingerprint is eight bytes at fixed positions. Two fingerprints that differ in at most 3 bits agree
in at least 5 of the 8, so they share at least C(5, 4) = 5 of the C(8, 4) = 70 sets of four positional
bytes. Every distinct fingerprint is posted under its 70 sets; the shared sets of each pair inside a
posting are tallied, pairs below 5 are dropped, and the bits of the others are compared.

Equal fingerprints are one node, whatever their number of documents. A posting of more than
``MAX_POSTING`` distinct fingerprints is not paired up: each member is posted again under its value
with every 3 of the 32 bits outside the set left out. Linked members meet there, and such a list has at most 8
members, so the work stays in proportion to the posting: C(32, 3) = 4,960 rows a member, against half
the posting's size in pairs, so this way starts where pairing up would cost a tenth of it at least and
grows no further. No link is lost either way.

Null and empty texts have fingerprint zero and link like any other. A null id never names a
component unless all its members lack ids. Repeated rows share fingerprint and component, an empty
table gives an empty result, extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from linegauge.llm.common import fresh, short_row_key, stored

SHINGLE = 3
MAX_BITS = 3
SEED = 42
N_BYTES = 8
SET_BYTES = 4
#: Sets of positions two linked fingerprints share at least.
MIN_TALLY = comb(N_BYTES - MAX_BITS, SET_BYTES)
MAX_POSTING = 1024
BLOCK = 1 << 16
EDGES_PER_TASK = 200_000


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """64-bit SimHash of a text: a bit is set if over half of its shingles' hashes have it."""
    import xxhash

    hashed, words = xxhash.xxh64_intdigest, text.lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    shingles = (hashed(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(size))))
    total, ones = len(words) - size + 1, np.zeros(64, np.int64)
    while (block := np.fromiter(islice(shingles, BLOCK), np.uint64)).size:
        ones += np.unpackbits(block.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total).view(">i8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, row_key and fingerprint (as a signed number) of every row."""
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = pa.array([fingerprint(t.as_py() or b"", size) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), found], ["doc_id", "row_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint"), short_row_key().alias("row_key"), "text")
    return rows.mapInArrow(prints, "doc_id bigint, row_key bigint, fp bigint")


def _byte(position: int) -> Column:
    return F.shiftright(F.col("fp"), 8 * position).bitwiseAND(F.lit(255))


def postings(prints: DataFrame) -> DataFrame:
    """fp, the number of its set of positions, key and members n of all postings with two members or more."""
    def key(n: int, chosen: tuple[int, ...]) -> Column:
        out = F.lit(n).cast("bigint")
        for p in chosen:
            out = F.shiftleft(out, 8).bitwiseOR(_byte(p))
        return out

    keys = [key(n, chosen) for n, chosen in enumerate(combinations(range(N_BYTES), SET_BYTES))]
    index = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    # a join with counted sizes would shuffle the index twice: 4.2 times the input instead of 0.4
    counted = index.withColumn("n", F.count("*").over(W.partitionBy("key"))).where("n > 1")
    return counted.withColumn("set", F.shiftright("key", 8 * SET_BYTES).cast("int"))


def close(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS


def tallied_pairs(posted: DataFrame) -> DataFrame:
    """Linked pairs a < b from the postings that are paired up."""
    left = posted.select("key", F.col("fp").alias("a"))
    pairs = left.join(posted.select("key", F.col("fp").alias("b")), "key").where("a < b")
    return (pairs.groupBy("a", "b").agg(F.count("*").alias("tally")).where(F.col("tally") >= MIN_TALLY)
            .where(close(F.col("a"), F.col("b"))).select("a", "b"))


def masked_pairs(posted: DataFrame) -> DataFrame:
    """Linked pairs a < b inside large postings, by leaving out every 3 of a member's 32 free bits."""
    free = F.array(*[F.array(*[F.lit(8 * p + i) for p in range(N_BYTES) if p not in chosen for i in range(8)])
                     for chosen in combinations(range(N_BYTES), SET_BYTES)])
    rows = posted.select("fp", F.get(free, F.col("set")).alias("free"))
    for name, over in (("x", "free"), ("y", "filter(free, i -> i > x)"), ("z", "filter(free, i -> i > y)")):
        rows = rows.withColumn(name, F.explode(F.expr(over)))
    rows = rows.select("fp", F.expr("shiftleft(1L, x) | shiftleft(1L, y) | shiftleft(1L, z)").alias("mask")).distinct()
    rows = rows.withColumn("core", F.expr("fp & ~mask"))
    meets = rows.groupBy("mask", "core").agg(F.sort_array(F.collect_list("fp")).alias("members")).where("size(members) > 1")
    return meets.select(F.expr("members[0]").alias("a"), F.explode(F.expr("slice(members, 2, 7)")).alias("b")).distinct()


def links(prints: DataFrame, max_posting: int = MAX_POSTING) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that connect what is linked.

    From postings of up to ``max_posting`` members come all links; from larger ones enough true
    links to connect their members.
    """
    posted = stored(postings(prints), "postings")
    small = tallied_pairs(posted.where(F.col("n") <= max_posting))
    large = posted.where(F.col("n") > max_posting)
    return small if large.isEmpty() else small.unionByName(masked_pairs(large)).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) with the smallest node of the component, for all nodes of ``pairs`` (a, b).

    Alternates large and small stars: neighbours above a node are handed to its smallest neighbour,
    then those below it, until nothing changes. Each round is stored, so no lineage builds up, in
    as many files as the number of edges asks for.
    """
    edges = stored(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    tasks = 1 + edges.count() // EDGES_PER_TASK
    keep = lambda df, name: stored(df.coalesce(tasks), name)

    def stars(of: DataFrame, name: str) -> DataFrame:
        """Edges (u, v) with the smallest neighbour of u."""
        return of.join(keep(of.groupBy("u").agg(F.min("v").alias("low")), f"{name}-low"), "u")

    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stars(both, "large").where("v > u").select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
        large = keep(large.distinct(), "large-stars")
        small = stars(large, "small")
        moved = small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = keep(moved.unionByName(small.select("u", F.col("low").alias("v"))).distinct(), "small-stars")
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def classes(docs: DataFrame, max_posting: int = MAX_POSTING) -> DataFrame:
    """doc_id, row_key, fp, root (a fingerprint of the component) and component_id of every row."""
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = components(links(nodes.select("fp"), max_posting))
    known = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    known = stored(known, "roots")
    firsts = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = stored(known.join(firsts, "root").select("fp", "root", "component_id"), "components")
    return rows.join(of_print, "fp")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of every component, that with the smallest id (then row key); columns unchanged."""
    rows = stored(classes(docs).select("doc_id", "row_key", "root"), "classes")
    order = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row_key")
    best = rows.groupBy("root").agg(F.min(order)["row_key"].alias("best"), F.count("*").alias("members")).where("members > 1")
    judged = rows.join(stored(best, "kept-rows"), "root").select("row_key", (F.col("row_key") == F.col("best")).alias("kept"))
    gone, twice = fresh("dropped"), fresh("again")
    dropped = stored(judged.where("NOT kept").select(F.col("row_key").alias(gone)).distinct(), "dropped-rows")
    again = stored(judged.where("kept").groupBy(F.col("row_key").alias(twice)).count().where("count > 1").select(twice), "repeated-rows")
    out = docs.join(dropped, short_row_key() == F.col(gone), "left_anti")
    if again.isEmpty():
        return out
    once = out.join(again, short_row_key() == F.col(twice), "left_anti")
    return once.unionByName(out.join(again, short_row_key() == F.col(twice)).dropDuplicates([twice]).drop(twice))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    return classes(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
