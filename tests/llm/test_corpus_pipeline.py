"""The whole pipeline against plain Python, and the registered queries against their SQL."""

import sys
import zlib
from pathlib import Path

import brute
import corpus_pipeline
import pytest
from corpus_rows import SF, needs_tables, nothing, odd, odd_texts, ordered  # noqa: F401
from pyspark.sql import functions as F

from linegauge.llm import mixing, quality, queries, sharding
from linegauge.llm.common import documents

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from parity import compare, connect  # noqa: E402

pytestmark = needs_tables


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    cur = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert compare(df.columns, [tuple(r) for r in df.collect()], columns, cur.fetchall()) is None


def test_pipeline_equals_plain_python(spark):
    rows = [r.asDict() for r in documents(spark, SF).collect()]
    bench = [r.asDict() for r in documents(spark, SF, "benchmark").collect()]
    trusted = {r.doc_id for r in quality.trusted_ids(documents(spark, SF, "labels")).collect()}
    scores = brute.quality_scores(rows, trusted, quality.BUCKETS, quality.PRIOR)
    docs = [d for d, s in zip(rows, scores) if not brute.quality_stats(d["text"])[-1] and s >= quality.THRESHOLD]
    classes = brute.components([brute.simhash(d["text"]) for d in docs], [d["doc_id"] for d in docs])
    docs = [d for d, c in zip(docs, classes) if d["doc_id"] == c]
    dirty = {r[0] for r in brute.contamination(docs, bench) if r[-1]}
    docs = [d for d in docs if d["doc_id"] not in dirty]
    docs = [d for d, n in zip(docs, brute.mix_counts(docs, mixing.SEED, mixing.FLATTEN)) for _ in range(n)]
    to = brute.shard_map(docs, corpus_pipeline.SHARDS, sharding.N_SLOTS)
    want = []
    for d in docs:
        raw, slot = d["text"].encode(), brute.virtual_slot(d["doc_id"], d["text"], sharding.N_SLOTS)
        want.append((d["doc_id"], len(raw) + 8, zlib.crc32(raw), to[slot], slot))
    got = corpus_pipeline.run(spark, SF)
    assert ordered(tuple(r) for r in got.select("doc_id", "size", "text_crc32", "shard", "virtual_slot").collect()) == ordered(want)


def test_stages_take_odd_rows_and_keep_columns(spark, odd, nothing):
    for rows in (odd, nothing):
        docs = rows.withColumn("kept", F.lit("mine"))
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, SF)
            if n < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == corpus_pipeline.COLUMNS
        # rows with too few or repeated words go, of the copies one stays; a draw may leave out any of the rest
        assert {r.doc_id for r in docs.collect()} <= (set() if rows.isEmpty() else {1, 3})
