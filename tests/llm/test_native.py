"""Decontamination, mixing, licenses, quality and sharding against plain Python."""

import zlib

import brute
import pytest
from corpus_rows import SF, as_rows, needs_tables, nothing, odd, odd_texts, ordered  # noqa: F401
from pyspark.sql import functions as F

from linegauge.llm import decontaminate, licenses, mixing, quality, queries, sharding, simhash
from linegauge.llm.common import documents, row_key, tokens, words


def benchmark(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id bigint, text string")


def op2_rows(found):
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select("doc_id", "n_words", "n_hit", F.size(items).alias("n"), F.sha2(F.array_join(items, ",").cast("binary"), 256), "contaminated")


def test_words_and_tokens(odd):
    for r in odd.select("text", words(F.col("text")).alias("w"), tokens(F.col("text")).alias("t")).collect():
        assert r.w == brute.words(r.text) and r.t == brute.tokens(r.text)


def test_contamination_of_all_item_lengths(spark, odd, odd_texts):
    prose = odd_texts[0][1]
    texts = [prose, "fox jumps over", "a", "quiet river bank the quick brown", "w1x1 w2x2", None, "", "!!", prose[4:60], "lazy dog " * 9,
             " ".join(f"w{i % 977}x{i % 13}" for i in range(500, 540))]
    got = [tuple(r) for r in op2_rows(decontaminate.contamination(odd, benchmark(spark, texts))).collect()]
    docs = [dict(zip(odd.columns, r)) for r in odd_texts]
    assert ordered(got) == ordered(brute.contamination(docs, [{"item_id": i, "text": t} for i, t in enumerate(texts)]))


@pytest.mark.parametrize("guarantee", decontaminate.GUARANTEES)
def test_every_shared_span_shares_a_fingerprint(spark, guarantee):
    k, w = decontaminate.GUARANTEES[guarantee]
    assert k + w - 1 == guarantee
    line = " ".join(f"u{i * i % 41}" for i in range(300))
    spans = [line.split()[s:s + guarantee] for s in range(300 - guarantee + 1)]
    rows = spark.createDataFrame([(0, line.split()), *((1, ["before", *s, "after"]) for s in spans)], "side int, w array<string>")
    minima = rows.where("side = 0").select(decontaminate.winnow(F.col("w"), k, w).alias("m")).first().m
    kept = {x >> decontaminate.POSITION_BITS for x in minima}
    packed = rows.where("side = 1").select(decontaminate._packed(F.slice("w", 2, guarantee), k).alias("p")).collect()
    assert all(kept & {x >> decontaminate.POSITION_BITS for x in r.p} for r in packed)


def test_texts_are_winnowed_once(spark, capsys):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o"), (2, None), (3, "!!")], "doc_id bigint, text string")
    windows = decontaminate.item_windows(benchmark(spark, ["x a b c d e f g h i j k l m"]))
    places = decontaminate.hit_places(docs, windows)
    places.explain()
    assert capsys.readouterr().out.count("translate(coalesce(text") == 1  # in one node of the plan, no filter before it
    assert {r.doc_key for r in places.collect()} == {docs.select(row_key().alias("k")).first().k}


def test_decontamination_keeps_clean_rows_and_columns(spark, odd, odd_texts, nothing):
    extra = odd.withColumns({"n_words": F.lit("mine"), "doc_key": F.lit(1)})
    items = benchmark(spark, [odd_texts[0][1]])
    clean = decontaminate.decontaminate(extra, items)
    assert clean.columns == extra.columns
    want = [d[0] for d in odd_texts if "brown fox" not in (d[1] or "").lower()]
    assert ordered(r.doc_id for r in clean.collect()) == ordered(want)
    assert decontaminate.contamination(odd, benchmark(spark, [])).where("contaminated").isEmpty()
    assert decontaminate.contamination(nothing, items).isEmpty()


def test_repetitive_texts_are_extended_in_place(spark):
    docs = spark.createDataFrame([(1, "a " * 200_000), (2, "a " * 12), (3, "b " + "a " * 13 + "c"), (4, "a b " * 50_000)], "doc_id bigint, text string")
    items = benchmark(spark, ["a " * 1000, "a b " * 300, "x y z", "b a"])
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (200_000, 200_000, ["0"]), 2: (12, 0, None), 3: (15, 14, ["0", "3"]), 4: (100_000, 100_000, ["1", "3"])}


def test_null_item_ids_and_clashing_names(spark, odd, odd_texts):
    prose = odd_texts[0][1]
    items = spark.createDataFrame([(None, prose), (3, prose)], "item_id bigint, text string")
    found = decontaminate.contamination(odd, items).where("doc_id = 1").first()
    assert found["items"] == ["", "3"]
    named = odd.withColumns({c: F.lit("mine") for c in ("_bad_key", "_dropped", "_again", "_weights", "_m", "_cdf", "score", "copy", "kept", "row", "places")})
    assert decontaminate.decontaminate(named, items).columns == named.columns
    assert simhash.deduplicate(named).columns == named.columns
    judged = quality.quality(named, spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int"))
    row = judged.first()
    assert (row["_weights"], row["_m"], row["copy"]) == ("mine",) * 3 and isinstance(row["score"], float) and isinstance(row["kept"], bool)
    mixed = mixing.mix(named)
    assert mixed.first()["copy_in"] == "mine" and mixed.first()["_cdf"] == "mine"
    assert sharding.sized_records(named).count() == licenses.scan(named).count() == len(odd_texts)


def test_the_mix_has_one_order(spark, odd):
    rows = []
    for parts in ("3", "11"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        rows.append([(r.doc_id, r.text, r["copy"]) for r in mixing.mix(odd.repartition(int(parts))).collect()])
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows[0] == rows[1] and len(rows[0]) > 5


def test_mixing_counts_and_columns(odd, odd_texts, nothing):
    docs = [dict(zip(odd.columns, r)) for r in odd_texts]
    want = {}
    for d, n in zip(docs, brute.mix_counts(docs, mixing.SEED, mixing.FLATTEN)):
        want[repr((d["doc_id"], d["text"]))] = want.get(repr((d["doc_id"], d["text"])), 0) + n
    got = {}
    mixed = mixing.mix(odd.withColumn("_cdf", F.lit("mine")))
    for r in mixed.collect():
        got[repr((r.doc_id, r.text))] = got.get(repr((r.doc_id, r.text)), 0) + 1
    assert got == {k: v for k, v in want.items() if v}
    assert mixed.columns == [*odd.columns, "_cdf", "copy"]
    assert mixing.mix(nothing).isEmpty()


def test_mixing_meets_target_weights(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('z', 10) AS text", "'en' AS lang",
                                          "if(id % 10 < 7, 'big', 'small') AS source", "10L AS n_chars")
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0)], "source string, weight double")
    sizes = {r["source"]: r["count"] for r in mixing.mix(docs, weights=weights).groupBy("source").count().collect()}
    assert abs(sizes["big"] - 10_000) < 400 and abs(sizes["small"] - 10_000) < 400
    only = mixing.mix(docs, weights=weights.where("source = 'small'"))
    assert {r.source for r in only.select("source").distinct().collect()} == {"small"}


def test_poisson_distribution_function(spark):
    for rate in (0.01, 1.0, 12.5, 900.0):
        got = spark.range(1).select(mixing.cdf(F.lit(rate)).alias("c")).first().c
        mean = sum(1 - x for x in got)
        assert got == sorted(got) and abs(got[-1] - 1) < 1e-9 and abs(mean - rate) < 1e-6 * max(1, rate)


def test_licenses(spark, odd, odd_texts, nothing):
    extra = ["Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.", "MIT LICENSE mit license, cc, by",
             "GNU general\npublic license", "gnu general public licenses", "the of the terms of the software", " ".join(licenses.NOTICES),
             "Redistribution and use in source, and now in binary forms, with or without modification are permitted"]
    rows = [*odd_texts, *((100 + i, t, "en", "s", None) for i, t in enumerate(extra))]
    docs = spark.createDataFrame(rows, odd.schema).withColumn("labels", F.lit("mine"))
    want = []
    for r in rows:
        places = {p: brute.phrase_places(r[1], p) for p in licenses.PHRASES}
        every = sorted(x for p in places.values() for x in p)
        base = {licenses.PHRASES[p] for p, x in places.items() if x}
        cover = {n: brute.notice_cover(r[1], n, licenses.SLACK) for n in licenses.NOTICES}
        added = {licenses.NOTICES[n] for n, c in cover.items() if c >= licenses.COVER}
        want.append((r[0], len(brute.words(r[1])), len(every), every[0] if every else None, every[-1] if every else None,
                     ",".join(sorted(base)), ",".join(sorted(base | added)), max([*cover.values(), float(bool(every))])))
    assert ordered(tuple(r) for r in licenses.scan(docs).collect()) == ordered(want)
    assert licenses.scan(nothing).isEmpty()


def test_quality_rules(spark, odd, odd_texts, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (13, 1, 0), (12, 0, 0), (None, 1, 0), (8, None, 0), (3, 1, 1)], "doc_id bigint, quality int, toxic int")
    docs = [dict(zip(odd.columns, r)) for r in odd_texts]
    scores = brute.quality_scores(docs, {1, 13}, quality.BUCKETS, quality.PRIOR)
    want = []
    for d, s in zip(docs, scores):
        stats = brute.quality_stats(d["text"])
        want.append((d["doc_id"], *stats, not stats[-1] and s >= quality.THRESHOLD, round(s, 9) + 0.0))
    got = quality.quality(odd.withColumn("score", F.lit("mine")), labels)
    got = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                     F.round("score", 9) + 0.0)
    assert ordered(tuple(r) for r in got.collect()) == ordered(want)
    assert quality.quality(nothing, labels).isEmpty()
    unlabelled = quality.quality(odd, labels.limit(0))
    assert unlabelled.where("score <> 0").isEmpty() and unlabelled.where("kept = base_failed").isEmpty()


def test_trusted_sample_is_the_lowest_hashes(spark):
    labels = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 5 = 0, 0, 1) AS quality", "0 AS toxic")
    want = sorted((brute.spark_hash(i), i) for i in range(5000) if i % 5)
    for limit in (100, 900, 10_000):
        got = {r.doc_id for r in quality.trusted_ids(labels, limit).collect()}
        assert got == {i for _, i in want[:limit]}


@needs_tables
def test_quality_keeps_good_and_rejects_bad_documents(spark):
    got = queries.QUERIES["op6_quality"](spark, SF).join(documents(spark, SF, "labels"), "doc_id")
    rates = {r["quality"]: r["rate"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert rates[1] > 0.9 and rates[0] < 0.3


def test_sharding(odd, odd_texts, nothing, tmp_path):
    got = as_rows(sharding.shard_documents(odd.withColumn("size", F.lit("mine")), 3, str(tmp_path / "map"), 64))
    docs = [dict(zip(odd.columns, r)) for r in odd_texts]
    to = brute.shard_map(docs, 3, 64)
    want = []
    for d in docs:
        raw, slot = (d["text"] or "").encode(), brute.virtual_slot(d["doc_id"], d["text"], 64)
        want.append((d["doc_id"], len(raw) + 8, zlib.crc32(raw), "bytes", to[slot], slot))
    assert ordered((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["virtual_slot"]) for r in got) == ordered(want)
    for shard in range(3):
        places = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert places == list(range(len(places)))
    assert sharding.shard_documents(nothing, 3, str(tmp_path / "empty"), 64).isEmpty()


def test_the_stored_map_is_edited(spark, odd, tmp_path):
    path = str(tmp_path / "map")
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat(if(id % 4 = 0, 'é', 'e'), CAST(id % 50 AS INT)) AS text")
    sharding.plan_by_chars(docs, 4, path)
    first = {(r.virtual_slot, r.shard) for r in sharding.read_map(spark, path).collect()}
    got = as_rows(sharding.shard_documents(docs, 4, path))
    versions = spark.read.parquet(path)
    assert {r.version for r in versions.select("version").distinct().collect()} == {1, 2}
    second = {(r.virtual_slot, r.shard) for r in sharding.read_map(spark, path).collect()}
    assert len(second - first) < len(second) / 4
    assert {(r["virtual_slot"], r["shard"]) for r in got} <= second
    loads = [sum(r["size"] for r in got if r["shard"] == s) for s in range(4)]
    assert max(loads) < 1.004 * sum(loads) / 4
    assert sharding.read_map(spark, str(tmp_path / "none")) is None


def test_records_of_one_id_are_numbered_in_parts(spark, tmp_path):
    docs = spark.range(0, 2000, 1, 9).selectExpr("if(id % 3 = 0, 7L, id) AS doc_id", "if(id % 3 = 0, 'same', CAST(id AS STRING)) AS text")
    got = sharding.shard_documents(docs, 3, str(tmp_path / "map"), 16).collect()
    for shard in range(3):
        places = sorted(r.slot for r in got if r.shard == shard)
        assert places == list(range(len(places)))
    assert len({r.shard for r in got if r.doc_id == 7}) == 1


def test_rebalancing_moves_little_and_balances(spark, tmp_path):
    slots = spark.range(1024).selectExpr("CAST(id AS INT) AS virtual_slot", "1000 + (id * 7919) % 997 AS bytes")
    first = sharding.write_map(sharding.first_map(slots, 8), str(tmp_path / "map")).cache()
    second = sharding.write_map(sharding.rebalance(first, slots, 9), str(tmp_path / "map"))
    assert {r.version for r in second.collect()} == {2}
    both = first.alias("a").join(second.alias("b"), "virtual_slot")
    assert both.where("a.shard <> b.shard").count() < 1024 / 9 * 1.5
    loads = [r.b for r in second.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()]
    assert len(loads) == 9 and max(loads) < 1.02 * sum(loads) / 9
    assert spark.read.parquet(str(tmp_path / "map")).select("version").distinct().count() == 2


def test_native_operators_run_no_python(spark, odd, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    frames = [decontaminate.contamination(odd, benchmark(spark, ["the quick brown fox"])), mixing.mix(odd), licenses.scan(odd),
              quality.quality(odd, labels), sharding.shard_documents(odd, 3, str(tmp_path / "map"), 64)]
    for df in frames:
        plan = df._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_long_license_texts_are_templates(spark):
    body = " ".join(f"term{i}" for i in range(150))
    words = body.split()
    torn = " ".join(w for i, w in enumerate(words) if i not in (40, 100))
    docs = spark.createDataFrame([(1, "so " + body), (2, torn), (3, " ".join(words[:70])), (4, " ".join(words[:129]))], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, {body: "phrase"}, {body: "notice"}).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].labels, got[1].score) == (1, 1, "notice,phrase", 1.0)
    assert [(got[i].n_base, got[i].labels) for i in (2, 3, 4)] == [(0, "notice"), (0, ""), (0, "notice")]
    assert [round(got[i].score * 149) for i in (2, 3, 4)] == [145, 69, 128]
