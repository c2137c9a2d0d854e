"""Quality rules: plain text statistics, and a hashed n-gram likelihood ratio against trusted text.

Words and word pairs are hashed into ``BUCKETS`` buckets. The raw multinomial counts all documents,
the target multinomial counts trusted ones; a document's score is the mean over its n-grams of
log(smoothed target share / raw share), and every document is kept or rejected by one fixed threshold.

Null and empty texts have no words and are rejected by the word count. Without trusted documents all
scores are 0, so only the plain rules decide. Repeated rows and ties are judged alike, the table may
be empty, extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.llm.common import fresh, gram_hashes, hashes, let, stored, tokens

BUCKETS = 1 << 17
#: Prior of the target multinomial: it expects the raw shares, with this many n-grams in every bucket.
#: Rare n-grams stay near a ratio of 1, frequent ones that trusted text lacks cost much.
PRIOR = 4.0
#: Trusted documents counted for the target, chosen by the smallest hash of their id.
TRUSTED_DOCUMENTS = 20_000
#: Mean log ratio per n-gram below which a document is rejected.
THRESHOLD = -0.2
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_DOCUMENTS) -> DataFrame:
    """Ids of at most ``limit`` documents labelled good; the sample is the same on every run.

    Only ids in the lowest few shares of the hash's range are sorted, so a task sends no more than
    its part of the sample, however many labels there are.
    """
    good = labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    share = min(1.0, 4 * limit / max(1, good.count()))
    lowest = good.where(F.xxhash64("doc_id") <= F.lit(int(-(1 << 63) + share * ((1 << 64) - 1024)))) if share < 1 else good
    return lowest.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def features(hashed: Column) -> Column:
    """Buckets of all words and of all pairs of neighbours (the last word's neighbour is the end)."""
    bucket = lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")
    return F.concat(F.transform(hashed, bucket), F.transform(hashed, lambda h, i: bucket(F.xxhash64(h, F.get(hashed, i + 1)))))


def bucket_weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """log(target share / raw share) of every bucket seen in ``docs``; at most ``BUCKETS`` rows."""
    trusted = stored(trusted.select("doc_id"), "trusted")
    marked = docs.select("doc_id", "text").join(F.broadcast(trusted.select("doc_id", F.lit(1).alias("is_target"))), "doc_id", "left")
    grams = marked.select("is_target", let(hashes(tokens(F.col("text"))), features).alias("buckets"))
    grams = grams.select("is_target", F.explode("buckets").alias("bucket"))
    counts = stored(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("is_target").alias("target")), "bucket-counts")
    expected = F.col("raw") * F.try_divide(counts.agg(F.sum("target")).scalar(), counts.agg(F.sum("raw")).scalar())
    return counts.select("bucket", F.log((F.col("target") + PRIOR) / (expected + PRIOR)).alias("weight"))


def weight_list(weights: DataFrame) -> Column:
    """Weights by bucket as one array of ``BUCKETS`` numbers, read by a scalar subquery."""
    every = weights.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(weights, "bucket", "left").select("bucket", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    listed = F.array_sort(F.collect_list(F.struct("bucket", "weight")))
    return stored(full.agg(F.transform(listed, lambda x: x["weight"]).alias("weights")), "weights").scalar()


def repeated_words(hashed: Column) -> Column:
    """Words inside windows of ``REPEAT_WINDOW`` words that occur twice or more in the text."""
    def covered(grams: Column) -> Column:
        def of_sorted(pairs: Column) -> Column:
            again = F.filter(pairs, lambda p, i: (p["h"] == F.get(pairs, i - 1)["h"]) | (p["h"] == F.get(pairs, i + 1)["h"]))
            start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to"))
            return F.aggregate(F.sort_array(F.transform(again, lambda p: p["i"])), start, lambda a, at: F.struct(
                (a["n"] + at + REPEAT_WINDOW - F.greatest(at, a["to"])).cast("bigint").alias("n"),
                (at + REPEAT_WINDOW).alias("to")), lambda a: a["n"])
        ranked = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(grams)) < F.size(grams), let(ranked, of_sorted)).otherwise(F.lit(0).cast("bigint"))

    return let(gram_hashes(hashed, REPEAT_WINDOW), covered)


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def judge(docs: DataFrame, weights: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the statistics, ``score``, ``base_failed`` and ``kept``; columns of these names are replaced, all others kept."""
    # subqueries may not stand inside higher-order functions; the optimizer folds this column into them
    listed, found = fresh("weights"), fresh("measured")
    table = F.col(listed)
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = hashes(tokens(text))

    def measured(w: Column) -> Column:
        total = let(features(w), lambda b: F.struct(F.size(b).alias("n"), F.aggregate(
            b, F.lit(0.0), lambda a, k: a + F.get(table, k)).alias("sum")))
        return F.struct(F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words"),
                        let(total, lambda t: F.coalesce(F.try_divide(t["sum"], t["n"]), F.lit(0.0))).alias("score"))

    def judged(m: Column) -> Column:
        failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
        return F.struct(m["n_words"].alias("n_words"), m["n_repeat_words"].alias("n_repeat_words"), m["score"].alias("score"),
                        failed.alias("base_failed"), (~failed & (m["score"] >= threshold)).alias("kept"))

    # everything that is read from a text's words stands in one struct: a filter on the verdict takes one pass over them
    return docs.withColumn(listed, weight_list(weights)).withColumn(found, let(let(hashed, measured), judged)).withColumns({
        "n_words": F.col(f"{found}.n_words"),
        "word_chars": (F.char_length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("bigint"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint"),
        "n_dup_lines": duplicate_lines(text),
        **{c: F.col(f"{found}.{c}") for c in ("n_repeat_words", "score", "base_failed", "kept")},
    }).drop(found, listed)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return judge(docs, bucket_weights(docs, trusted_ids(labels)), threshold)
