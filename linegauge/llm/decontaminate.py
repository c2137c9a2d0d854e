"""Benchmark decontamination by winnowing.

A text's fingerprints are the smallest hash of its k-word runs in every window of w runs, so two
texts that share k + w - 1 words in a row always share a fingerprint. Documents keep these minima
(with their positions), benchmark items the set of all their k-word hashes; documents keep the places
of the fingerprints that a benchmark item has too. A hit is extended both ways to all windows that
hold its place, and each of these is joined with the items' windows by its words, so shared words are
known exactly. Places and windows are joined with distinct hashes and texts, never with one another: a
text that repeats a word any number of times costs a row per place.

An item of 13 words and more is searched by windows of 13 words; a shorter one is a single window
and uses the parameters that guarantee its length. Only lengths that occur cost anything.

Null and empty texts have no words and no hits, items without words never occur, a null item id is
named by the empty text, repeated rows get equal results, an empty benchmark leaves every document
clean, extra columns are not read and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.llm.common import fresh, gram_hashes, hashes, let, row_key, stored, words

WINDOW = 13
#: Guaranteed length of a shared run: (words in a hashed run, runs in a window).
GUARANTEES = {13: (7, 7), 7: (4, 4), 4: (2, 3), 1: (1, 1)}
#: A packed fingerprint has 34 bits of hash above 30 bits of position, enough for any text Spark holds.
#: Chance hits cost a comparison of words and no more.
POSITION_BITS = 30
#: Contaminated: hit words are at least one in this many.
SHARE = 20


def _short(hashed: Column) -> Column:
    return F.shiftright(hashed, POSITION_BITS)


def _packed(items: Column, k: int) -> Column:
    """Hash and position of every k-word run as one number that sorts by hash."""
    place = lambda h, i: F.shiftleft(_short(h), POSITION_BITS).bitwiseOR(i.cast("bigint"))
    return F.transform(gram_hashes(hashes(items), k), place)


def winnow(items: Column, k: int, w: int) -> Column:
    """Distinct packed minima of all windows of w runs.

    Minima of 1, 2, 4, ... runs are combined, so the cost grows with the logarithm of w. Windows cut
    short by the end of the text count too, so texts of fewer than w runs need no case of their own.
    """
    def widen(minima: Column, have: int) -> Column:
        if have == w:
            return F.array_distinct(minima)
        step = min(have, w - have)
        return let(minima, lambda m: widen(F.transform(m, lambda x, i: F.least(x, F.get(m, i + step))), have + step))

    return widen(_packed(items, k), 1)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item (its id as text), words of the window as one text, size of the window and guarantee, of all windows of all items."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words")).where(F.size("words") > 0)
    n = F.size("words")
    longest = F.coalesce(*[F.when(n >= g, F.lit(g)) for g in GUARANTEES])
    sized = items.select("item", "words", F.least(n, F.lit(WINDOW)).alias("size"), longest.alias("guarantee"))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)
    return sized.select("item", "size", "guarantee", F.explode(starts).alias("at"), "words").select(
        "item", "size", "guarantee", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("window")).distinct()


def hit_places(docs: DataFrame, windows: DataFrame) -> DataFrame | None:
    """(doc_key, guarantee, at): places of document fingerprints that items have, None without items."""
    found = None
    for guarantee in [r[0] for r in windows.select("guarantee").distinct().collect()]:
        k, w = GUARANTEES[guarantee]
        grams = windows.where(F.col("guarantee") == guarantee).select(F.explode(gram_hashes(hashes(F.split("window", " ")), k)).alias("gram"))
        grams = stored(grams.select(_short(F.col("gram")).alias("hash")).distinct(), "item-grams")
        prints = docs.select(row_key().alias("doc_key"), winnow(words(F.col("text")), k, w).alias("minima"))
        # explode() would let Spark first filter by the array's size, below the projection, and so winnow every text twice;
        # the null of a text without words matches nothing
        prints = prints.select("doc_key", F.explode_outer("minima").alias("packed"))
        place = F.col("packed").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
        hits = (prints.withColumn("hash", F.shiftright("packed", POSITION_BITS)).join(grams, "hash", "left_semi")
                .select("doc_key", F.lit(guarantee).alias("guarantee"), place.cast("int").alias("at")))
        found = hits if found is None else found.unionByName(hits)
    return found


def extended(docs: DataFrame, windows: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_key, start, size, window): all stretches of documents with a hit that may be an item's window.

    A document's places are numbers and fewer than its words. Each is extended to the windows that hold it.
    """
    sizes = [(r["size"], r["guarantee"]) for r in windows.select("size", "guarantee").distinct().collect()]  # at most WINDOW
    of_doc = stored(places.groupBy("doc_key").agg(F.collect_set(F.struct("guarantee", "at")).alias("places")), "hit-places")
    texts = (docs.select(row_key().alias("doc_key"), "text").join(of_doc.select("doc_key"), "doc_key", "left_semi").dropDuplicates(["doc_key"]))

    def stretches(w: Column) -> Column:
        each = []
        for size, guarantee in sizes:
            reach = size - GUARANTEES[guarantee][0]
            at = F.transform(F.filter("places", lambda p: p["guarantee"] == guarantee), lambda p: p["at"])
            starts = F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(p - reach, p))))
            inside = F.filter(starts, lambda s: (s >= 0) & (s + size <= F.size(w)))
            each.append(F.transform(inside, lambda s: F.struct(s.alias("start"), F.lit(size).alias("size"),
                                                               F.array_join(F.slice(w, s + 1, size), " ").alias("window"))))
        return F.concat(*each)

    # the windows are cut out before they become rows: a row with all words of a text would be copied for each
    return texts.join(of_doc, "doc_key").select("doc_key", F.inline(let(words(F.col("text")), stretches)))


def occurrences(docs: DataFrame, windows: DataFrame, places: DataFrame) -> DataFrame:
    """doc_key, number of hit words and items that occur, for documents with a true occurrence."""
    spans = extended(docs, windows, stored(places, "places"))
    known = stored(windows.groupBy("size", "window").agg(F.collect_set("item").alias("items")), "known-windows")
    true = stored(spans.join(known.select("size", "window"), ["size", "window"], "left_semi"), "occurrences")
    ends = F.struct(F.col("start").alias("start"), (F.col("start") + F.col("size")).alias("end"))
    covered = F.aggregate(F.array_sort(F.collect_list(ends)), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to")),
                          lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["to"]))).alias("n"),
                                                F.greatest(a["to"], s["end"]).alias("to")), lambda a: a["n"])
    hit = true.groupBy("doc_key").agg(covered.alias("n_hit"))
    named = (true.select("doc_key", "size", "window").distinct().join(known, ["size", "window"]).select("doc_key", F.explode("items").alias("item"))
             .groupBy("doc_key").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return hit.join(named, "doc_key")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, doc_key, n_words, n_hit, items (ids as strings, null if none), contaminated."""
    windows = stored(item_windows(benchmark), "item-windows")
    counted = docs.select("doc_id", row_key().alias("doc_key"), F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    places = hit_places(docs, windows)
    if places is None:
        joined = counted.withColumns({"n_hit": F.lit(None).cast("bigint"), "items": F.lit(None).cast("array<string>")})
    else:
        joined = counted.join(stored(occurrences(docs, windows, places), "hits"), "doc_key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return joined.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, columns unchanged."""
    key = fresh("bad")
    bad = contamination(docs, benchmark).where("contaminated").select(F.col("doc_key").alias(key)).distinct()
    return docs.join(stored(bad, "contaminated"), row_key() == F.col(key), "left_anti")
