"""Personal data, centroid clusters and periodic runs against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from brute import sha, tokens
from corpus_rows import SF, needs_tables, nothing, odd, odd_texts, ordered  # noqa: F401
from pyspark.sql import functions as F

from linegauge.llm import centroids, periodic, pii, queries
from linegauge.llm.common import documents

# --- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn_sum(digits):
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total


def base_spans(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn_sum(digits) % 10 == 0 or kind == "phone" and 8 <= len(digits) <= 15):
                out[kind].append(m.span())
    return out


PERSONAL = ["a@b.c@d.e mail x.y@z.example.org. and @no.where a@b_c.d", "a@b.c_d@e.f %@-.-", "1.2.3.4.5 256.1.1.1 01.002.0003.4 999.1.2.3.4",
            "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 4111111111111111", "+1 (017) 555-7713, +12 +1-2-3-4-5-6-7-8-",
            "++1 234 567 890", "é+49 170 1234567é ſ@ſ.de K@K.com", "0000 0000 0000 0000", "١٢٣٤ 1.1.1.1", "9" * 4000 + ".1.1.1"]


def test_strict_spans_are_those_of_the_patterns(spark, odd, odd_texts, nothing):
    rng = random.Random(3)
    junk = ["".join(rng.choice("1203 45.-+()@ab_%\n9") for _ in range(rng.randrange(80))) for _ in range(400)]
    rows = [*odd_texts, *((100 + i, t, "en", "s", None) for i, t in enumerate(PERSONAL + junk))]
    docs = spark.createDataFrame(rows, odd.schema).withColumn("base", F.lit("mine")).withColumn("row", F.lit(1)).withColumn("kind", F.lit(2))
    want = []
    for r in rows:
        found = base_spans(r[1])
        want.append((r[0], *map(len, found.values()), ",".join(f"{k}:{s}:{e}" for k, x in found.items() for s, e in x)))
    got = pii.extract(docs)
    got = got.select("doc_id", *[pii.count_kind(F.col("base"), k) for k in pii.STRICT], pii.span_text(F.col("base")))
    assert ordered(tuple(r) for r in got.collect()) == ordered(want)
    assert pii.extract(nothing).isEmpty()


def forms(context):
    far, near, after = context
    return {f"{far} {near} _", f"{near} _", f"{near} _ {after}", f"_ {after}"}


def discovered_by_hand(texts, rounds):
    """Per text, the added (kind, start, end), from the mentions and the definition of the scores."""
    mentions = [pii.mentions_of(t or "")[1] for t in texts]
    stands, places = defaultdict(set), defaultdict(set)
    seeds = {(m["kind"], m["value"]) for row in mentions for m in row if m["known"]}
    for row in mentions:
        for m in row:
            places[m["kind"], m["value"]].add(tuple(m["context"]))
            for p in forms(m["context"]):
                stands[m["kind"], p].add(m["value"])
    score = {v: 1000 if v in seeds else 0 for v in places}
    for _ in range(rounds):
        sure, trusted = {}, {}
        for (kind, p), values in stands.items():
            rated = [score[kind, v] for v in values]
            sure[kind, p] = sum(rated) // (len(rated) + pii.PRIOR)
            trusted[kind, p] = sure[kind, p] >= pii.TRUSTED and sum(s >= pii.ACCEPT for s in rated) >= pii.BACKING
        for (kind, v), contexts in places.items():
            best = 0
            for c in contexts:
                told = [p for p in forms(c) if len(stands[kind, p]) > 1]
                if any(trusted[kind, p] for p in told):
                    best = max(best, sum(sure[kind, p] for p in told) // len(told))
            if (kind, v) not in seeds:
                score[kind, v] = best if best >= pii.ACCEPT else 0
    return [sorted((f"like_{m['kind']}", m["start"], m["end"]) for m in row if not m["known"] and score[m["kind"], m["value"]] >= pii.ACCEPT)
            for row in mentions]


def contact_texts():
    rng = random.Random(11)
    number = lambda: f"({rng.randrange(100, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"
    texts = [f"note {i} please call +1 {number()} today or later" for i in range(40)]
    texts += [f"entry {i} please call {number()} today maybe" for i in range(10)]
    texts += [f"part {number()} of {i} in stock" for i in range(30)]
    texts += [f"reach me via mail user{i}@host{i}.example.org any time" for i in range(20)] + ["reach me via mail root@intranet any time", "see root@intranet"]
    return texts + ["", None]


def test_patterns_discover_values_no_strict_pattern_accepts(spark):
    texts = contact_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for rounds in (1, 3):
        got = {r.doc_id: [(pii.KINDS[s["rank"]], s["start"], s["end"]) for s in r.spans if s["rank"] >= len(pii.STRICT)]
               for r in pii.extract(docs, rounds).collect()}
        assert [got[i] for i in range(len(texts))] == discovered_by_hand(texts, rounds)
    assert all(len(got[i]) == 1 and got[i][0][0] == "like_phone" for i in range(40, 50))
    assert not any(got[i] for i in range(50, 80))
    assert got[100] and got[101] == [("like_email", 4, 17)]


def test_a_round_finds_more_than_the_one_before(spark):
    number = lambda i: f"({200 + i}) 555-{1000 + i}"
    first = [f"w{'abcdefghij'[i % 10]} dial +1 {number(i)} now" for i in range(60)]
    bridge = [f"w{'abcdefghij'[i % 10]} dial {number(100 + i)} now" for i in range(12)] + [f"extension number {number(100 + i)} ok" for i in range(12)]
    later = [f"extension number {number(300)} ok"]
    docs = spark.createDataFrame(list(enumerate(first + bridge + later)), "doc_id bigint, text string")
    count = [pii.extract(docs, rounds).where("size(base) < size(spans)").count() for rounds in (1, 3)]
    assert count[0] < count[1] and pii.extract(docs, 3).where("doc_id = 84 AND size(spans) = 1").count() == 1


def test_candidates_overlap_nothing():
    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choice("123456789 .-+()@ab,:\n") for _ in range(120))
        strict = pii.strict_spans(text)
        found = sorted((s, e) for _, s, e in pii.candidates(text, strict))
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
        assert not any(s < e2 and s2 < e for s, e in found for _, s2, e2 in strict)


def test_long_texts_take_linear_time():
    for text in ("a" * 2_000_000, "9" * 2_000_000, "a@" * 500_000, "1." * 500_000, "+1 " * 400_000, "a." * 500_000 + "@"):
        pii.mentions_of(text)


# --- centroid clusters


def clusters_by_hand(rows):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (sha(f"2:{'' if r[0] is None else r[0]}"), r[1]))
    middle = [v for _, v in order[:40]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(middle))
    for _ in range(5):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        middle = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(middle)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = defaultdict(int)
    for _, d, n in found:
        total[n] += d
    return [(i, n, d, total[n], sum(total.values()), sha(",".join(map(str, middle[n])))) for i, d, n in found]


def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(rng.integers(-2, 3), 0.5, 64)]) for i in range(n)]
    if not rows:
        return []
    odd = [(7, rows[0][1]), (7, rows[0][1]), (8, [0.0] * 64), (8, [0.0] * 64), (None, rows[1][1]), (901, None), (902, []), (903, [1.0] * 63),
           (904, [1.0] * 65), (905, [None, *[1.0] * 63]), (906, [float("nan"), *[1.0] * 63]), (907, [float("-inf"), *[1.0] * 63]),
           (908, [-0.0] * 64), (909, [-0.001] * 64), (910, [1000.5] * 64)]
    return rows + odd


@pytest.mark.parametrize("n", [0, 10, 150])
def test_clusters(spark, n):
    rows = vectors(n)
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("cluster", F.lit(1)).withColumn("q", F.lit(2))
    got = centroids.with_centroid_digests(*centroids.cluster(frame.repartition(5)))
    assert ordered(tuple(r) for r in got.collect()) == ordered(clusters_by_hand(rows))


def test_no_vectors_no_clusters(spark):
    none = spark.createDataFrame([(1, [1.0]), (2, None)], "vec_id bigint, embedding array<float>")
    got = centroids.with_centroid_digests(*centroids.cluster(none))
    assert got.isEmpty() and got.columns[-1] == "centroid_sha256"
    huge = spark.createDataFrame([(i, [(-1) ** i * 3e38] * 64) for i in range(50)], "vec_id bigint, embedding array<float>")
    assert {r.distance for r in centroids.cluster(huge)[0].collect()} == {0}


def test_tables_hold_occurring_values_alone():
    values, middle = np.array([[5, -3], [5, 9], [1 << 27, 9]], np.int32), np.array([[0, 0], [5, 5]], np.int64)
    tables, rows = centroids.tables_of(values, middle)
    assert [t.shape for t in tables] == [(2, 2), (2, 2)] and tables[0].dtype == np.int64 and tables[0][0].tolist() == [25, 0]
    assert rows[1].tolist() == [0, 1, 1] and centroids.nearest(values, middle)[1].tolist()[:2] == [34, 16]


# --- periodic runs


def runs_by_hand(words):
    n, seen, out = len(words), set(), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and (i, length) not in seen:
                seen.add((i, length))
                out.append((i, length, q))
            i = j + 1
    return sorted(out)


def analysed_by_hand(words):
    runs = runs_by_hand(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return runs, best, " ".join(w for i, w in enumerate(words) if i not in dropped)


def with_repeated_tail(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def periodic_texts():
    rng = random.Random(9)
    out = ["x " * k for k in range(1, 14)] + ["a b " * k for k in range(2, 8)] + ["a b a b a b a", "a a a a b a a a a b a a a a b a a a a b", "A a A a A a A a"]
    for alphabet, n in ((2, 60), (2, 400), (3, 300), (30, 300), (200, 900)):
        for _ in range(20):
            words = [f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(n))]
            for _ in range(rng.randrange(3)):
                at, p = rng.randrange(len(words) + 1), rng.randrange(1, 12)
                words[at:at] = ([f"w{rng.randrange(alphabet)}" for _ in range(p)] * 9)[:rng.randrange(2 * p, 9 * p)]
            out.append(rng.choice((" ", "\n", "\t \x0b")).join(words))
    return out


def test_runs_are_those_of_the_definition(spark, odd, odd_texts, nothing):
    short = [r for r in odd_texts if len(r[1] or "") < 10_000]
    rows = short + [(1000 + i, t, "en", "s", None) for i, t in enumerate(periodic_texts())]
    docs = spark.createDataFrame(rows, odd.schema).withColumn("runs", F.lit("mine")).withColumn("start", F.lit(1))
    for tails in (False, True):
        want = []
        for r in rows:
            words = tokens(r[1])
            runs, best, kept = analysed_by_hand(with_repeated_tail(words, r[0]) if tails else words)
            want.append((r[0], runs, *(best or (None,) * 3), kept))
        got = [(r.doc_id, [tuple(x) for x in r.runs], r.start, r.length, r.period, r.collapsed) for r in periodic.periodic_runs(docs, tails).collect()]
        assert ordered(got) == ordered(want)
    assert periodic.periodic_runs(nothing).isEmpty()


def test_segments_hold_all_runs():
    rng = np.random.default_rng(4)
    for _ in range(200):
        codes = np.concatenate([rng.integers(0, 40, rng.integers(0, 80)), np.tile(rng.integers(0, 9, rng.integers(1, 6)), rng.integers(1, 9)),
                                rng.integers(0, 5, rng.integers(0, 60))])
        assert periodic.runs_of(codes) == runs_by_hand(codes.tolist())
        for s, e in periodic.split_segments(codes) if codes.size else ():
            assert e - s >= periodic.MIN_WORDS and np.unique(codes[s:e], return_counts=True)[1].min() >= periodic.MIN_PERIODS or (s, e) == (0, codes.size)


def test_very_long_texts_are_scanned_whole():
    whole = np.zeros(300_000, np.int64)
    assert periodic.runs_of(whole) == [(0, 300_000, 1)]
    rng = np.random.default_rng(2)
    block = rng.integers(0, 50, 30_000)
    text = np.concatenate([rng.integers(0, 50_000, 200_000), np.tile(block, 5)[:-7], [60_000]])
    assert periodic.runs_of(text)[-1][1:] == (149_993, 30_000)


@needs_tables
def test_queries_give_the_contract_s_rows(spark):
    docs = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        words = with_repeated_tail(tokens(text), i)
        if len(words) > 1500:
            continue
        runs, best, kept = analysed_by_hand(words)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want = (i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(listed), sha(kept))
        assert tuple(got[i]) == want
    found = {r.doc_id: r for r in queries.QUERIES["op11_personal_data"](spark, SF).collect()}
    added = discovered_by_hand([t for _, t in docs], pii.ROUNDS)
    for (i, text), more in zip(docs, added):
        base = [f"{k}:{s}:{e}" for k, x in base_spans(text).items() for s, e in x]
        assert found[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        order = lambda s: (pii.KINDS.index(s[0]), s[1])
        assert found[i].spans == ",".join([*base, *(f"{k}:{s}:{e}" for k, s, e in sorted(more, key=order))])
