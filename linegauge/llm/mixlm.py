"""Language-model scoring by online logistic context mixing.

A text is a row of tokens and an end. Every token has a code of ``BITS`` bits: the ``SYMBOLS`` most
frequent training tokens have one each, all others share the rest by a hash. The bits of a code are
predicted one by one in three hashed contexts (no token, one token, two tokens before it, and the
bits so far) from the counts of all training documents; the predictions are combined in the logistic
domain by weights that a gate (the bit's place and how much the longer contexts have seen) selects.
The weights start from those learned on all training documents (of the two longer contexts, each decision
left out of its own prediction) and are refined after every token of the document at hand. Tokens that
share a code share its probability by their smoothed counts, unknown ones included, so probabilities of
all texts add up to one.

Texts are coded once and their codes stored; counting, learning and scoring read the codes. Counts
per token come from all training documents and are shuffled by token; the ``FREQUENT`` most frequent
ones are also sent to the tasks, and only the rest is joined, so no frequent word becomes a hot key.

The contexts of an order have 2 ** ``LINE_BITS`` lines of 32 slots (the ways through five bits), two
bytes a slot, sent to all tasks: contexts that hash to the same line share its counts, and share more
as the corpus grows. ``shared_lines`` measures how many do. Counts of a slot are exact while they are
gathered and kept in proportion, up to 255, when sent. Documents start from the same weights and do
not affect each other, so results do not depend on order or partitions.

Null and empty texts consist of the end alone; a null id counts as an empty text in the split;
repeated rows get equal scores; without training documents every decision has probability one half; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil, log10
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.llm.common import stored

FOLDS, HELD_OUT = 7, 2
#: A code is two groups of five bits; each group has a line of 32 slots in every context.
GROUPS, GROUP_BITS = 2, 5
BITS = GROUPS * GROUP_BITS
CODES = 1 << BITS
SYMBOLS = 768
FREQUENT = 1 << 17
LINE_BITS = 17
LINE = 1 << GROUP_BITS
#: Lines of the context of no token, one for every beginning of a code, and where each group's lines start.
FIRST_LINES = [sum(LINE ** i for i in range(g)) for g in range(GROUPS)]
LINES = sum(LINE ** g for g in range(GROUPS)) + 2 * (1 << LINE_BITS)
ORDERS = 3
#: Where the lines of each order start and the last one's end.
ORDER_LINES = [0, LINES - (2 << LINE_BITS), LINES - (1 << LINE_BITS), LINES]
#: Lines in a packed row of counts.
PART = 1 << 8
#: Rows of counts that are added up by one call.
MERGED = 64
MOST = 255
PRIOR = 0.4
START_WEIGHT = 0.4
RATE = 0.02
GATES = BITS * 3 * 3
OFTEN = 8
#: What is summed per gate: the slope of the longer contexts' weights, then the bend of each two; the first starts at the common weight.
SUMS = [(1, None), (2, None), (1, 1), (1, 2), (2, 2)]
MOST_STEP = 1.0
FLUSH_TOKENS = 400_000
#: Tokens whose decisions are laid out at once; more where each time costs a pass over the counts, and tokens of texts scored together.
GROUP_TOKENS, COUNT_TOKENS, SCORE_TOKENS = 50_000, 300_000, 4_000_000

# the slot within a line and the bit, for each group value and step
NODE = np.array([[(1 << j) | (v >> (GROUP_BITS - j)) for j in range(GROUP_BITS)] for v in range(LINE)], np.intp)
BIT = np.array([[v >> (GROUP_BITS - 1 - j) & 1 for j in range(GROUP_BITS)] for v in range(LINE)], np.uint8)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, n) over all ``docs``, the end included as an empty token."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["token", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()):
                seen.update((text.as_py() or b"").lower().split())
                seen[b""] += 1
                if len(seen) > FLUSH_TOKENS:
                    yield rows()
        if seen:
            yield rows()

    counted = docs.select("text").mapInArrow(count, "token binary, n bigint")
    return counted.groupBy(F.col("token").cast("string").alias("token")).agg(F.sum("n").alias("n"))


def frequent_tokens(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """At most ``most`` (token, n) of the most frequent tokens, most frequent first.

    The least count that still leaves so many is found from a histogram of a few hundred bins, so
    the driver receives these tokens and nothing else, however many tasks there are.
    """
    fine = F.floor(F.log2("n") * 16).cast("int")
    bins = counts.groupBy(fine.alias("bin")).agg(F.count("*").alias("tokens")).orderBy(F.desc("bin")).collect()
    room, least = most, None
    for r in bins:
        room -= r["tokens"]
        if room < 0:
            break
        least = r["bin"]
    if least is None:
        return []
    return sorted(((r["token"], r["n"]) for r in counts.where(fine >= least).collect()), key=lambda r: (-r[1], r[0]))


# -- codes -----------------------------------------------------------------------

def shared_code(token: Column) -> Column:
    """The code of a token outside the symbols."""
    return F.crc32(token.cast("binary")) % (CODES - SYMBOLS) + SYMBOLS


def coded_rows(docs: DataFrame, ranks, code_of, mass_log, known_log, share_log) -> DataFrame:
    """Everything of a row but its mixed bits: counts, the sums of frequent tokens, the rarer tokens, and all codes."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, codes, mass = ranks.value, code_of.value, mass_log.value
        log_of, share_of = known_log.value, share_log.value
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for text in batch.column("text").cast(pa.large_binary()):
                raw = text.as_py() or b""
                words = raw.lower().split()
                words.append(b"")
                rank = np.array([number.get(w, -1) for w in words], np.int64)
                own = codes[rank]
                unusual = np.flatnonzero(rank < 0).tolist()
                for at in unusual:
                    own[at] = SYMBOLS + crc32(words[at]) % (CODES - SYMBOLS)
                rare = Counter(words[at] for at in unusual)
                usual = rank[rank >= 0]
                share = float(share_of[usual].sum()) - float(mass[own[unusual]].sum())
                out.append((row_id, len(raw), len(words), usual.size, float(log_of[usual].sum()), share, list(rare), list(rare.values()), own.tobytes()))
                row_id += 1
            columns = list(zip(*out)) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *(pa.array(c, t) for c, t in zip(columns, types))], names)

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()]
    names = ["doc_id", "held_out", "row_id", "n_bytes", "n_tokens", "n_usual", "usual_log", "share_log", "rare", "rare_n", "codes"]
    rows = docs.select(F.col("doc_id").cast("bigint"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(code, "doc_id bigint, held_out boolean, row_id bigint, n_bytes bigint, n_tokens bigint, n_usual bigint, usual_log double, "
                                 "share_log double, rare array<binary>, rare_n array<bigint>, codes binary")


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a column of texts laid end to end, and where each text starts, with the end."""
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1] // 2
    codes = np.frombuffer(data, np.uint16) if data else np.empty(0, np.uint16)
    return codes[bounds[0]:bounds[-1]], bounds - bounds[0]


def text_groups(bounds: np.ndarray, tokens: int = GROUP_TOKENS) -> Iterator[tuple[int, int]]:
    """First and last text of groups of about so many tokens."""
    first = 0
    while first < bounds.size - 1:
        last = int(np.searchsorted(bounds, bounds[first] + tokens))
        last = min(max(last, first + 1), bounds.size - 1)
        yield first, last
        first = last


# -- contexts --------------------------------------------------------------------

def spread(h: np.ndarray) -> np.ndarray:
    """Every bit of a 32-bit number spread over all of it."""
    h = h ^ (h >> np.uint32(15))
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0x297A2D39)
    return h ^ (h >> np.uint32(16))


def contexts(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the token before and of the two before every token of texts laid end to end; a text's beginning counts as a token."""
    n = codes.size
    after = codes.astype(np.uint32) + np.uint32(1)
    both = np.zeros((2, n), np.uint32)
    both[0, 1:], both[1, 2:] = after[:-1], after[:-2]
    both[:, starts] = 0
    second = starts + 1
    both[1, second[second < n]] = 0
    both[0] = spread(both[0] * np.uint32(0x9E3779B1) + np.uint32(1))
    both[1] = spread(both[0] ^ (both[1] * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F)))
    return both


def decisions(codes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits (token x place) and slots (order x token x place) of all decisions of tokens in their ``contexts``."""
    value = np.stack([codes >> GROUP_BITS * (GROUPS - 1 - g) & (LINE - 1) for g in range(GROUPS)], axis=1)
    lines = np.empty((ORDERS, codes.size, GROUPS), np.intp)
    for g in range(GROUPS):
        begun = (codes >> GROUP_BITS * (GROUPS - g)).astype(np.uint32) + np.uint32(FIRST_LINES[g])
        lines[0, :, g] = begun
        begun *= np.uint32(0x85EBCA6B)
        for k in (1, 2):
            lines[k, :, g] = spread(before[k - 1] + begun) >> np.uint32(32 - LINE_BITS)
            lines[k, :, g] += ORDER_LINES[k]
    lines *= LINE
    slots = lines[..., None] + NODE[value]
    return BIT[value].reshape(-1, BITS), slots.reshape(ORDERS, -1, BITS)


def slot_counts(rows: DataFrame) -> DataFrame:
    """(part, counts) of all contexts over the coded ``rows``: zeros and ones of ``PART`` lines, scaled to two bytes a slot.

    A task reads several input splits into one table and sends it packed; tables are added up ``MERGED`` at a
    time, so no call's input grows with the number of tasks.
    """
    spark = rows.sparkSession
    split = rows.rdd.getNumPartitions()
    tasks = min(split, max(2 * spark.sparkContext.defaultParallelism, ceil(split / 8)))
    size = 2 * LINE * PART

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, used = np.zeros(2 * LINE * LINES, np.uint32), False  # a task has fewer than 2^32 tokens
        places: list[list[np.ndarray]] = [[] for _ in range(ORDERS)]

        def add() -> None:
            for k in range(ORDERS):
                lo, hi = 2 * LINE * ORDER_LINES[k], 2 * LINE * ORDER_LINES[k + 1]
                table[lo:hi] += np.bincount(np.concatenate(places[k]), minlength=hi - lo).astype(np.uint32)
                places[k].clear()

        for batch in batches:
            codes, bounds = texts_of(batch.column(0))
            for first, last in text_groups(bounds):
                own = codes[bounds[first]:bounds[last]]
                bit, slots = decisions(own, contexts(own, bounds[first:last] - bounds[first]))
                for k in range(ORDERS):
                    at = slots[k]
                    at -= LINE * ORDER_LINES[k]
                    at *= 2
                    at += bit
                    places[k].append(at.ravel())
                used = True
                if sum(p.size for p in places[0]) > COUNT_TOKENS * BITS:
                    add()
        if places[0]:
            add()
        task = TaskContext.get().partitionId()
        for part in range(0, table.size, size) if used else ():
            yield packed(part // size, task // MERGED, table[part:part + size])

    def packed(part: int, bundle: int, counts: np.ndarray) -> pa.RecordBatch:
        small = counts.astype(np.min_scalar_type(int(counts.max(initial=0))))
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "bundle": pa.array([bundle], pa.int32()),
                                           "width": pa.array([small.itemsize], pa.int32()), "counts": pa.array([small.tobytes()], pa.binary())})

    def added(rows: pa.Table) -> tuple[int, int, np.ndarray]:
        total = sum(np.frombuffer(c.as_py(), f"u{w.as_py()}").astype(np.int64) for w, c in zip(rows.column("width"), rows.column("counts")))
        return rows.column("part")[0].as_py(), rows.column("bundle")[0].as_py(), total

    def merge(rows: pa.Table) -> pa.Table:
        part, bundle, total = added(rows)
        return pa.Table.from_batches([packed(part, bundle // MERGED, total)])

    def finish(rows: pa.Table) -> pa.Table:
        part, _, total = added(rows)
        return pa.table({"part": pa.array([part], pa.int32()), "counts": pa.array([scaled(total.reshape(-1, 2)).tobytes()], pa.binary())})

    schema = "part int, bundle int, width int, counts binary"
    counted = rows.select("codes").coalesce(tasks).mapInArrow(count, schema)
    while tasks > MERGED:
        counted = counted.groupBy("part", "bundle").applyInArrow(merge, schema)
        tasks = ceil(tasks / MERGED)
    return counted.groupBy("part").applyInArrow(finish, "part int, counts binary")


def scaled(counts: np.ndarray) -> np.ndarray:
    """Zeros and ones in the high and low byte; larger ones in proportion, what was met stays above 0."""
    most = counts.max(axis=1, initial=0, keepdims=True)
    small = np.where(most > MOST, np.maximum(counts * MOST // np.maximum(most, 1), counts > 0), counts)
    return (small[:, 0] << 8 | small[:, 1]).astype(np.uint16)


def slot_table(counts: DataFrame) -> np.ndarray:
    """The packed counts of all slots."""
    table = np.zeros(LINE * LINES, np.uint16)
    for r in counts.toLocalIterator():
        own = np.frombuffer(r["counts"], np.uint16)
        table[LINE * PART * r["part"]:LINE * PART * r["part"] + own.size] = own
    return table


def shared_lines(rows: DataFrame) -> tuple[int, int]:
    """Of the coded ``rows``: how many different contexts of two tokens there are, and how many lines they fill."""
    pair = F.expr("transform(sequence(1, length(codes) - 3, 2), i -> substring(codes, i, 4))")
    both = rows.where("length(codes) > 3").select(F.explode(pair).alias("pair")).distinct()
    found = both.select(F.pmod(F.xxhash64("pair"), F.lit(1 << LINE_BITS)).alias("line"))
    return tuple(found.agg(F.count("*"), F.countDistinct("line")).first())


# -- mixing ----------------------------------------------------------------------

def predictors() -> tuple[np.ndarray, np.ndarray]:
    """For every packed pair of counts the logit of the next bit, and how sure it is (0 unseen, 1 seen little, 2 seen often)."""
    pair = np.arange(1 << 16)
    zeros, ones = pair >> 8, pair & 255
    return np.log((ones + PRIOR) / (zeros + PRIOR)).astype(np.float32), ((zeros + ones > 0).astype(np.uint8) + (zeros + ones >= OFTEN)).astype(np.uint8)


def gate_sums(rows: DataFrame, tables) -> DataFrame:
    """(gate, sums) over the coded ``rows``: gradient and curvature of the code length at the start weight.

    A text's own decision is left out of the counts that predict it. ``GATES`` rows at most.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sums = tables.value, np.zeros((len(SUMS), GATES))
        logit, sure = predictors()
        for batch in batches:
            codes, bounds = texts_of(batch.column(0))
            for first, last in text_groups(bounds):
                part = codes[bounds[first]:bounds[last]]
                bit, slots = decisions(part, contexts(part, bounds[first:last] - bounds[first]))
                pairs = np.take(table, slots, mode="wrap") - np.where(bit, np.uint16(1), np.uint16(256))
                pairs = np.ascontiguousarray(pairs.transpose(2, 0, 1))
                for place in range(BITS):
                    x = np.take(logit, pairs[place])
                    seen = (np.take(sure, pairs[place, 1]) * np.uint8(3) + np.take(sure, pairs[place, 2])).astype(np.intp)
                    p = 1 / (1 + np.exp(np.float32(-START_WEIGHT) * (x[0] + x[1] + x[2])))
                    error, curve = bit[:, place] - p, p * (1 - p)
                    for n, (i, j) in enumerate(SUMS):
                        sums[n, place * 9:place * 9 + 9] += np.bincount(seen, error * x[i] if j is None else curve * x[i] * x[j], 9)
        met = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), *(pa.array(row[met]) for row in sums)], ["gate", *names])

    names = [f"s{n}" for n in range(len(SUMS))]
    summed = rows.select("codes").mapInArrow(add, "gate int, " + ", ".join(f"{c} double" for c in names))
    return summed.groupBy("gate").agg(*[F.sum(c).alias(c) for c in names])


def learned_weights(sums: DataFrame) -> np.ndarray:
    """Start weights per gate: a Newton step from the common start, held near it where little was seen."""
    weights = np.full((GATES, ORDERS), START_WEIGHT, np.float32)
    for r in sums.collect():
        slope, bend = np.zeros(ORDERS), np.eye(ORDERS)
        for (i, j), s in zip(SUMS, r[1:]):
            if j is None:
                slope[i] = s
            else:
                bend[i, j] = bend[j, i] = s + (i == j)
        step = np.linalg.solve(bend, slope)  # nothing for a weight without sums
        weights[r["gate"]] += step / max(1.0, float(np.abs(step).max()) / MOST_STEP)
    return weights


def mixed_log2(codes: np.ndarray, bounds: np.ndarray, table: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """log2 of the probability of each text's codes, texts laid end to end; ``weights`` are those of the gates at a text's start.

    All texts take a step together; texts are in order of length, so that those that still have a token
    are the first. Decisions are laid out for a few steps at a time.
    """
    logit, sure = predictors()
    starts, lengths = bounds[:-1], np.diff(bounds)
    by_length = np.argsort(-lengths, kind="stable")
    place = np.empty(starts.size, np.int64)
    place[by_length] = np.arange(starts.size)
    step = np.arange(codes.size, dtype=np.int32) - np.repeat(starts, lengths).astype(np.int32)
    ends = np.r_[0, np.cumsum(np.bincount(step))]  # of every step, in the order below
    order = np.empty(codes.size, np.int32)
    order[ends[step] + np.repeat(place, lengths)] = np.arange(codes.size, dtype=np.int32)
    before = contexts(codes, starts)[:, order]
    codes = codes[order]
    del order, step

    begin = np.full((GATES, ORDERS), START_WEIGHT, np.float32) if weights is None else weights
    own = [np.tile(begin[:, k], starts.size) for k in range(ORDERS)]
    base = (np.arange(starts.size) * GATES)[:, None] + np.arange(BITS) * 9
    total, rate = np.zeros(starts.size), np.float32(RATE)
    first = 0
    while first < ends.size - 1:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + GROUP_TOKENS)) - 1)
        part = slice(ends[first], ends[last])
        bit, slots = decisions(codes[part], before[:, part])
        pairs = np.take(table, slots, mode="wrap")
        inputs = np.take(logit, pairs)
        inputs *= bit.astype(np.float32) * 2 - 1  # for the bit that came
        seen = (np.take(sure, pairs[1]) * np.uint8(3) + np.take(sure, pairs[2])).astype(np.intp)
        odds = np.empty(bit.shape, np.float32)
        for lo, hi in zip((ends[first:last] - ends[first]).tolist(), (ends[first + 1:last + 1] - ends[first]).tolist()):
            g, x = base[:hi - lo] + seen[lo:hi], inputs[:, lo:hi]
            w = [np.take(own[k], g, mode="wrap") for k in range(ORDERS)]
            z = w[0] * x[0]
            z += w[1] * x[1]
            z += w[2] * x[2]
            wrong = np.exp(np.minimum(-z, np.float32(60)))  # odds of the other bit
            odds[lo:hi] = wrong
            wrong /= wrong + np.float32(1)
            wrong *= rate
            for k in range(ORDERS):
                own[k][g] = w[k] + wrong * x[k]  # no two decisions of a token share a gate
        text = np.arange(odds.shape[0]) - np.repeat(ends[first:last] - ends[first], np.diff(ends[first:last + 1]))
        total -= np.bincount(text, np.log2(odds + np.float32(1)).sum(axis=1, dtype=np.float64), starts.size)
        first = last
    return total[place]


def scored_rows(rows: DataFrame, tables, weights) -> DataFrame:
    """The coded rows with their mixed bits, without codes and tokens."""
    kept = ["doc_id", "held_out", "row_id", "n_bytes", "n_tokens", "n_usual", "usual_log", "share_log"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, start = tables.value, weights.value
        for batch in batches:
            codes, bounds = texts_of(batch.column("codes"))
            mixed = np.concatenate([mixed_log2(codes[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], table, start)
                                    for a, b in text_groups(bounds, SCORE_TOKENS)]) if len(bounds) > 1 else np.empty(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(mixed)], [*kept, "mixed"])

    return rows.select(*kept, "codes").mapInArrow(score, "doc_id bigint, held_out boolean, row_id bigint, n_bytes bigint, n_tokens bigint, n_usual bigint, "
                                                         "usual_log double, share_log double, mixed double")


def score(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), bits_per_byte."""
    sc = docs.sparkSession.sparkContext
    counts = stored(token_counts(docs.where(~held_out(F.col("doc_id")))), "token-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = frequent_tokens(counts, FREQUENT)
    symbols = [t for t, _ in top[:SYMBOLS]]
    # the smoothed counts of the tokens of a code, and of the unknown: a row per code
    others = counts.where(~F.col("token").isin(symbols)) if symbols else counts
    mass = np.ones(CODES)
    for r in others.groupBy(shared_code(F.col("token")).alias("code")).agg((F.sum("n") + F.count("*") + 1).alias("mass")).collect():
        mass[r["code"]] = r["mass"]
    code_of = np.array([i if i < SYMBOLS else SYMBOLS + crc32(t.encode()) % (CODES - SYMBOLS) for i, (t, _) in enumerate(top)] + [0], np.uint16)
    known = np.log10(np.array([n for _, n in top], np.float64) + 1)
    share = np.where(np.arange(len(top)) < SYMBOLS, 0.0, known - np.log10(mass[code_of[:-1]]))
    ranks = sc.broadcast({token.encode(): i for i, (token, _) in enumerate(top)})
    coded = stored(coded_rows(docs, ranks, sc.broadcast(code_of), sc.broadcast(np.log10(mass)), sc.broadcast(known), sc.broadcast(share)), "coded-rows")
    training = coded.where("NOT held_out")
    tables = sc.broadcast(slot_table(stored(slot_counts(training), "slots")))
    weights = sc.broadcast(learned_weights(gate_sums(training, tables)))
    base_log = log10(total + distinct + 1)

    rows = scored_rows(coded, tables, weights)
    rare = coded.select("row_id", F.explode(F.arrays_zip("rare", "rare_n")).alias("r"))
    rare = rare.select("row_id", F.col("r.rare").cast("string").alias("token"), F.col("r.rare_n").alias("tf"))
    met = rare.join(counts, "token").groupBy("row_id").agg(F.sum("tf").alias("n_rare"), F.sum(F.col("tf") * F.log10(F.col("n") + 1)).alias("rare_log"))
    out = rows.join(stored(met, "rare-tokens"), "row_id", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    model = F.col("mixed") * log10(2) + F.col("share_log") + rare_log
    return out.select("doc_id", "held_out", "n_tokens",
                      (F.col("n_usual") + F.coalesce("n_rare", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("bigint").alias("train_tokens"),
                      (F.col("usual_log") + rare_log - F.col("n_tokens") * base_log).alias("base_score"), model.alias("score"),
                      F.try_divide(-model / log10(2), F.col("n_bytes")).alias("bits_per_byte"))
