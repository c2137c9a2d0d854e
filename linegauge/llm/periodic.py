"""Periodic runs of words by recursive frequency splitting.

A run is a longest stretch of words with smallest period q and at least max(6, 4 q) words. Every word
of a run occurs at least four times in it, so a word that occurs less often in a segment is in no run
there and splits it. The parts are split again by their own counts until nothing changes; ordinary
text is gone after a few levels. What survives is scanned lag by lag: a run of period q matches itself
at distance q on 3 q consecutive places or more, hence on three neighbouring multiples of q, so each
lag looks at every q-th place only and extends what it finds. Places inside a run of a divisor's
period are known and skipped.

Words are the runs of anything but ASCII white space. Null and empty texts have no words and no runs;
repeated rows get equal results; an empty table gives an empty result; extra columns are not read.
Results are exact for texts of any length; nothing but the text itself is held in a task.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 6
MIN_PERIODS = 4

Run = tuple[int, int, int]  # start, length, period


def split_segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the segments that no word splits any more."""
    final: list[tuple[int, int]] = []
    at = np.arange(codes.size)  # places in segments that may still be split
    segment = np.zeros(codes.size, np.int64)
    n_words = int(codes.max()) + 1
    while at.size:
        word = pd.factorize(segment * n_words + codes[at])[0]  # a word of one segment
        often = np.bincount(word)[word] >= MIN_PERIODS
        is_split = np.zeros(int(segment[-1]) + 1, bool)
        is_split[segment[~often]] = True
        stable = ~is_split[segment]
        final += _stretches(at[stable], segment[stable])
        at, segment = at[often & ~stable], segment[often & ~stable]
        if at.size:  # a gap between places, or another segment before, starts a new segment
            segment = np.cumsum(np.r_[True, (np.diff(at) > 1) | (np.diff(segment) > 0)]) - 1
            long = np.bincount(segment) >= MIN_WORDS
            at, segment = at[long[segment]], (np.cumsum(long) - 1)[segment[long[segment]]]
    return final


def _stretches(at: np.ndarray, segment: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the segments made of these places."""
    starts = np.flatnonzero(np.diff(segment, prepend=-1))
    ends = np.r_[starts[1:], at.size][:starts.size] - 1
    return [(s, e + 1) for s, e in zip(at[starts].tolist(), at[ends].tolist())]


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal, looked at in growing pieces."""
    done, step = 0, 64
    while done < a.size:
        wrong = np.flatnonzero(a[done:done + step] != b[done:done + step])
        if wrong.size:
            return done + int(wrong[0])
        done, step = done + step, 2 * step
    return a.size


def scan_lags(codes: np.ndarray) -> list[Run]:
    """All runs of a segment."""
    n, runs = codes.size, []
    known: dict[int, tuple[list[int], list[int]]] = {}  # starts and ends of the runs of each period, ascending
    for q in range(1, n // MIN_PERIODS + 1):
        same = codes[:n - q:q] == codes[q::q]
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        for part in {q // 2, q // 3, 2 * q // 3} - {0} if hits.size else ():  # places between, which must match as well
            hits = hits[(codes[hits + part] == codes[hits + part + q]) & (codes[hits + q + part] == codes[hits + part + 2 * q])]
        divisors = [p for p in known if q % p == 0] if hits.size else []
        n_hit = 0
        while n_hit < hits.size:
            i = int(hits[n_hit])
            reached = _end_of_known(known, divisors, i, i + q) - q
            if reached <= i:
                after = _matching(codes[i:n - q], codes[i + q:])
                before = _matching(codes[:i][::-1], codes[q:i + q][::-1])
                start, length = i - before, before + after + q
                if length >= max(MIN_WORDS, MIN_PERIODS * q):
                    runs.append((start, length, q))
                    starts, ends = known.setdefault(q, ([], []))
                    starts.append(start)
                    ends.append(start + length)
                reached = i + after
            n_hit = int(np.searchsorted(hits, reached))
    return runs


def _end_of_known(known: dict, divisors: list[int], first: int, last: int) -> int:
    """End of a known run of one of these periods that holds both places, or -1."""
    for p in divisors:
        starts, ends = known[p]
        n = bisect_right(starts, first) - 1
        if n >= 0 and ends[n] > last:
            return ends[n]
    return -1


def runs_of(codes: np.ndarray) -> list[Run]:
    """All runs of a text of word numbers, by start and period."""
    if codes.size < MIN_WORDS:
        return []
    return sorted((start + s, length, q) for s, e in split_segments(codes) for start, length, q in scan_lags(codes[s:e]))


def kept_places(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stand outside all runs or in a first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def best_run(runs: list[Run]) -> Run | None:
    """The run with the greatest exact ratio of length to period; ties: smallest start, then period."""
    best = None
    for run in runs:  # in order of start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document whose id asks for it, with its tail repeating itself; others unchanged, as without an id."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (1 + (n - a) // p))[:n - a]


def _words(text: bytes) -> list[bytes]:
    return text.split()  # bytes are split at ASCII white space alone


def analysed(words: list[bytes]) -> tuple[list[Run], list[bytes]]:
    """Runs of a list of words, and the words that stay when all but the first period of each run go."""
    if len(words) < MIN_WORDS:
        return [], words
    codes = pd.factorize(np.array(words, dtype=object))[0]
    runs = runs_of(codes)
    return (runs, [words[i] for i in np.flatnonzero(kept_places(len(words), runs))]) if runs else (runs, words)


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, repeat_tails: bool = False) -> DataFrame:
    """Per row: doc_id, runs (by start, then period), the best one's start, length and period, and collapsed.

    ``collapsed`` is the text's words without repetitions, joined by a space. ``repeat_tails`` first repeats a
    part of about every tenth document, chosen by its id, for trials with known repetitions.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed, best, collapsed = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                words = _words(text.as_py() or b"")
                runs, kept = analysed(repeated_tail(words, doc_id) if repeat_tails else words)
                listed.append([dict(zip(RUN.names, r)) for r in runs])
                best.append(best_run(runs) or (None, None, None))
                collapsed.append(b" ".join(kept))
            columns = [pa.array(listed, pa.list_(RUN)), *(pa.array([b[n] for b in best], pa.int64()) for n in range(3)),
                       pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "runs", *RUN.names, "collapsed"])

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(search, f"doc_id bigint, runs {RUNS}, start bigint, length bigint, period bigint, collapsed string")
