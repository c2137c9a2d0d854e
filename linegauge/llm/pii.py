"""Personal data by bootstrapped contextual extraction.

Strict patterns (mail address, IPv4 address, payment card, phone number) are reported wherever they
stand; the values they match are the seeds. A seed induces lexical patterns: the words around it, in
four forms. Strings of a similar make that no strict pattern accepts (a phone number without its plus
sign, a card number with a wrong digit, a mail address without a full host name) are candidates, and
stand in lexical patterns as well. Spark scores the graph of patterns and values in rounds: a pattern
is as trustworthy as the share of its distinct values that are known or discovered. A place scores the
mean of its patterns (without those that no other value stands in, which say nothing) if one of them
is trusted, a candidate scores its best place, and is discovered from ``ACCEPT`` on. Discovered values
raise their patterns in the next round. All mentions of a discovered value are reported, beside the
strict spans, as ``like_<kind>``.

Scores are whole thousandths, so they do not depend on the order of rows. Values count once per
pattern however often they are repeated. Null and empty texts have no spans; repeated rows get equal
results; a null id is a row like any other; an empty table gives an empty result; extra columns are
not read. Positions are code points, ends are exclusive. Whole texts are searched in linear time.
"""

from __future__ import annotations

import re
import string
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import md5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.llm.common import stored

# The strict kinds in the order they are listed, and what they accept
STRICT = ("email", "ip", "card", "phone")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MOST_PART, CARD_DIGITS, PHONE_DIGITS = 255, (16, 19), (8, 15)

#: Kinds in the order spans are listed.
KINDS = (*STRICT, *(f"like_{k}" for k in STRICT))
# Candidates of each kind: similar in make, not accepted by the strict pattern
ALIKE = {
    "ip": re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,4}(?:[.,][0-9]{1,4}){3}(?![0-9A-Za-z])|(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[\x20.-]?[0-9]{4}){2}[\x20.-]?[0-9]{3,7}(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])(?:\(?[0-9]{2,4}\)?[\x20./-]){1,3}[0-9]{3,4}[\x20.-]?[0-9]{3,5}(?![0-9A-Za-z])"),
}
HANDLE_END = frozenset(string.whitespace + "\"'<>(),;:@")
DIGIT = re.compile(r"[0-9]")
DIGITS = re.compile(r"[0-9]+")
#: Characters on either side of a value in which its neighbouring words are looked for.
CONTEXT = 200

ROUNDS = 3
#: Distinct values a pattern is counted as having beside its own, none of them personal.
PRIOR = 2
#: Thousandths from which a pattern is trusted, and the known or discovered values it must have.
TRUSTED, BACKING = 600, 3
#: Thousandths from which a candidate is discovered.
ACCEPT = 500

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in HOST.finditer(text):
        start = at = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            last = m.end()
            yield start, last


def _is_ip(text: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= MOST_PART for part in text.split("."))


def _n_digits(text: str) -> int:
    return sum(map(text.count, string.digits))


def _luhn(text: str) -> bool:
    digits = [int(c) for c in reversed(text) if c in string.digits]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def _is_card(text: str) -> bool:
    return CARD_DIGITS[0] <= _n_digits(text) <= CARD_DIGITS[1] and _luhn(text)


def _is_phone(text: str) -> bool:
    return PHONE_DIGITS[0] <= _n_digits(text) <= PHONE_DIGITS[1]


def strict_spans(text: str) -> list[Span]:
    """(kind, start, end) of every strict match, by kind and start."""
    spans = [("email", *s) for s in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for kind, pattern, holds in (("ip", IP, _is_ip), ("card", CARD, _is_card), ("phone", PHONE, _is_phone)):
            spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if holds(m[0])]
    return spans


def _handles(text: str) -> Iterator[tuple[int, int]]:
    """Strings around an at sign."""
    at, last = text.find("@"), 0
    while at >= 0:
        start, end = at, at + 1
        while start > last and text[start - 1] not in HANDLE_END:
            start -= 1
        while end < len(text) and text[end] not in HANDLE_END:
            end += 1
        while end > at + 1 and text[end - 1] in ".!?":
            end -= 1
        if start < at and end > at + 1:
            yield start, end
        last = end
        at = text.find("@", end)


def candidates(text: str, strict: list[Span]) -> list[Span]:
    """(kind, start, end) of strings that resemble a kind and overlap neither a strict span nor one another."""
    found = [("email", *s) for s in _handles(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [(kind, m.start(), m.end()) for kind, pattern in ALIKE.items() for m in pattern.finditer(text)]
    if not found:
        return []
    taken = sorted((start, end) for _, start, end in strict)
    reached, ends = 0, []
    for _, end in taken:
        ends.append(reached := max(reached, end))
    out, last = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], STRICT.index(s[0]))):
        before = bisect_right(taken, (end - 1, float("inf")))  # strict spans that start before this one ends
        if start >= last and (not before or ends[before - 1] <= start):
            out.append((kind, start, end))
            last = end
    return out


def value_of(kind: str, text: str) -> str:
    """What two mentions of the same value share: the digits of a number, or the address in lower case."""
    bare = text.lower() if kind == "email" or ":" in text else (".".join if kind == "ip" else "".join)(DIGITS.findall(text))
    return md5(bare.encode()).hexdigest()


def neighbours(text: str, start: int, end: int) -> list[str]:
    """The two words before a value and the one after; numbers in them are written 0, a missing word is empty."""
    plain = lambda words: [DIGITS.sub("0", w.lower()) for w in words]
    before = ["", "", *plain(text[max(0, start - CONTEXT):start].split()[-2:])]
    return [*before[-2:], *plain(text[end:end + CONTEXT].split(None, 1)[:1]), ""][:3]


def lexical_patterns(context: Column) -> Column:
    """The four forms in which neighbouring words make a pattern."""
    far, near, after = (F.get(context, F.lit(n)) for n in range(3))
    return F.array(F.concat_ws(" ", far, near, F.lit("_")), F.concat_ws(" ", near, F.lit("_")),
                   F.concat_ws(" ", near, F.lit("_"), after), F.concat_ws(" ", F.lit("_"), after))


SPAN = "struct<rank:int,start:bigint,end:bigint>"
MENTION = "struct<kind:string,start:bigint,end:bigint,known:boolean,value:string,context:array<string>>"
_SPAN = pa.struct([("rank", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_MENTION = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("known", pa.bool_()), ("value", pa.string()),
                      ("context", pa.list_(pa.string()))])


def mentions_of(text: str) -> tuple[list[dict], list[dict]]:
    """Strict spans, and all mentions with value and neighbouring words."""
    strict = strict_spans(text)
    every = [(s, True) for s in strict] + [(s, False) for s in candidates(text, strict)]
    return ([{"rank": KINDS.index(kind), "start": start, "end": end} for kind, start, end in strict],
            [{"kind": kind, "start": start, "end": end, "known": known, "value": value_of(kind, text[start:end]),
              "context": neighbours(text, start, end)} for (kind, start, end), known in every])


def found_mentions(docs: DataFrame) -> DataFrame:
    """doc_id, row (a number of its own for every row), base and mentions of every document."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [mentions_of(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array([b for b, _ in found], pa.list_(_SPAN)),
                 pa.array([m for _, m in found], pa.list_(_MENTION))], ["doc_id", "row", "base", "mentions"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(search, f"doc_id bigint, row bigint, base array<{SPAN}>, mentions array<{MENTION}>")


def graph(mentions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The distinct values (with seed: whether a strict span has it), their places (contexts), and the edges to patterns."""
    places = stored(mentions.groupBy("kind", "value", "context").agg(F.max("known").alias("seed")), "pii-places")
    values = stored(places.groupBy("kind", "value").agg(F.max("seed").alias("seed")), "pii-values")
    places = places.select("kind", "value", "context", F.explode(lexical_patterns(F.col("context"))).alias("pattern"))
    return values, places, stored(places.select("kind", "pattern", "value").distinct(), "pii-edges")


def pattern_scores(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """kind, pattern, its number of values n, confidence in thousandths, and whether it is trusted."""
    rated = edges.join(scores, ["kind", "value"]).groupBy("kind", "pattern").agg(
        F.count("*").alias("n"), F.sum("score").alias("total"), F.count_if(F.col("score") >= ACCEPT).alias("backing"))
    confidence = F.expr(f"total div (n + {PRIOR})")
    return rated.select("kind", "pattern", "n", confidence.alias("confidence"),
                        ((confidence >= TRUSTED) & (F.col("backing") >= BACKING)).alias("trusted"))


def value_scores(places: DataFrame, values: DataFrame, patterns: DataFrame) -> DataFrame:
    """kind, value, seed and score in thousandths: 1000 for seeds, 0 for what is not discovered."""
    telling = patterns.where("n > 1").drop("n")
    rated = places.join(telling, ["kind", "pattern"]).groupBy("kind", "value", "context").agg(
        F.expr("sum(confidence) div count(*)").alias("mean"), F.max("trusted").alias("trusted"))
    best = rated.where(F.col("trusted") & (F.col("mean") >= ACCEPT)).groupBy("kind", "value").agg(F.max("mean").alias("best"))
    score = F.when(F.col("seed"), 1000).otherwise(F.coalesce("best", F.lit(0))).cast("bigint")
    return values.join(best, ["kind", "value"], "left").select("kind", "value", "seed", score.alias("score"))


def scored_graph(mentions: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """The scores of all values, and those of the patterns they come from, after ``rounds`` rounds.

    A pattern or value with many neighbours is a skewed side of a join with one row per key on the
    other, which Spark splits; all aggregates are combined before their shuffle.
    """
    values, places, edges = graph(mentions)
    scores, patterns = values.select("*", F.when(F.col("seed"), 1000).otherwise(0).cast("bigint").alias("score")), None
    for _ in range(rounds):
        patterns = stored(pattern_scores(edges, scores.select("kind", "value", "score")), "pii-patterns")
        scores = stored(value_scores(places, values, patterns), "pii-scores")
    return scores, patterns


def extract(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, base and spans (arrays of rank in ``KINDS``, start and end, in order)."""
    found = stored(found_mentions(docs), "pii-mentions")
    mentions = found.select("row", F.inline("mentions"))
    scores, _ = scored_graph(mentions, rounds)
    discovered = scores.where(F.col("score") >= ACCEPT).select("kind", "value")
    ranks = F.coalesce(*[F.when(F.col("kind") == k, F.lit(KINDS.index(f"like_{k}"))) for k in STRICT])
    added = (mentions.where("NOT known").join(discovered, ["kind", "value"])
             .groupBy("row").agg(F.collect_list(F.struct(ranks.alias("rank"), "start", "end")).alias("added")))
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>"))))
    return found.join(stored(added, "pii-added"), "row", "left").select("doc_id", "base", spans.alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("bigint")
