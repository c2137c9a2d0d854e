"""Secret scans with multipart credential linking.

Strong patterns (an assignment, an access key, a long hex run) are reported wherever they stand.
Weak parts are not reported by themselves: an identifier of an account, a string that looks like a
secret, or an endpoint says little alone. Scopes are the blocks of a text without a blank line, whatever
their length. Parts are assigned to the scope whose interval holds their start, and joined within it: an
identifier counts if the scope has a secret, a secret if it has an identifier, and an endpoint if it has
both. Strong spans take part in the links. A scope is reduced to the roles it has before the join, so
parts are never paired up.

Null and empty texts have no spans; repeated rows get equal results; an empty table gives an empty
result; extra columns are not read. Positions are code points, ends are exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.llm.common import stored

# The strong kinds in the order they are listed, and their least lengths
STRONG = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(rf"[0-9a-f]{{{MIN_HEX},}}")
#: An assignment needs one of these, in any case; looking for them first spares most texts the pattern.
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")

WEAK = ("weak_access", "weak_secret", "endpoint")
KINDS = (*STRONG, *WEAK)
IDENTIFIER = re.compile(
    r"""(?ai:\b(?:user(?:name|_?id)?|login|account|client_?id|access_?key(?:_?id)?|key_?id)["']?\x20*[:=]\x20*["']?[a-z0-9_.@-]{3,})""")
IDENTIFIER_HINTS = ("user", "login", "account", "client", "key")
MIXED = re.compile(r"[A-Za-z0-9+/_-]{16,}")
MIXED_CLASSES = (re.compile(r"[a-z]"), re.compile(r"[A-Z]"), re.compile(r"[0-9]"))
ENDPOINT = re.compile(r"""(?a:[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]+)|(?ai:\b(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[a-z0-9_.:/-]{3,})""")
ENDPOINT_HINTS = ("://", "host", "endpoint", "server")
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "weak_access": "identifier", "weak_secret": "secret",
         "endpoint": "endpoint"}
SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint>"
FOUND = pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("kind", pa.string()), ("end", pa.int64())])


def strong_spans(text: str, folded: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every strong match."""
    spans = []
    if any(h in folded for h in ASSIGN_HINTS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return spans + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def weak_spans(text: str, folded: str, strong: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of weak parts that overlap no strong span."""
    found = []
    if any(h in folded for h in IDENTIFIER_HINTS):
        found += [("weak_access", m.start(), m.end()) for m in IDENTIFIER.finditer(text)]
    found += [("weak_access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() < MIN_ACCESS]
    if any(h in folded for h in ASSIGN_HINTS):
        found += [("weak_secret", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) < MIN_VALUE]
    if any(h in folded for h in ENDPOINT_HINTS):
        found += [("endpoint", m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    found += [("weak_secret", m.start(), m.end()) for m in MIXED.finditer(text) if all(c.search(m[0]) for c in MIXED_CLASSES)]
    taken = sorted((start, end) for _, start, end in strong)
    reached, ends = 0, []
    for _, end in taken:
        ends.append(reached := max(reached, end))

    def free(start: int, end: int) -> bool:
        before = bisect_right(taken, (end - 1, float("inf")))  # strong spans that start before this one ends
        return not before or ends[before - 1] <= start

    return sorted({s for s in found if free(s[1], s[2])}, key=lambda s: s[1])


def parts_of(text: str) -> tuple[list, list]:
    """Strong spans, and all parts with the scope they stand in."""
    folded = text.lower()
    strong = strong_spans(text, folded)
    parts = strong + weak_spans(text, folded, strong)
    breaks = [m.start() for m in BLANK_LINE.finditer(text)] if len(parts) > 1 else []
    return strong, [(kind, start, end, bisect_right(breaks, start)) for kind, start, end in parts]


def found_parts(docs: DataFrame) -> DataFrame:
    """doc_id, row (a number of its own), base (strong spans in order) and parts (only where two roles or more occur)."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int64())])
        for batch in batches:
            base, parts = [], []
            for value in batch.column("text"):
                strong, all_parts = parts_of(value.as_py() or "")
                base.append(sorted((start, KINDS.index(kind), kind, end) for kind, start, end in strong))
                parts.append(all_parts if len({ROLES[p[0]] for p in all_parts}) > 1 else [])
            named = lambda rows, kind: pa.array([[dict(zip(kind.names, r)) for r in row] for row in rows], pa.list_(kind))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), named(base, FOUND), named(parts, part)],
                                             ["doc_id", "row", "base", "parts"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.monotonically_increasing_id().alias("row"), "text")
    return rows.mapInArrow(search, f"doc_id bigint, row bigint, base array<{SPAN}>, "
                                   "parts array<struct<kind:string,start:bigint,end:bigint,scope:bigint>>")


def linked_parts(parts: DataFrame) -> DataFrame:
    """Weak parts (row, kind, start, end) in whose scope their complementary parts stand.

    A row per scope says which roles it has; it is combined in the tasks before the shuffle, so a scope of
    any number of parts is a few rows, and its parts are the skewed side of a join with one row per key.
    """
    role = F.coalesce(*[F.when(F.col("kind") == k, F.lit(r)) for k, r in ROLES.items()])
    parts = parts.withColumn("role", role)
    has = lambda r: F.max(F.col("role") == r)
    scopes = parts.groupBy("row", "scope").agg(has("identifier").alias("named"), has("secret").alias("hidden"))
    linked = (F.when(F.col("role") == "identifier", F.col("hidden")).when(F.col("role") == "secret", F.col("named"))
              .otherwise(F.col("named") & F.col("hidden")))
    return parts.where(F.col("kind").isin(*WEAK)).join(scopes, ["row", "scope"]).where(linked).select("row", "kind", "start", "end")


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, base and spans (arrays of start, rank, kind, end in order)."""
    found = stored(found_parts(docs), "secret-parts")
    linked = linked_parts(found.where(F.size("parts") > 0).select("row", F.inline("parts")))
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(n)) for n, k in enumerate(KINDS)])
    added = stored(linked.groupBy("row").agg(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end")).alias("added")), "linked")
    return found.join(added, "row", "left").select(
        "doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>")))).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
