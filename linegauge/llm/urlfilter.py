"""URL filters: path rules, and a cascade of Bloom filters with exact answers for all hosts there are.

Level 1 encodes the listed hosts; the other hosts of the corpus that it lets through are encoded in
level 2, the listed hosts that level 2 takes for them in level 3, and so on until a level makes no
mistake. As the hosts of the corpus are known completely, the first level that refuses a host tells
exactly whether it is listed, and urls are judged where they stand, without a join.

Hosts are dealt by hash into cascades of about ``HOSTS_PER_CASCADE`` distinct hosts, each built in a
task of its own; a host's number of urls plays no part. All levels together take about two bytes per
listed host. They are broadcast while below ``MAX_CASCADE_BYTES``; beyond that urls are dealt out by
cascade, a frequent one to several tasks, and a task loads the cascades of its urls one after the other.

The list is a table of hosts, each listed with its subdomains, or else the hosts with a label of
``LISTED_LABELS``. Null hosts in it list nothing, repeated ones count once, an empty list lists nothing.
Null urls and urls without ``://`` have an empty host and path, fit no rule and are not listed;
repeated rows are judged alike; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.llm.common import ascii_lower, stored
from linegauge.session import scratch_path

# Rules as (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Host labels that list a host and all its subdomains.
LISTED_LABELS = ("spam-farm", "cheap-pills", "ads-track", "adult-x", "free-bets")
HOSTS_PER_CASCADE = 200_000
BITS_PER_KEY = 10
HASHES = 6
MAX_CASCADE_BYTES = 64 << 20
MAX_LEVELS = 64
#: Tasks that the urls of one cascade are dealt out to.
SPREAD = 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; empty texts without ``://``."""
    part = lambda n: F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", n)
    return ascii_lower(part(1)), part(2)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as host + path) and its verdict, null without one."""
    rule = verdict = F.lit(None).cast("string")
    for decision, at, below in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(below)
        rule, verdict = F.when(fits, F.lit(at + below)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def listed(host: Column, labels: tuple[str, ...] = LISTED_LABELS) -> Column:
    return F.arrays_overlap(F.split(host, r"\."), F.array(*[F.lit(x) for x in labels]))


def hosts_with_labels(pages: DataFrame, labels: tuple[str, ...] = LISTED_LABELS) -> DataFrame:
    """The distinct hosts of ``pages`` that have one of the labels: a list of hosts."""
    hosts = pages.select(host_and_path(F.col("url"))[0].alias("host")).distinct()
    return hosts.where(listed(F.col("host"), labels))


def listed_hosts(hosts: DataFrame, block_list: DataFrame) -> DataFrame:
    """``hosts`` (distinct) with ``listed``: whether the host or a domain it belongs to is in ``block_list``.

    Every host is looked up under each of its domains, by a join of distinct hosts with distinct entries.
    """
    parts = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda at: F.array_join(F.slice(parts, at, F.size(parts)), "."))
    entries = block_list.select(ascii_lower(F.col("host")).alias("domain")).where("domain <> ''").distinct()
    found = hosts.select("host", F.explode(domains).alias("domain")).join(entries, "domain", "left_semi").select("host").distinct()
    return hosts.join(found.withColumn("listed", F.lit(True)), "host", "left").select("host", F.coalesce("listed", F.lit(False)).alias("listed"))


def _places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bit places of keys in a level's filter, one row per hash."""
    step = h2 | np.uint64(1)
    start = h1 ^ np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64))
    mixed = start[None, :] + np.arange(HASHES, dtype=np.uint64)[:, None] * step[None, :]
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(16)) % np.uint64(bits)


def _has(level: int, bits: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    at = _places(h1, h2, level, bits.size * 8)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=0)


def build_levels(h1: np.ndarray, h2: np.ndarray, is_listed: np.ndarray) -> list[np.ndarray]:
    """Filters of one cascade, from the hashes of all its hosts."""
    levels: list[np.ndarray] = []
    inside, outside = np.flatnonzero(is_listed), np.flatnonzero(~is_listed)
    while inside.size:
        if len(levels) == MAX_LEVELS:
            raise ValueError("two hosts share all their hashes")
        bits = np.zeros(max(8, inside.size * BITS_PER_KEY // 8 + 1), np.uint8)
        at = _places(h1[inside], h2[inside], len(levels), bits.size * 8).ravel()
        np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (at & np.uint64(7)).astype(np.uint8)))
        levels.append(bits)
        passed = outside[_has(len(levels) - 1, bits, h1[outside], h2[outside])] if outside.size else outside
        inside, outside = passed, inside
    return levels


def member(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each key is listed: the first level that refuses it decides, by its parity."""
    out = np.zeros(h1.size, bool)
    open_keys = np.arange(h1.size)
    for n, bits in enumerate(levels):
        has = _has(n, bits, h1[open_keys], h2[open_keys])
        out[open_keys[~has]] = n % 2 == 1
        open_keys = open_keys[has]
        if not open_keys.size:
            break
    out[open_keys] = len(levels) % 2 == 1
    return out


def with_hashes(rows: DataFrame, cascades: int) -> DataFrame:
    hashed = rows.withColumns({"h1": F.xxhash64("host"), "h2": F.xxhash64(F.lit(1), "host")})
    return hashed.withColumn("cascade", F.pmod(F.xxhash64(F.lit(2), "host"), F.lit(cascades)).cast("int"))


def _unsigned(values) -> np.ndarray:
    return np.asarray(values, np.int64).view(np.uint64)


def build_cascades(hosts: DataFrame, cascades: int) -> DataFrame:
    """(cascade, level, bits) from distinct hosts (host, listed); a group is one cascade's hosts."""
    def build(group: pd.DataFrame) -> pd.DataFrame:
        levels = build_levels(_unsigned(group["h1"]), _unsigned(group["h2"]), group["listed"].to_numpy(bool))
        return pd.DataFrame({"cascade": np.full(len(levels), group["cascade"].iloc[0], np.int32),
                             "level": np.arange(len(levels), dtype=np.int32), "bits": [b.tobytes() for b in levels]})

    keys = with_hashes(hosts, cascades).select("cascade", "h1", "h2", "listed")
    return keys.groupBy("cascade").applyInPandas(build, "cascade int, level int, bits binary")


def _answers(batch: pa.RecordBatch, levels_of) -> np.ndarray:
    """Whether the host of each row is listed, by the cascades that ``levels_of`` gives."""
    h1, h2 = (_unsigned(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("h1", "h2"))
    cascade = batch.column("cascade").to_numpy(zero_copy_only=False)
    found = np.zeros(len(h1), bool)
    for c in np.unique(cascade):
        own = np.flatnonzero(cascade == c)
        found[own] = member(levels_of(int(c)), h1[own], h2[own])
    return found


def mark_listed(rows: DataFrame, levels: DataFrame, cascades: int) -> DataFrame:
    """``rows`` (with host) and a column ``listed``, by the broadcast cascades."""
    table: dict[int, list[np.ndarray]] = {}
    for r in levels.orderBy("cascade", "level").collect():
        table.setdefault(r["cascade"], []).append(np.frombuffer(r["bits"], np.uint8))
    shared = rows.sparkSession.sparkContext.broadcast(table)
    return _marked(rows, with_hashes(rows, cascades), lambda: lambda c: shared.value.get(c, []))


def mark_listed_by_cascade(rows: DataFrame, levels: DataFrame, cascades: int) -> DataFrame:
    """The same with a cascade at a time in a task, read from the shared folder; urls of a cascade go to ``SPREAD`` tasks."""
    folder = scratch_path(rows.sparkSession, "cascade-files")
    levels.write.partitionBy("cascade").parquet(folder)

    def loader():
        from pyarrow import fs, parquet

        files, base = fs.FileSystem.from_uri(folder)
        held: list = [None, []]

        def levels_of(c: int) -> list[np.ndarray]:
            if held[0] != c:
                at = f"{base}/cascade={c}"
                known = files.get_file_info(at).type != fs.FileType.NotFound
                read = parquet.read_table(at, filesystem=files, partitioning=None).sort_by("level") if known else None
                held[:] = [c, [np.frombuffer(b.as_py(), np.uint8) for b in read.column("bits")] if known else []]
            return held[1]

        return levels_of

    spread = F.pmod(F.xxhash64("page_id", "path"), F.lit(SPREAD))
    dealt = with_hashes(rows, cascades).repartition("cascade", spread).sortWithinPartitions("cascade")
    return _marked(rows, dealt, loader)


def _marked(rows: DataFrame, hashed: DataFrame, loader) -> DataFrame:
    columns = rows.columns

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels_of = loader()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(_answers(batch, levels_of))], [*columns, "listed"])

    return hashed.mapInArrow(test, ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", listed boolean")


def judge(pages: DataFrame, block_list: DataFrame | None = None, rules: tuple = RULES, labels: tuple[str, ...] = LISTED_LABELS,
          max_bytes: int = MAX_CASCADE_BYTES, hosts_per_cascade: int = HOSTS_PER_CASCADE) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict and listed; ``block_list`` is a table with a column host."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    distinct = rows.select("host").distinct()
    known = distinct.withColumn("listed", listed(F.col("host"), labels)) if block_list is None else listed_hosts(distinct, block_list)
    hosts = stored(known, "hosts")
    cascades = max(1, -(-hosts.count() // hosts_per_cascade))
    levels = stored(build_cascades(hosts, cascades), "cascades")
    size = levels.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
    marked = (mark_listed if size <= max_bytes else mark_listed_by_cascade)(rows, levels, cascades)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return marked.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
