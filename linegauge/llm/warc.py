"""WARC archives read and written as a table of chunks.

Payloads are cut into rows (record, chunk number, data) of at most ``CHUNK`` bytes by Spark's own
functions, where a page's row is read; writers see these rows only. Every writing task makes one gzip
archive in the shared folder, a chunk at a time. Archives are read back as rows (archive, record,
chunk number, data): a payload of any size passes through in chunks, each with its payload's SHA-256 up
to there, so the last chunk has the digest of the whole and no Python task holds a record. Headers
travel with chunk 0, whatever the length of their url. There are as many reading tasks as archives.

Records with equal payloads of at least ``MIN_REVISIT`` bytes are stored once: the one with the
smallest page id is a response, the others revisit it (rows that share this id are all responses).

A null payload is empty, a null id or url leaves its header out, repeated rows give a record each, an
empty table gives no archive, extra columns are not read. Writers use a file of their own per
attempt and report it in their result, so what a lost or repeated task leaves behind is never read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linegauge.llm.common import stored

CHUNK = 1 << 16
MIN_REVISIT = 100
LEVEL = 1
EOL = b"\r\n"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_digest and first_id, the id whose record holds the payload."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("payload_digest")
    copies = large.agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(stored(copies, "copies"), "payload_digest", "left")


def chunk_rows(rows: DataFrame) -> DataFrame:
    """``planned`` rows as records in chunks: the record's fields, its type and length, chunk, last and data.

    A revisit has one chunk without data. A record's chunks follow one another in one task.
    """
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    kind = rows.select("page_id", "url", "payload_digest", "first_id", "payload", F.when(revisit, "revisit").otherwise("response").alias("kind"))
    kind = kind.withColumn("length", F.when(F.col("kind") == "response", F.octet_length("payload")).otherwise(0).cast("bigint"))
    last = F.floor((F.greatest(F.col("length"), F.lit(1)) - 1) / CHUNK).cast("int")
    each = kind.withColumn("chunk", F.explode(F.sequence(F.lit(0), last)))
    first = lambda c: F.when(F.col("chunk") == 0, F.col(c)).alias(c)
    data = F.when(F.col("kind") == "response", F.substring(F.col("payload"), F.col("chunk") * CHUNK + 1, F.lit(CHUNK))).otherwise(F.lit(b""))
    return each.select("page_id", first("url"), "payload_digest", "first_id", "kind", "length", "chunk", (F.col("chunk") == last).alias("last"), data.alias("data"))


def _clean(value: str) -> bytes:
    return " ".join(value.split()).encode()


def record_header(kind: str, length: int, digest: str, record: str, page_id: int | None, url: str | None, refers_to: int | None) -> bytes:
    lines = [VERSION, b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:uuid:" + record.encode() + b">",
             b"WARC-Date: " + DATE.encode(), b"Content-Type: text/html; charset=utf-8",
             b"WARC-Payload-Digest: sha256:" + digest.encode(), b"Content-Length: " + str(length).encode()]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + _clean(url))
    if page_id is not None:
        lines.append(b"X-Page-ID: " + str(page_id).encode())
    if kind == "revisit":
        lines += [b"WARC-Profile: " + PROFILE.encode(), b"X-Refers-To-Page-ID: " + str(refers_to).encode()]
    return EOL.join(lines) + EOL + EOL


def write_records(batches: Iterator[pa.RecordBatch], sink: Callable[[bytes], None]) -> int:
    """Write a gzip member per record from its chunks in order. Returns the number of records."""
    count, pack = 0, None
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload_digest", "first_id", "kind", "length", "chunk", "last")))
        for (page_id, url, digest, first, kind, length, chunk, last), data in zip(rows, batch.column("data")):
            if chunk == 0:
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                sink(pack.compress(record_header(kind, length, digest, str(uuid.uuid4()), page_id, url, first)))
            sink(pack.compress(memoryview(data.as_buffer())))
            if last:
                sink(pack.compress(EOL + EOL) + pack.flush())
                count += 1
    return count


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``rows`` (of ``planned``) as archives below a folder URI; returns (archive, records).

    The listing is stored, so the archives it names are those of the attempts that counted.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        first = next(batches, None)
        if first is None:
            return
        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        name = f"pages-{uuid.uuid4().hex}.warc.gz"

        def all_batches():
            yield first
            yield from batches

        with files.open_output_stream(f"{base}/{name}", compression=None) as out:
            count = write_records(all_batches(), out.write)
        yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [count]})

    return stored(chunk_rows(rows).mapInArrow(write, "archive string, records bigint"), "archives")


class Members:
    """Bytes of a gzip file of many members, decompressed a buffer at a time."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read_raw, self.unpack, self.rest, self.buffer = read, zlib.decompressobj(31), b"", bytearray()

    def fill(self) -> bool:
        while True:
            if self.unpack.eof:
                self.rest, self.unpack = self.unpack.unused_data, zlib.decompressobj(31)
            raw = self.rest or self.read_raw(CHUNK)
            self.rest = b""
            got = self.unpack.decompress(raw, CHUNK) if raw else self.unpack.flush()
            self.rest = self.unpack.unconsumed_tail
            self.buffer += got
            if got or not raw:
                return bool(got)

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before the next ``mark``, which is passed over; None at the end of the file.

        The search goes on where it stopped, so a header of any length is looked through once.
        """
        searched = 0
        while (at := self.buffer.find(mark, searched)) < 0:
            searched = max(0, len(self.buffer) - len(mark) + 1)
            if not self.fill():
                if self.buffer:
                    raise ValueError("the archive ends inside a record")
                return None
        return self.pop(at + len(mark))[:at]

    def pop(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def take(self, most: int) -> bytes:
        while not self.buffer and self.fill():
            pass
        out = self.pop(most)
        if not out:
            raise ValueError("the archive ends inside a payload")
        return out


def read_chunks(read: Callable[[int], bytes]) -> Iterator[tuple[int, int, dict[str, str], bytes, str]]:
    """(record, chunk, headers, data, digest up to there) of one archive; empty payloads have one empty chunk."""
    source, record = Members(read), 0
    while (head := source.until(EOL + EOL)) is not None:
        first, *lines = head.split(EOL)
        if first != VERSION:
            raise ValueError(f"not a record: {first[:40]!r}")
        headers = dict(x.decode().split(": ", 1) for x in lines)
        left, chunk, digest = int(headers["Content-Length"]), 0, hashlib.sha256()
        while left or not chunk:
            data = b""
            while left and len(data) < CHUNK:
                data += (got := source.take(min(left, CHUNK - len(data))))
                left -= len(got)
            digest.update(data)
            yield record, chunk, headers, data, digest.hexdigest()
            chunk += 1
        if source.until(EOL + EOL) != b"":
            raise ValueError("a record is longer than it says")
        record += 1


CHUNKS = pa.schema([("archive", pa.string()), ("record", pa.int64()), ("chunk", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())),
                    ("data", pa.binary()), ("digest", pa.string())])
CHUNKS_DDL = "archive string, record bigint, chunk bigint, headers map<string,string>, data binary, digest string"
BATCH = 64


def read_archives(archives: DataFrame) -> DataFrame:
    """The chunk table of all ``archives``, a task to each archive; headers stand in chunk 0."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                files, path = fs.FileSystem.from_uri(archive)
                rows = []
                with files.open_input_stream(path, compression=None) as source:
                    for record, chunk, headers, data, digest in read_chunks(source.read):
                        rows.append((archive, record, chunk, list(headers.items()) if chunk == 0 else None, data, digest))
                        if len(rows) == BATCH:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CHUNKS)], schema=CHUNKS)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CHUNKS)], schema=CHUNKS)

    # the number is given, or the planner would put a listing this small into one task
    return archives.select("archive").repartitionByRange(max(1, archives.count()), "archive").mapInArrow(read, CHUNKS_DDL)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table: archive, record, headers, stored_bytes and stored_digest."""
    last = F.max(F.struct("chunk", "digest"))["digest"]
    return chunks.groupBy("archive", "record").agg(F.first("headers", ignorenulls=True).alias("headers"),
                                                   F.sum(F.octet_length("data")).alias("stored_bytes"), last.alias("stored_digest"))


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages below ``folder`` and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Lengths and digests are those of the bytes read back; a revisit has them from the response it names.
    """
    found = records(read_archives(write_archives(planned(pages), folder)))
    head = lambda name: F.col("headers")[name]
    rows = stored(found.select(head("X-Page-ID").cast("bigint").alias("page_id"), head("WARC-Type").alias("record_type"),
                               head("X-Refers-To-Page-ID").cast("bigint").alias("refers_to"), "stored_bytes", "stored_digest",
                               F.substring_index(head("WARC-Payload-Digest"), ":", -1).alias("named_digest")), "records")
    named = rows.where("record_type = 'revisit'").select(F.col("refers_to").alias("named_id")).distinct()
    originals = (rows.where("record_type = 'response'").join(named, F.col("page_id") == F.col("named_id"), "left_semi")
                 .groupBy(F.col("page_id").alias("_id"), F.col("stored_digest").alias("payload_digest"))
                 .agg(F.max("stored_bytes").alias("payload_bytes")))
    revisits = rows.where("record_type = 'revisit'").join(
        stored(originals, "revisited"), (F.col("refers_to") == F.col("_id")) & (F.col("named_digest") == F.col("payload_digest")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = rows.where("record_type = 'response'").select(
        "page_id", F.col("stored_bytes").alias("payload_bytes"), F.col("stored_digest").alias("payload_digest"), "record_type", "refers_to")
    return responses.unionByName(revisits.select(columns))
