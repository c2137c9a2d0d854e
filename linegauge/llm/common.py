"""Column helpers the operators of this subpackage share."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.session import scratch_path

#: Runs of ASCII white space.
GAP = r"[\x20\x09-\x0D]+"
_ASCII = "".join(map(chr, range(128)))
#: ASCII letters in lower case, digits as they are, every other ASCII character as a space.
_FOLDED = "".join(c.lower() if c.isalnum() else " " for c in _ASCII)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def tokens(col: Column) -> Column:
    """Runs of anything but ASCII white space; none for null."""
    return F.array_remove(F.split(F.coalesce(col, F.lit("")), GAP, -1), "")


def words(col: Column) -> Column:
    """Runs of digits, letters and non-ASCII characters of a text, A-Z lower-cased; none for null.

    One character map turns every other ASCII character into a space, and splitting at single spaces
    needs no pattern: many times faster than matching the whole class.
    """
    return F.array_remove(F.split(F.translate(F.coalesce(col, F.lit("")), _ASCII, _FOLDED), " ", -1), "")


def hashes(items: Column) -> Column:
    return F.transform(items, lambda x: F.xxhash64(x))


def gram_hashes(hashed: Column, k: int) -> Column:
    """Hash of every run of ``k`` words, from the words' hashes; none when there are fewer words."""
    return let(hashed, lambda h: runs(h, k, lambda at: F.xxhash64(*[F.get(h, at + j) for j in range(k)])))


def runs(items: Column, k: int, body: Callable[[Column], Column]) -> Column:
    """``body`` of the start (from 0) of every run of ``k`` items."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(items) - k, F.lit(0)))
    return F.when(F.size(items) >= k, F.transform(starts, body)).otherwise(F.array())


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128-bit key of a row by its id and text, as 32 hex digits: repeated rows share it and get equal results, null ids work."""
    own, body = F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return F.md5(F.concat(own, F.lit("\n"), body).cast("binary"))


def short_row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit key of a row by its id and text, for tables whose size decides how all texts are joined.

    Of 10^10 different rows, about three pairs share a key.
    """
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))


def fresh(name: str) -> str:
    """A column name that no caller's table has."""
    return f"_{name}_{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage, survives lost executors, and gives the planner the true size, so that Spark
    broadcasts it in a join only while it is small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet")
