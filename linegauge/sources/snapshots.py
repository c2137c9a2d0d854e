"""Versioned tables: data files first, then one manifest row per part, so readers see whole versions only.

Every export writes a folder of its own and is known to readers only from its manifest on. An export that
fails, or is repeated after a lost executor, leaves files no manifest names; they are never read.
The manifest is written by one job that commits all of its rows at once.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

from linegauge.sources.sinks import write_partitioned

MANIFEST = "version long, folder string, split string, n long, checksum long, schema string"
#: Listed for an export without rows, so that it is a version as well.
NO_SPLIT = ""


class BrokenSnapshot(ValueError):
    """A version whose files do not hold the rows its manifest names."""


def _checksum(df: DataFrame):
    """Sum over all rows of a hash of all columns, independent of their order, within 64 bits."""
    return F.coalesce(F.sum(F.xxhash64(*sorted(df.columns)).bitwiseAND(F.lit((1 << 31) - 1))), F.lit(0)).cast("bigint")


def _manifests(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def export(df: DataFrame, root: str, split: str = "split") -> int:
    """Write ``df`` by ``split`` (as text) as the next version; returns the version. A null split is refused.

    Counts and checksums are taken from the written files, in one pass over them. Versions are numbered
    by one writer at a time.
    """
    spark = df.sparkSession
    folder = f"data-{uuid.uuid4().hex}"
    before = _manifests(spark, root).agg(F.max("version")).first()[0]
    version = (before or 0) + 1
    write_partitioned(df, f"{root}/{folder}", split)
    # the split is the last column of what is read, whatever its place and type were
    schema = StructType([*(f for f in df.schema.fields if f.name != split), StructField(split, StringType())])
    written = spark.read.schema(schema).parquet(f"{root}/{folder}")
    if not written.where(F.col(split).isNull()).isEmpty():
        raise ValueError(f"rows without {split}")
    parts = written.groupBy(F.col(split).alias("split")).agg(F.count("*").alias("n"), _checksum(written).alias("checksum"))
    if written.isEmpty():
        parts = spark.createDataFrame([(NO_SPLIT, 0, 0)], "split string, n long, checksum long")
    parts.select(F.lit(version).cast("bigint").alias("version"), F.lit(folder).alias("folder"), "split", "n", "checksum",
                 F.lit(schema.json()).alias("schema")).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return version


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Rows of the manifest of a version, by default the latest; parts without rows are left out."""
    rows = _manifests(spark, root)
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    return rows.where((F.col("version") == version) & (F.col("split") != NO_SPLIT))


def read(spark: SparkSession, root: str, split: str = "split", part: str | None = None, version: int | None = None) -> DataFrame:
    """Rows of a version (of one part, whose folder alone is read), by default the latest."""
    rows = _manifests(spark, root)
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    known = rows.where(F.col("version") == version).select("folder", "schema").first()
    if known is None:
        raise FileNotFoundError(f"no version {version} in {root}")
    out = spark.read.schema(StructType.fromJson(json.loads(known["schema"]))).parquet(f"{root}/{known['folder']}")
    return out if part is None else out.where(F.col(split) == part)


def verify(spark: SparkSession, root: str, split: str = "split", version: int | None = None) -> None:
    """Raise ``BrokenSnapshot`` unless the files hold just the rows the manifest names."""
    rows = read(spark, root, split, version=version)
    found = rows.groupBy(F.col(split).alias("split")).agg(F.count("*").alias("n"), _checksum(rows).alias("checksum"))
    listed = manifest(spark, root, version).select("split", "n", "checksum")
    if not found.exceptAll(listed).isEmpty() or not listed.exceptAll(found).isEmpty():
        raise BrokenSnapshot(f"files of {root} differ from their manifest")
