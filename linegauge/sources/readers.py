"""Readers: CSV extracts, parquet tables, period scans."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linegauge.functions.exprs import in_period
from linegauge.sources.schemas import SOURCES


class EmptyInput(RuntimeError):
    """An input that must hold rows has none, or is missing."""


def read_csv(spark: SparkSession, path: str, schema: str, na_tokens: Sequence[str] = ()) -> DataFrame:
    """CSV with header and ``""`` quoting under an explicit schema (no inference pass).

    Only the empty field is null unless ``na_tokens`` names further texts: the text
    ``None`` is a valid code in the quality extracts.
    """
    df = (spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
          .option("nullValue", "").csv(path))
    if na_tokens:
        tokens = list(na_tokens)
        df = df.select(*[
            F.when(~F.col(f.name).isin(tokens), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields])
    return df


def read_source(spark: SparkSession, root: str, name: str, suffix: str = "",
                na_tokens: Sequence[str] = ()) -> DataFrame:
    """One source extract below ``root/<system>/<name><suffix>.csv``."""
    src = SOURCES[name]
    return read_csv(spark, f"{root}/{src.system}/{name}{suffix}.csv", src.schema, na_tokens)


def read_sources(spark: SparkSession, root: str, names: Iterable[str] = tuple(SOURCES), suffix: str = "",
                 na_tokens: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All extracts that exist, by name; missing files are left out."""
    found = {}
    for name in names:
        try:
            found[name] = read_source(spark, root, name, suffix, na_tokens)
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def zoned(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as instants of the session zone (UTC), once, at the reader."""
    return df.select(*[
        F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType)
        else F.col(f.name) for f in df.schema.fields])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table ``folder/<name>.parquet``."""
    return zoned(spark.read.parquet(f"{folder}/{name}.parquet"))


def read_first(spark: SparkSession, candidates: Sequence[str]) -> DataFrame:
    """The first of several parquet paths that exists."""
    for path in candidates:
        try:
            return zoned(spark.read.parquet(path))
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
    raise EmptyInput(f"none of {list(candidates)} exists")


def period_scan(df: DataFrame, cols: Sequence[str], ts: str, start: str, end: str,
                closed_at_midnight: bool = False) -> DataFrame:
    """Projected, date-filtered scan; both reach the parquet reader."""
    return df.where(in_period(ts, start, end, closed_at_midnight)).select(*cols)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail fast when ``df`` is empty (reads at most one row)."""
    if df.isEmpty():
        raise EmptyInput(f"no rows: {what}")
    return df
