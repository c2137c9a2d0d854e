"""Writers: partitioned parquet, small CSV summaries, samples, read-through period cache."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, by: str) -> str:
    """Parquet partitioned by ``by``; only the partitions present in ``df`` are replaced.

    Rows are rebalanced by period first: a small period becomes one file, and Spark splits one that
    holds a third of the rows into tasks of the advised size.
    """
    (df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))
    return path


def write_csv_summary(df: DataFrame, path: str) -> str:
    """One CSV file with header, for summaries of a few rows per period.

    The summary's few rows are shuffled to one task; what computes them keeps its tasks.
    """
    (df.repartition(1).write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').csv(path))
    return path


def write_sample(df: DataFrame, key: str, n: int, path: str) -> str:
    """The first n rows by key as one CSV file."""
    first = df.orderBy(F.asc_nulls_last(key)).limit(n).coalesce(1)  # sorted and limited to one task already
    first.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def publish(df: DataFrame, name: str, stored: bool = False, path: str | None = None) -> DataFrame:
    """A layer as a lazy view, or as a stored table when it is read more than once."""
    if stored:
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    return df


def read_through(spark: SparkSession, path: str, by: str, value: str,
                 compute: Callable[[], DataFrame]) -> DataFrame:
    """Rows of one period from the store; computed and stored first when absent."""
    part = f"{path}/{by}={value}"
    try:
        return spark.read.parquet(part).withColumn(by, F.lit(value))
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    compute().drop(by).write.mode("overwrite").parquet(part)
    return spark.read.parquet(part).withColumn(by, F.lit(value))
