"""Registry of runnable queries, each with the SQL an independent engine checks it by."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.sources.readers import read_table

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    run: Runner
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, oracle: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, covers, run, oracle)
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as inspections and cost events: inspected and failed pieces, exact money."""
    return table(spark, sf, "lineitem").withColumns({
        "inspected": F.col("l_quantity").cast("bigint"),
        "failed": F.floor(F.col("l_quantity") * F.col("l_discount")).cast("bigint"),
        # four decimals hold price x (1 - discount) exactly, so sums do not depend on row order
        "cost": (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")})


LINES = """
li AS (
  SELECT *, CAST(l_quantity AS BIGINT) AS inspected,
         CAST(floor(l_quantity * l_discount) AS BIGINT) AS failed,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS cost
  FROM lineitem)
"""


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("order_month", F.trunc("o_orderdate", "month"))
    return lines(spark, sf).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


ORDER_LINES = LINES.rstrip().rstrip(")") + """),
ol AS (SELECT li.*, o.*, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month
       FROM li JOIN orders o ON l_orderkey = o_orderkey)
"""


def money(col: Column | str, digits: int = 4) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col.cast("double"), digits)


def day(col: Column | str) -> Column:
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyy-MM-dd")


def month(col: Column | str) -> Column:
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyy-MM")


# document rows with a label and an unclamped score between 0 and 1: long documents stay apart
def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    score = F.col("n_chars") / (F.col("n_chars") + 1024.0)
    return table(spark, sf, "labels").join(docs, "doc_id").withColumn("score", score)


SCORED = """
sd AS (SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source, d.n_chars,
              CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + CAST(1024 AS DOUBLE)) AS score
       FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""
