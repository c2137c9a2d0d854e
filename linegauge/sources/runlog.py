"""Model versions, parameters and metrics as append-only tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_id string, run_type string, model_name string, version long, tags map<string,string>"
METRIC_SCHEMA = "run_id string, metric string, value double"


def log_run(spark: SparkSession, root: str, run_id: str, run_type: str, model_name: str, version: int,
            metrics: Mapping[str, float], tags: Mapping[str, object] | None = None) -> None:
    """Append one run and its metrics (a handful of rows)."""
    text_tags = {k: str(v) for k, v in (tags or {}).items()}
    spark.createDataFrame([(run_id, run_type, model_name, version, text_tags)], RUN_SCHEMA).coalesce(
        1).write.mode("append").parquet(f"{root}/model_runs")
    rows = [(run_id, k, float(v)) for k, v in metrics.items()]
    if rows:
        spark.createDataFrame(rows, METRIC_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/model_metrics")


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def runs(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, f"{root}/model_runs", RUN_SCHEMA)


def run_metrics(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    out = _stored(spark, f"{root}/model_metrics", METRIC_SCHEMA)
    return out if run_id is None else out.where(F.col("run_id") == run_id)


def version_history(spark: SparkSession, root: str, model_name: str) -> DataFrame:
    """Versions of a model, newest first, with their metrics as a map."""
    m = run_metrics(spark, root).groupBy("run_id").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics"))  # few per run
    return runs(spark, root).where(F.col("model_name") == model_name).join(m, "run_id", "left").orderBy(
        F.desc("version"))


def latest_version(spark: SparkSession, root: str, model_name: str) -> DataFrame:
    """The run with the highest version."""
    return runs(spark, root).where(F.col("model_name") == model_name).agg(
        F.max_by(F.struct("run_id", "version", "tags"), "version").alias("r")).where(
        F.col("r").isNotNull()).select("r.*")
