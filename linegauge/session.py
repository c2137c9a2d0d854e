"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings every job of this library relies on. AQE coalesces small shuffle
# partitions, splits skewed join partitions and switches to broadcast joins only
# when the measured size of a side is below the threshold.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "linegauge", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the library settings."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    """One folder for all scratch tables of a local master, removed when the process ends."""
    folder = tempfile.mkdtemp(prefix="linegauge-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder the cluster names.

    A machine-local folder is used only for a local master without that setting.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/linegauge/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage so that later stages never recompute its inputs."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))
    return df.checkpoint(eager=True)


def fan_out(spark: SparkSession) -> int:
    """How many value ranges a global order is split into: a few per shuffle partition."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
