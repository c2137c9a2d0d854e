from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from linegauge import session
from linegauge.sources import readers, runlog, sinks, snapshots


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("202601", 1), ("202602", 2)], "period string, v int")
    sinks.write_partitioned(df, path, "period")
    sinks.write_partitioned(df.where("period = '202602'").withColumn("v", F.lit(9)), path, "period")
    assert sorted(rows(spark.read.schema(df.schema).parquet(path).select("period", "v"))) == [("202601", 1), ("202602", 9)]
    plan = spark.read.schema(df.schema).parquet(path).where("period = '202601'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_read_through_computes_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.createDataFrame([(1, "202601")], "v int, period string")

    for _ in range(2):
        got = sinks.read_through(spark, str(tmp_path / "c"), "period", "202601", compute)
        assert rows(got) == [(1, "202601")]
    assert calls == [1]


def test_csv_summary_sample_and_fallback(spark, tmp_path):
    df = spark.createDataFrame([(i, f'q"{i}') for i in range(10)], "k int, t string").repartition(4)
    path = sinks.write_sample(df, "k", 3, str(tmp_path / "s"))
    assert rows(readers.read_csv(spark, path, "k int, t string")) == [(0, 'q"0'), (1, 'q"1'), (2, 'q"2')]
    df.write.parquet(str(tmp_path / "second"))
    got = readers.read_first(spark, [str(tmp_path / "first"), str(tmp_path / "second")])
    assert got.count() == 10
    with pytest.raises(readers.EmptyInput):
        readers.read_first(spark, [str(tmp_path / "first")])
    with pytest.raises(readers.EmptyInput):
        readers.require_rows(df.where("k > 99"), "nothing")


def test_period_scan_reaches_the_reader(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.createDataFrame([(datetime(2026, 1, 31, 8), 1, "x")], "ts timestamp, v int, w string").write.parquet(path)
    df = readers.period_scan(spark.read.parquet(path), ["v"], "ts", "2026-01-01", "2026-01-31")
    plan = df._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan and "w" not in plan.split("ReadSchema:")[1][:60]
    assert rows(df) == [(1,)]


def test_run_log(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert runlog.latest_version(spark, root, "m").count() == 0
    for v in (1, 2):
        runlog.log_run(spark, root, f"r{v}", "training", "m", v, {"auc": 0.5 + v / 10}, {"n": v})
    assert runlog.latest_version(spark, root, "m").first()["run_id"] == "r2"
    history = runlog.version_history(spark, root, "m").collect()
    assert [(r["version"], r["metrics"]["auc"]) for r in history] == [(2, 0.7), (1, 0.6)]
    assert rows(runlog.run_metrics(spark, root, "r1")) == [("r1", "auc", 0.6)]


def test_lineage_is_cut_in_reliable_storage(spark):
    df = session.cut_lineage(spark.range(5))
    assert df.count() == 5
    assert "Scan ExistingRDD" in df._jdf.queryExecution().toString()
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and "/linegauge/x-" in a


def test_snapshots_are_seen_whole(spark, tmp_path):
    root = str(tmp_path / "features")
    rows = spark.createDataFrame([(1, "train", 2.0), (2, "train", None), (3, "07", 1.5)], "id long, split string, x double")
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root)
    assert snapshots.export(rows, root) == 1 and snapshots.export(rows.where("id < 3"), root) == 2
    assert snapshots.export(rows.limit(0), root) == 3
    assert snapshots.read(spark, root).isEmpty() and snapshots.manifest(spark, root).isEmpty()
    assert set(snapshots.read(spark, root).columns) == {"id", "split", "x"}
    listed = {r["split"]: r["n"] for r in snapshots.manifest(spark, root, 1).collect()}
    assert listed == {"train": 2, "07": 1}
    assert snapshots.read(spark, root, version=2).count() == 2
    assert [r["id"] for r in snapshots.read(spark, root, part="07", version=1).collect()] == [3]
    plan = snapshots.read(spark, root, part="07", version=1)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    for version in (1, 2, 3):
        snapshots.verify(spark, root, version=version)
    # a writer that stopped before its manifest
    rows.write.partitionBy("split").parquet(f"{root}/data-unfinished")
    assert snapshots.read(spark, root, version=2).count() == 2
    folder = snapshots._manifests(spark, root).where("version = 2").first()["folder"]
    rows.where("id = 1").write.mode("append").partitionBy("split").parquet(f"{root}/{folder}")
    with pytest.raises(snapshots.BrokenSnapshot):
        snapshots.verify(spark, root, version=2)
    with pytest.raises(ValueError):
        snapshots.export(rows.withColumn("split", F.when(F.col("id") > 1, F.col("split"))), root)
    assert snapshots.read(spark, root).isEmpty()
