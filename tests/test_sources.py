import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from sprintlens import schemas
from sprintlens.functions import text as X
from sprintlens.operators import silver
from sprintlens.session import scratch_dir
from sprintlens.sources import readers, writers


def test_csv_union_binds_by_name(spark, tmp_path):
    (tmp_path / "ant").mkdir()
    (tmp_path / "ant" / "ant-1.3.csv").write_text("WMC,dit,bug\n1,2,1\n")
    (tmp_path / "ant" / "ant-1.4.csv").write_text("dit,wmc,loc,bug\n5,6,7,0\n")
    raw = readers.read_module_csvs(spark, str(tmp_path))
    out = silver.silver_modules(raw, X.file_stem(F.col("_file_path"))).orderBy("version").collect()
    assert [(r["project"], r["version"], r["wmc"], r["dit"], r["loc"], r["defect_flag"]) for r in out] == [
        ("ant", "1.3", 1.0, 2.0, None, 1), ("ant", "1.4", 6.0, 5.0, 7.0, 0),
    ]


def test_csv_header_of_a_large_file_is_its_first_line(spark, tmp_path):
    with open(tmp_path / "big-1.csv", "w") as f:
        f.write("wmc,bug\n")
        f.writelines(f"{i},{i % 2}\n" for i in range(50_000))
    assert [r["header"] for r in readers.csv_headers(spark, str(tmp_path)).collect()] == ["wmc,bug"]
    assert readers.read_module_csvs(spark, str(tmp_path)).count() == 50_000


def test_no_files_is_an_error(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception):
        readers.read_module_csvs(spark, str(tmp_path / "empty")).count()


def test_nested_events(spark, tmp_path):
    event = {
        "id": "1", "type": "PushEvent", "repo": {"name": "apache/camel"}, "actor": {"login": "u"},
        "payload": {"ref": "refs/heads/main", "extra": {"deep": 1}}, "created_at": "2022-01-01T00:01:39Z",
    }
    with gzip.open(tmp_path / "2022-01-01-0.json.gz", "wt") as f:
        f.write(json.dumps(event) + "\n")
    out = silver.silver_delivery(readers.read_repository_events(spark, str(tmp_path))).collect()
    assert [(r["repo_name"], r["push_count"], r["prs_merged"]) for r in out] == [("apache/camel", 1, None)]


def test_merged_parquet(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "k int, x string").write.parquet(f"{tmp_path}/p1.parquet")
    spark.createDataFrame([(2, "b")], "k int, y string").write.parquet(f"{tmp_path}/p2.parquet")
    df = readers.read_merged_parquet(spark, f"{tmp_path}/*.parquet")
    assert set(df.columns) == {"k", "x", "y"} and df.count() == 2


def test_partitioned_write_and_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).select((F.col("id") % 2 + 2000).cast("int").alias("year"), F.lit(1).alias("month"), "id")
    writers.write_by_key(df, path, "year", "month")
    assert sorted(f for f in os.listdir(path) if f.startswith("year")) == ["year=2000", "year=2001"]
    table = readers.register_external(spark, "ext_t", path).where("year = 2001")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert table.count() == 50
    writers.write_by_key(df.where("year = 2001").limit(3), path, "year", "month", replace_touched_only=True)
    assert spark.read.parquet(path).groupBy("year").count().orderBy("year").collect() == [(2000, 50), (2001, 3)]


def test_hot_key_is_written_by_several_tasks(spark, tmp_path):
    """Two thirds of the rows share a key; with a small advisory size its partition is split."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.range(60_000).repartition(6).select(
            F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        writers.write_by_key(df, str(tmp_path / "t"), "key")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = [f for f in os.listdir(tmp_path / "t" / "key=hot") if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_reports_and_run_log(spark, tmp_path):
    summary = spark.createDataFrame([(0.9, 12, "isotonic", True)], "f2 double, tp bigint, method string, ok boolean")
    writers.write_report(summary, str(tmp_path / "csv"))
    writers.write_summary(summary, str(tmp_path / "json"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["method"] == "isotonic"
    assert readers.read_metric_document(spark, str(tmp_path / "json")).first()["tp"] == 12
    log = str(tmp_path / "log")
    for run in ("r1", "r2"):
        writers.append_run_log(writers.metrics_long(summary, run, "final"), log)
    rows = spark.read.parquet(log)
    assert rows.columns == [f.name for f in schemas.RUN_LOG] and rows.count() == 8
    assert rows.where("run_id = 'r1' and key = 'method'").first()["text"] == "isotonic"
    found = readers.run_evidence(rows, "r1", {"f2": 0.1, "absent": 0.5}).first()
    assert (found["f2"], found["absent"]) == (0.9, 0.5)


def test_scratch_follows_the_session_setting():
    class Session:
        conf = {"spark.checkpoint.dir": "hdfs://shared/ck/"}

    first, second = (scratch_dir(Session, "x") for _ in range(2))
    assert first.startswith("hdfs://shared/ck/x-") and first != second


def test_a_cluster_without_the_setting_is_refused():
    class Session:
        conf = {}

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError):
        scratch_dir(Session, "x")
