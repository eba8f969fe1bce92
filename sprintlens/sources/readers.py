"""Scans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprintlens import params as P
from sprintlens import schemas
from sprintlens.operators.shaping import normalise_names


def csv_headers(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(header, files): first line of every file, files grouped by equal headers.

    Only the first split of a file can hold its header. Row ids grow in reading order
    within a task, so the row with the lowest id of that split is the first line. What
    the driver learns later are file names, as with any file listing.
    """
    lines = (
        spark.read.option("recursiveFileLookup", recursive)
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
        .where(F.col("start") == 0)
        .withColumn("line", F.monotonically_increasing_id())
    )
    first = lines.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    return first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))


def read_module_csvs(spark: SparkSession, path: str, file_column: str = "_file_path") -> DataFrame:
    """CSV files with differing headers as one frame: columns matched by name, absent ones null.

    Files are read once per distinct header with an explicit text schema, so a file whose
    columns are ordered differently is never bound by position to another file's header.
    """
    parts = []
    for row in csv_headers(spark, path).orderBy("header").collect():
        names = [n.strip().strip('"') for n in row["header"].split(",")]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        part = spark.read.option("header", True).schema(schema).csv(row["files"])
        parts.append(
            normalise_names(part.select("*", F.col("_metadata.file_path").alias(file_column)))
        )
    if not parts:
        raise ValueError(f"no csv files below {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_merged_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files whose columns differ, as one frame."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def read_repository_events(spark: SparkSession, path: str, glob: str = "*.json.gz") -> DataFrame:
    """Nested events from gzipped JSON lines.

    A gzip file is one task. The operators after it filter and sum map-side, so the raw
    events are not shuffled just to spread them.
    """
    return (
        spark.read.schema(schemas.REPOSITORY_EVENTS)
        .option("pathGlobFilter", glob)
        .json(path)
    )


def register_external(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Hive-partitioned Parquet as a temporary table; partition columns from the folders."""
    df = spark.read.option("basePath", path).parquet(path)
    df.createOrReplaceTempView(name)
    return df


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """The written sprint table; the year comes from the folder name and is widened again."""
    return spark.read.parquet(path).withColumn("sprint_year", F.col("sprint_year").cast("bigint"))


FEATURE_TABLE_COLUMNS = (
    "sprint_id", "project", "sprint", "sprint_year", "sprint_month",
    "num_bugs_sprint", "num_stories_sprint", "num_tasks_sprint",
    "total_issues_sprint", "bug_story_ratio", "avg_cycle_time_days",
    "deploy_frequency_weekly", "change_failure_rate",
    "avg_wmc", "avg_cbo", "avg_rfc", "avg_lcom", "avg_loc",
    P.LABEL,
)


def read_feature_table(
    spark: SparkSession, path: str, years: tuple[int, int] = P.FEATURE_YEARS,
    columns: Sequence[str] = FEATURE_TABLE_COLUMNS,
) -> DataFrame:
    """Nineteen columns of the year range; the range prunes the year partitions."""
    return read_gold(spark, path).where(F.col("sprint_year").between(*years)).select(*columns)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_metric_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def run_evidence(log: DataFrame, run_id: str, defaults: dict[str, float]) -> DataFrame:
    """One row: the metric of each key in a run, or the key's default."""
    mine = log.where((F.col("run_id") == run_id) & F.col("key").isin(*defaults))
    return mine.agg(
        *[
            F.coalesce(F.max(F.when(F.col("key") == k, F.col("value"))), F.lit(float(v))).alias(k)
            for k, v in defaults.items()
        ]
    )


def load_model(path: str):
    return PipelineModel.load(path)
