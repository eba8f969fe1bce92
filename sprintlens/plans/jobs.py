"""The batch jobs: raw folders → cleaned tables → sprint table.

    spark-submit -m sprintlens.plans.jobs modules   RAW OUT
    spark-submit -m sprintlens.plans.jobs tracker_a RAW OUT
    spark-submit -m sprintlens.plans.jobs tracker_b RAW OUT
    spark-submit -m sprintlens.plans.jobs delivery  RAW OUT
    spark-submit -m sprintlens.plans.jobs gold      ISSUES MODULES DELIVERY OUT

Each job is one write action; row accounting rides on it as an observation instead of
extra counts over the source. The cleaning jobs work in a session of their own: a session
that has held observations cannot be captured by fitted models any more.
"""

from __future__ import annotations

import sys

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.functions import text as X
from sprintlens.operators import gold, shaping, silver
from sprintlens.session import build_session
from sprintlens.sources import readers, writers


def modules(spark: SparkSession, raw: str, out: str) -> dict:
    """CSV folders → modules partitioned by project; returns rows written and defective."""
    spark, seen = spark.newSession(), Observation("modules")
    table = silver.silver_modules(readers.read_module_csvs(spark, raw), X.file_stem(F.col("_file_path")))
    observed = table.drop("_file_path").observe(
        seen, F.count(F.lit(1)).alias("rows"), F.sum("defect_flag").alias("defective")
    )
    writers.write_by_key(observed, out, "project")
    return seen.get


def tracker_a(spark: SparkSession, raw: str, out: str) -> dict:
    spark, seen = spark.newSession(), Observation("tracker_a")
    table = silver.silver_tracker_a(readers.read_issues(spark, raw)).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("created_ts").isNull()).alias("null_created"),
        F.count_if(F.col("resolution_ts").isNull()).alias("null_resolved"),
    )
    writers.write_by_key(table, out, "project")
    return seen.get


def tracker_b(spark: SparkSession, *paths: str) -> dict:
    """Raw path(s) or globs, then the output path."""
    *raw, out = paths
    spark, seen = spark.newSession(), Observation("tracker_b")
    table = silver.silver_tracker_b(readers.read_merged_parquet(spark, *raw)).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("created_ts").isNull()).alias("null_created"),
        F.count_if(F.col("resolved_ts").isNull()).alias("null_resolved"),
    )
    writers.write_by_key(table, out, "project_key")
    return seen.get


def delivery(spark: SparkSession, raw: str, out: str) -> dict:
    """Event log → monthly delivery metrics; events before and after the owner filter."""
    spark, seen = spark.newSession(), Observation("delivery")
    flat = silver.flatten_events(readers.read_repository_events(spark, raw))
    counted = shaping.counted_filter(flat, F.col("repo_name").startswith(P.OWNER_PREFIX), seen)
    writers.write_by_key(silver.delivery_monthly(silver.relevant_events(counted)), out, "year", "month")
    return seen.get


def gold_table(spark: SparkSession, issues: str, module_table: str, delivery_table: str, out: str) -> dict:
    """Counted on the written table: range partitioning samples its input, which would be observed twice."""
    table = gold.build_sprint_features(
        readers.read_issues(spark, issues),
        readers.register_external(spark, "ext_silver_modules", module_table),
        readers.register_external(spark, "ext_silver_delivery", delivery_table),
    )
    writers.write_feature_table(table, out)
    written = readers.read_gold(spark, out)
    return written.agg(F.count(F.lit(1)).alias("rows"), F.avg(P.LABEL).alias("positive_rate")).first().asDict()


JOBS = {"modules": modules, "tracker_a": tracker_a, "tracker_b": tracker_b, "delivery": delivery, "gold": gold_table}

if __name__ == "__main__":
    name, *paths = sys.argv[1:]
    print(name, JOBS[name](build_session(f"sprintlens-{name}"), *paths))
