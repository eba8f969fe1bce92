"""Parameters of the registered queries and the frames most of them start from.

The driver's orders run from 1995 to 2001, so years, split bounds and fold projects take
values that exist there; every operator has them as parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sprintlens.operators import features, gold, scoring, silver
from sprintlens.session import scratch_dir
from sprintlens.sources import readers, views, writers

YEARS = (1995, 2001)
BOUNDS = (1998, 1999, 2000)
REFERENCE_END = 1999
PROJECTS = ("C1", "C42", "C100", "C250", "C400")
INTERCEPT = 2.10
THRESHOLD = 0.24
CASES = (("tp", "C1"), ("tn", "C42"), ("fn", "C100"))
REPLICATES = 1000


def shown(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison between engines."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def silver_issues(spark: SparkSession, folder: str) -> DataFrame:
    return silver.classify_tracker_a(views.issues(spark, folder))


def tracker_b_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The issue view under the second tracker's names, dates as day-first text."""
    text = lambda c: F.date_format(F.col(c).cast("timestamp"), "dd/MM/yyyy HH:mm")
    return views.issues(spark, folder).select(
        F.col("key").alias("Issue key"),
        F.col("issuetype_name").alias("Issue Type"),
        F.col("status").alias("Status"),
        F.split_part("key", F.lit("-"), F.lit(1)).alias("Project key"),
        text("created").alias("Created"),
        text("resolutiondate").alias("Resolved"),
        F.lit(None).cast("string").alias("Assignee"),
    )


def silver_modules(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_modules(views.modules(spark, folder), F.col("basename"))


def relevant_events(spark: SparkSession, folder: str) -> DataFrame:
    return silver.relevant_events(silver.flatten_events(views.repository_events(spark, folder)))


def silver_delivery(spark: SparkSession, folder: str) -> DataFrame:
    return silver.delivery_monthly(relevant_events(spark, folder))


def sprints(spark: SparkSession, folder: str) -> DataFrame:
    return gold.build_sprint_features(silver_issues(spark, folder), years=YEARS)


def full_sprints(spark: SparkSession, folder: str) -> DataFrame:
    return gold.build_sprint_features(
        silver_issues(spark, folder),
        silver_modules(spark, folder),
        silver_delivery(spark, folder),
        years=YEARS,
    )


_GOLD_PATHS: dict[tuple[str, str], str] = {}


def gold_table(spark: SparkSession, folder: str) -> DataFrame:
    """The full sprint table, built from the raw tables once per application and folder.

    Everything after gold reads this written table (year partitions, pruned columns), as
    the pipeline does, instead of cleaning and joining the raw data again for every scan.
    It lies in the shared scratch folder, so losing executors costs nothing.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _GOLD_PATHS:
        path = scratch_dir(spark, "sprint-features")
        writers.write_feature_table(full_sprints(spark, folder), path)
        _GOLD_PATHS[key] = path
    return readers.read_gold(spark, _GOLD_PATHS[key])


def matrix(spark: SparkSession, folder: str) -> DataFrame:
    return features.feature_matrix(gold_table(spark, folder), YEARS, BOUNDS)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.closed_form_score(matrix(spark, folder), INTERCEPT, 6)
