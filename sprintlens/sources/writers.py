"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintlens import schemas


def write_by_key(df: DataFrame, path: str, *keys: str, replace_touched_only: bool = False) -> None:
    """Overwrite, partitioned by the keys.

    The rebalance hint groups rows of a key so that a small key gives one file, and lets
    adaptive execution split a key that holds a large share of the rows over many tasks.
    """
    mode = "dynamic" if replace_touched_only else "static"
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*keys)
        .parquet(path)
    )


def write_feature_table(df: DataFrame, path: str, tasks: int | None = None) -> None:
    """Year partitions, rows of a project together and sorted inside the files."""
    ranged = (
        df.repartitionByRange(tasks, "sprint_year", "project")
        if tasks
        else df.repartitionByRange("sprint_year", "project")
    )
    (
        ranged.sortWithinPartitions("sprint_year", "project")
        .write.mode("overwrite")
        .partitionBy("sprint_year")
        .parquet(path)
    )


def write_report(df: DataFrame, path: str) -> None:
    """Aggregated table as CSV with header (one file; its rows move to the writing task, the work before them does not)."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    df.repartition(1).write.mode("overwrite").json(path)


def metrics_long(df: DataFrame, run_id: str, role: str) -> DataFrame:
    """One row of metrics → run-log rows; numbers in `value`, text in `text`."""
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint", "boolean"}
    kinds = dict(df.dtypes)
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("key"),
                (F.col(c).cast("double") if kinds[c] in numeric else F.lit(None).cast("double")).alias("value"),
                (F.lit(None).cast("string") if kinds[c] in numeric else F.col(c).cast("string")).alias("text"),
            )
            for c in df.columns
        ]
    )
    return df.select(F.explode(entries).alias("e")).select(
        F.lit(run_id).alias("run_id"), F.lit(role).alias("role"), "e.key", "e.value", "e.text"
    )


def append_run_log(rows: DataFrame, path: str) -> None:
    rows.select(*[f.name for f in schemas.RUN_LOG]).write.mode("append").parquet(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
