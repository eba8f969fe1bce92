"""Profiling aggregates: balance, correlations, distributions, frequencies, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintlens.functions import numeric as N
from sprintlens.operators.features import to_long
from sprintlens.operators.ranking import collapse, exact_percentiles, percentiles_from_totals, running_totals
from sprintlens.operators.shaping import with_row


def distribution(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.5, 0.75, 0.9)) -> DataFrame:
    """Per column: n, min, exact percentiles, mean, max of the non-negative, non-null values."""
    long = to_long(df, columns).where(F.col("value") >= 0)
    counts = collapse(long, "value", ["feature"], n_rows=F.lit(1))
    totals = running_totals(counts, "value", ["n_rows"], ["feature"])
    moments = counts.groupBy("feature").agg(
        F.min("value").alias("min"),
        N.ratio(F.sum(F.col("value") * F.col("n_rows")), F.sum("n_rows")).alias("mean"),
        F.max("value").alias("max"),
    )
    ranked = percentiles_from_totals(totals, "value", "n_rows", probs, ["feature"])
    # Both sides hold one row per listed column.
    return moments.join(ranked, "feature").select(
        "feature",
        "n",
        "min",
        *[F.col("percentiles")[i].alias(f"p{round(q * 100)}") for i, q in enumerate(probs)],
        "mean",
        "max",
    )


def cycle_time_summary(issues: DataFrame, column: str = "cycle_time_days") -> DataFrame:
    """One row: total, resolved and their share, percentiles, mean, max (negatives left out)."""
    probs = (0.25, 0.5, 0.75, 0.9)
    spread = distribution(issues, [column], probs)
    totals = issues.agg(F.count(F.lit(1)).alias("total"), F.count(column).alias("resolved"))
    return with_row(spread, "t", totals).select(
        "t.total",
        "t.resolved",
        N.ratio(F.col("t.resolved"), F.col("t.total")).alias("coverage"),
        *[f"p{round(q * 100)}" for q in probs],
        "mean",
        "max",
    )


def class_balance(df: DataFrame, flag: str) -> DataFrame:
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"))


def target_correlation(df: DataFrame, metrics: Sequence[str], target: str) -> DataFrame:
    """Correlation of each metric with the target, highest first; one aggregation."""
    return (
        df.agg(*[F.corr(F.col(m).cast("double"), F.col(target).cast("double")).alias(m) for m in metrics])
        .unpivot([], list(metrics), "metric", "correlation")
        .orderBy(F.col("correlation").desc_nulls_last(), "metric")
    )


def metric_stats(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean, exact median and maximum per metric."""
    long = to_long(df, metrics)
    medians = exact_percentiles(long, "value", [0.5], ["feature"])
    moments = long.groupBy("feature").agg(F.avg("value").alias("mean"), F.max("value").alias("max"))
    return moments.join(medians, "feature").select(
        F.col("feature").alias("metric"), "mean", F.col("percentiles")[0].alias("median"), "max"
    )


def collection_profile(df: DataFrame, name: str) -> DataFrame:
    """One row: rows, columns, columns without any null."""
    full = sum((F.when(F.count(c) == F.count(F.lit(1)), 1).otherwise(0) for c in df.columns), F.lit(0))
    return df.agg(
        F.lit(name).alias("collection"),
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        full.alias("full_columns"),
    )


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for several columns in one pass."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def status_transitions(change_log: DataFrame, field: str = "status") -> DataFrame:
    return (
        change_log.select(F.explode("items").alias("item"))
        .where(F.col("item.field") == field)
        .groupBy(F.col("item.to").alias("status"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def table_meta(df: DataFrame, distinct: Sequence[str], ts: str) -> DataFrame:
    """Rows, columns, distinct values of the key columns, first and last timestamp.

    Rows are first reduced to the combinations of the key columns, so the distinct counts
    do not multiply the input.
    """
    reduced = df.groupBy(*distinct).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi")
    )
    return reduced.agg(
        F.sum("n").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        *[F.countDistinct(c).alias(f"distinct_{c}") for c in distinct],
        F.min("lo").alias("first_ts"),
        F.max("hi").alias("last_ts"),
    )


def top_counts(df: DataFrame, key: str, limit: int, condition: Column | None = None) -> DataFrame:
    """Most frequent keys (ties by key), optionally of the rows meeting a condition."""
    rows = df if condition is None else df.where(condition)
    return (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), key)
        .limit(limit)
    )


def events_by_hour(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("events"))


def issues_by_year(df: DataFrame, ts: str = "created_ts") -> DataFrame:
    return df.groupBy(F.year(ts).alias("year")).agg(F.count(F.lit(1)).alias("issues"))


def merge_rate(relevant: DataFrame) -> DataFrame:
    """One row: pull requests, merged, closed without merge, failure rate."""
    pr = F.col("event_type") == "PullRequestEvent"
    closed = pr & (F.col("payload_action") == "closed")
    merged = F.coalesce(F.col("pr_merged"), F.lit(False))
    counts = relevant.agg(
        F.count_if(pr).alias("total_prs"),
        F.count_if(closed & merged).alias("prs_merged"),
        F.count_if(closed & ~merged).alias("prs_not_merged"),
    )
    return counts.withColumn(
        "cfr", N.ratio(F.col("prs_not_merged"), F.col("prs_merged") + F.col("prs_not_merged"))
    )


def coverage(df: DataFrame, groups: dict[str, str]) -> DataFrame:
    """Share of rows with a value, per named source column."""
    return df.agg(
        *[F.avg(F.col(c).isNotNull().cast("double")).alias(name) for name, c in groups.items()]
    ).unpivot([], list(groups), "source", "share")
