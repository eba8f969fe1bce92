"""Cleaning jobs: module metrics, the two issue trackers, repository events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.functions import numeric as N
from sprintlens.functions import text as X
from sprintlens.operators.ranking import join_null_safe
from sprintlens.operators.shaping import (
    cast_present,
    first_present,
    normalise_names,
    rename_present,
)


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left-join a group aggregate back to its rows.

    Deliberately not a window over the keys: a window holds every row of a group on one
    task, whereas here the group is reduced by partial sums and the join side of a hot
    group is split by adaptive skew handling (or broadcast when the aggregate is small at
    run time).
    """
    if null_safe:
        return join_null_safe(rows, groups, keys, "left")
    return rows.join(groups, list(keys), "left")


# -- module metrics -------------------------------------------------------------


def defect_density(modules: DataFrame) -> DataFrame:
    """Per project and version: modules, defective modules, density to 4 digits."""
    return (
        modules.groupBy("project", "version")
        .agg(
            F.count(F.lit(1)).alias("total_modules"),
            F.sum("defect_flag").alias("defective_modules"),
        )
        .withColumn(
            "defect_density", N.ratio(F.col("defective_modules"), F.col("total_modules"), 4)
        )
    )


def flag_modules(raw: DataFrame, stem: Column) -> DataFrame:
    """Names, project and version from the file stem, metric casts, target as count and flag.

    Text targets TRUE/FALSE count as 1/0; rows without a target are left out.
    """
    df = normalise_names(raw)
    target = first_present(df, P.MODULE_TARGETS)
    df = cast_present(df, P.MODULE_METRICS)
    word = F.lower(F.trim(F.col(target).cast("string")))
    count = (
        F.when(word.isin("true", "yes"), 1.0)
        .when(word.isin("false", "no"), 0.0)
        .otherwise(F.col(target).try_cast("double"))
    )
    return (
        df.where(F.col(target).isNotNull())
        .withColumns({"project": X.module_project(stem), "version": X.module_version(stem)})
        .withColumn("bug_count", count)
        .withColumn("defect_flag", N.flag(F.col("bug_count") > 0))
    )


def silver_modules(raw: DataFrame, stem: Column) -> DataFrame:
    flagged = flag_modules(raw, stem)
    density = defect_density(flagged).drop("defective_modules")
    return attach(flagged, density, ["project", "version"])


# -- issue trackers -------------------------------------------------------------


def classify_tracker_a(issues: DataFrame) -> DataFrame:
    kind = first_present(issues, P.ISSUE_TYPE_COLUMNS)
    return (
        issues.dropna(subset=["key", "created"])
        .drop(*P.SPARSE_ISSUE_COLUMNS)
        .withColumns(
            {
                "created_ts": X.timestamp_of(issues, "created"),
                "resolution_ts": X.timestamp_of(issues, "resolutiondate"),
            }
        )
        .withColumns(
            {
                "cycle_time_days": F.datediff("resolution_ts", "created_ts"),
                "project": X.issue_project(F.col("key")),
                "issue_category": X.category_by_substring(F.col(kind)),
                "sprint": X.sprint_key(F.col("created_ts")),
            }
        )
    )


def sprint_ratio_a(classified: DataFrame) -> DataFrame:
    category = F.col("issue_category")
    return (
        classified.groupBy("project", "sprint")
        .agg(
            F.count_if(category == "bug").alias("num_bugs"),
            F.count_if(category.isin("story", "task")).alias("num_stories_tasks"),
            F.count(F.lit(1)).alias("total_issues"),
        )
        .withColumn("bug_story_ratio", N.ratio(F.col("num_bugs"), F.col("num_stories_tasks"), 3))
    )


def silver_tracker_a(issues: DataFrame) -> DataFrame:
    classified = classify_tracker_a(issues)
    ratios = sprint_ratio_a(classified).select("project", "sprint", "bug_story_ratio")
    return attach(classified, ratios, ["project", "sprint"])


def classify_tracker_b(raw: DataFrame, pattern: str = P.DAY_FIRST_FORMAT) -> DataFrame:
    df = rename_present(raw, P.TRACKER_B_NAMES).drop(*P.TRACKER_B_DROPPED)
    return (
        df.dropna(subset=["issue_key", "created_raw"])
        .withColumns(
            {
                "created_ts": X.timestamp_of(df, "created_raw", pattern),
                "resolved_ts": X.timestamp_of(df, "resolved_raw", pattern),
            }
        )
        .withColumns(
            {
                "cycle_time_days": F.datediff("resolved_ts", "created_ts"),
                "issue_category": X.category_by_name(F.col("issue_type")),
                "sprint": X.sprint_key(F.col("created_ts")),
            }
        )
        .drop("created_raw", "resolved_raw")
    )


def sprint_counts_b(classified: DataFrame) -> DataFrame:
    category = F.col("issue_category")
    return (
        classified.groupBy("project_key", "sprint")
        .agg(
            F.count_if(category == "bug").alias("num_bugs"),
            F.count_if(category == "story").alias("num_stories"),
            F.count_if(category == "task").alias("num_tasks"),
            F.count(F.lit(1)).alias("total_issues_sprint"),
        )
        .withColumn(
            "bug_story_ratio",
            N.ratio(F.col("num_bugs"), F.col("num_stories") + F.col("num_tasks"), 3),
        )
    )


def silver_tracker_b(raw: DataFrame, pattern: str = P.DAY_FIRST_FORMAT) -> DataFrame:
    classified = classify_tracker_b(raw, pattern)
    return attach(classified, sprint_counts_b(classified), ["project_key", "sprint"])


# -- repository events ----------------------------------------------------------


def flatten_events(raw: DataFrame) -> DataFrame:
    """Eight leaves of the nested event."""
    return raw.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.col("repo.name").alias("repo_name"),
        F.col("actor.login").alias("actor_login"),
        F.col("payload.ref").alias("payload_ref"),
        F.col("payload.action").alias("payload_action"),
        F.col("payload.pull_request.merged").alias("pr_merged"),
        F.col("created_at"),
    )


def relevant_events(events: DataFrame, prefix: str = P.OWNER_PREFIX) -> DataFrame:
    ts = X.timestamp_of(events, "created_at")
    return (
        events.where(F.col("repo_name").startswith(prefix))
        .where(F.col("event_type").isin(*P.RELEVANT_EVENTS))
        .withColumn("created_ts", ts)
        .withColumns(
            {
                "year": F.year("created_ts"),
                "month": F.month("created_ts"),
                "apache_project_key": X.repository_key(F.col("repo_name")),
            }
        )
        .drop("created_at")
    )


def delivery_monthly(
    relevant: DataFrame,
    branches: Sequence[str] = P.DEPLOY_BRANCHES,
    weeks: float = P.WEEKS_PER_MONTH,
) -> DataFrame:
    """Deployments and change failures per repository and month.

    One conditional aggregation stands for two aggregates and their full outer join: a
    side without rows is null, and a group with neither kind of event is absent.
    """
    push = (F.col("event_type") == "PushEvent") & F.col("payload_ref").isin(*branches)
    closed = (F.col("event_type") == "PullRequestEvent") & (F.col("payload_action") == "closed")
    merged = F.coalesce(F.col("pr_merged"), F.lit(False))
    grouped = relevant.groupBy("repo_name", "apache_project_key", "year", "month").agg(
        F.count_if(push).alias("pushes"),
        F.count_if(closed).alias("closed"),
        F.count_if(closed & merged).alias("merged"),
    )
    any_closed = F.col("closed") > 0
    unmerged = F.col("closed") - F.col("merged")
    return grouped.where((F.col("pushes") > 0) | any_closed).select(
        "repo_name",
        "apache_project_key",
        "year",
        "month",
        F.nullif("pushes", F.lit(0)).alias("push_count"),
        F.round(F.nullif("pushes", F.lit(0)) / F.lit(weeks), 3).alias("deploy_frequency_weekly"),
        F.nullif("closed", F.lit(0)).alias("total_prs_closed"),
        F.when(any_closed, F.col("merged")).alias("prs_merged"),
        F.when(any_closed, unmerged).alias("prs_not_merged"),
        N.ratio(unmerged, F.col("closed"), 4).alias("change_failure_rate"),
    )


def silver_delivery(raw: DataFrame) -> DataFrame:
    return delivery_monthly(relevant_events(flatten_events(raw)))
