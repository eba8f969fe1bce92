"""One row per project and sprint, with the escaped-defect label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.functions import numeric as N
from sprintlens.functions import text as X


def sprint_spine(issues: DataFrame, escape_days: int = P.ESCAPE_DAYS) -> DataFrame:
    """Counts, unrounded ratio, mean non-negative cycle time and label in one aggregation."""
    category, cycle = F.col("issue_category"), F.col("cycle_time_days")
    bug = category == "bug"
    escaped = bug & ((cycle > escape_days) | cycle.isNull())
    return (
        issues.where(F.col("project").isNotNull() & F.col("sprint").isNotNull())
        .groupBy("project", "sprint")
        .agg(
            F.count_if(bug).alias("num_bugs_sprint"),
            F.count_if(category == "story").alias("num_stories_sprint"),
            F.count_if(category == "task").alias("num_tasks_sprint"),
            F.count(F.lit(1)).alias("total_issues_sprint"),
            F.avg(F.when(cycle >= 0, cycle.cast("double"))).alias("avg_cycle_time_days"),
            F.coalesce(F.max(escaped.cast("int")), F.lit(0)).alias(P.LABEL),
        )
        .withColumns(
            {
                "bug_story_ratio": N.ratio(
                    F.col("num_bugs_sprint"),
                    F.col("num_stories_sprint") + F.col("num_tasks_sprint"),
                ),
                "sprint_year": X.sprint_part(F.col("sprint"), 0),
                "sprint_month": X.sprint_part(F.col("sprint"), 1),
            }
        )
    )


def modules_by_project(modules: DataFrame) -> DataFrame:
    names = ("wmc", "dit", "cbo", "rfc", "lcom", "loc")
    return (
        modules.where(F.col("project").isNotNull())
        .groupBy(F.upper("project").alias("project"))
        .agg(
            *[F.avg(c).alias(f"avg_{c}") for c in names],
            F.avg("defect_density").alias("defect_density"),
        )
    )


def mean_of_rounded(name: str, scale: int) -> Column:
    """Mean of values rounded to `scale` digits, summed as decimals.

    The sum is exact, so the mean does not depend on the order in which partial sums
    arrive and equal projects get equal values on every run.
    """
    exact = F.sum(F.col(name).cast(f"decimal(18,{scale})")).cast("double")
    return N.ratio(exact, F.count(name))


def delivery_by_project(delivery: DataFrame, *grain: Column) -> DataFrame:
    """Unweighted means over months and totals; extra grain columns give the month variant."""
    return (
        delivery.where(F.col("apache_project_key").isNotNull())
        .groupBy(F.col("apache_project_key").alias("project"), *grain)
        .agg(
            mean_of_rounded("deploy_frequency_weekly", 3).alias("deploy_frequency_weekly"),
            mean_of_rounded("change_failure_rate", 4).alias("change_failure_rate"),
            F.sum(F.col("push_count").cast("bigint")).alias("total_pushes_2022"),
            F.sum(F.col("total_prs_closed").cast("bigint")).alias("total_prs_2022"),
        )
    )


def build_sprint_features(
    issues: DataFrame,
    modules: DataFrame | None = None,
    delivery: DataFrame | None = None,
    years: tuple[int, int] = P.GOLD_YEARS,
    month_grain: bool = False,
    tracker_b: DataFrame | None = None,
) -> DataFrame:
    """Spine left-joined to project-level code metrics and delivery metrics.

    The side tables grow with the number of projects, so they carry no broadcast hint:
    adaptive execution broadcasts them when their measured size allows and sort-merges
    otherwise. The year filter comes before the joins. `month_grain` also matches delivery
    on year and month; `tracker_b` adds the second tracker's ratio on project and sprint.
    """
    spine = sprint_spine(issues).where(F.col("sprint_year").between(*years))
    code_names = [f"avg_{c}" for c in ("wmc", "dit", "cbo", "rfc", "lcom", "loc")] + ["defect_density"]
    delivery_names = ("deploy_frequency_weekly", "change_failure_rate")
    if modules is not None:
        spine = spine.join(modules_by_project(modules), "project", "left")
    else:
        spine = spine.withColumns({c: F.lit(None).cast("double") for c in code_names})
    if delivery is not None and month_grain:
        side = delivery_by_project(
            delivery,
            F.col("year").cast("bigint").alias("sprint_year"),
            F.col("month").cast("bigint").alias("sprint_month"),
        )
        spine = spine.join(side, ["project", "sprint_year", "sprint_month"], "left")
    elif delivery is not None:
        spine = spine.join(delivery_by_project(delivery), "project", "left")
    else:
        spine = spine.withColumns(
            {c: F.lit(None).cast("double") for c in delivery_names}
            | {c: F.lit(None).cast("bigint") for c in ("total_pushes_2022", "total_prs_2022")}
        )
    extra = []
    if tracker_b is not None:
        side = tracker_b.groupBy(F.col("project_key").alias("project"), "sprint").agg(
            F.max("bug_story_ratio").alias("tracker_b_ratio")
        )
        spine = spine.join(side, ["project", "sprint"], "left")
        extra = ["tracker_b_ratio"]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return spine.select(
        F.concat("project", F.lit("_"), "sprint").alias("sprint_id"),
        "project",
        "sprint",
        zero("sprint_year"),
        zero("sprint_month"),
        *code_names,
        "bug_story_ratio",
        "avg_cycle_time_days",
        "num_bugs_sprint",
        "num_stories_sprint",
        "num_tasks_sprint",
        "total_issues_sprint",
        *delivery_names,
        zero("total_pushes_2022"),
        zero("total_prs_2022"),
        P.LABEL,
        *extra,
    )
