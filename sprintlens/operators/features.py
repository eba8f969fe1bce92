"""Feature engineering, temporal splits, folds, what-if rows, weights, oversampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.functions import numeric as N
from sprintlens.operators.ranking import exact_percentiles
from sprintlens.operators.shaping import with_row

MONTH_ANGLE = "2 * pi() * {} / 12"


def engineer_features(df: DataFrame) -> DataFrame:
    """Missing flags first, then logs, cyclic month, bug density and the interaction."""
    filled = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return df.withColumns(
        {
            "bsr_missing": F.col("bug_story_ratio").isNull().cast("int"),
            "cycle_missing": F.col("avg_cycle_time_days").isNull().cast("int"),
            "dora_missing": F.col("deploy_frequency_weekly").isNull().cast("int"),
            "log_avg_cycle_time": F.log1p(filled("avg_cycle_time_days")),
            "log_bug_story_ratio": F.log1p(filled("bug_story_ratio")),
            "log_total_issues": F.log1p("total_issues_sprint"),
            "sprint_month_sin": F.sin(F.expr(MONTH_ANGLE.format("sprint_month"))),
            "sprint_month_cos": F.cos(F.expr(MONTH_ANGLE.format("sprint_month"))),
            "bugs_per_issue": F.col("num_bugs_sprint")
            / F.greatest(F.col("total_issues_sprint"), F.lit(1)),
        }
    ).withColumn("log_cycle_x_bsr", F.col("log_avg_cycle_time") * F.col("log_bug_story_ratio"))


def temporal_split(
    df: DataFrame,
    train_end: int = P.TRAIN_END,
    cal_end: int = P.CAL_END,
    val_end: int = P.VAL_END,
    year: str = "sprint_year",
) -> DataFrame:
    """Adds `split`: train, cal, val or test by year, without overlap."""
    y = F.col(year)
    return df.withColumn(
        "split",
        F.when(y <= train_end, "train")
        .when(y <= cal_end, "cal")
        .when(y <= val_end, "val")
        .when(y > val_end, "test"),
    )


def feature_matrix(
    gold: DataFrame, years: tuple[int, int] = P.FEATURE_YEARS, bounds: Sequence[int] | None = None
) -> DataFrame:
    """Year range, features and split in one frame; a filter on `split` gives each part."""
    ranged = gold.where(F.col("sprint_year").between(*years))
    return temporal_split(engineer_features(ranged), *(bounds or ()))


def folds(train: DataFrame, projects: Sequence[str] = P.FOLD_PROJECTS) -> list[tuple[str, DataFrame, DataFrame]]:
    """(project, rows without it, rows of it); projects without rows are left out."""
    present = {
        r["project"]
        for r in train.where(F.col("project").isin(*projects)).select("project").distinct().collect()
    }
    return [
        (p, train.where(F.col("project") != p), train.where(F.col("project") == p))
        for p in projects
        if p in present
    ]


def fold_sizes(train: DataFrame, projects: Sequence[str] = P.FOLD_PROJECTS) -> DataFrame:
    """Held-out and training size of every fold in one pass over the rows."""
    whole = train.agg(F.count(F.lit(1)).alias("all_rows"))
    held = (
        train.where(F.col("project").isin(*projects))
        .groupBy("project")
        .agg(
            F.count(F.lit(1)).alias("test_rows"),
            F.avg(P.LABEL).alias("test_pos_rate"),
        )
    )
    return held.select(
        "project",
        (whole.scalar() - F.col("test_rows")).alias("train_rows"),
        "test_rows",
        "test_pos_rate",
    )


def split_profile(df: DataFrame, label: str = P.LABEL) -> DataFrame:
    """Rows, share, year range and positive rate of each split."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count(F.lit(1)) / F.max(total)).alias("share"),
        F.min("sprint_year").alias("first_year"),
        F.max("sprint_year").alias("last_year"),
        F.avg(label).alias("pos_rate"),
    )


def feature_stats(df: DataFrame, features: Sequence[str] = P.FEATURES, by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per feature, long form."""
    return to_long(df, features, by).groupBy(*by, "feature").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def to_long(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep.., feature, value) with null values left out."""
    return (
        df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])
        .unpivot(list(keep), list(features), "feature", "value")
        .where(F.col("value").isNotNull())
    )


# -- what-if rows ---------------------------------------------------------------


def _what_if(df: DataFrame, bsr, total, bsr_missing, cycle_missing, deploy, cfr, dora_missing) -> DataFrame:
    cycle_log = F.log1p(F.greatest(F.coalesce(F.col("cycle"), F.lit(0.0)), F.lit(0.0)))
    bsr_log = F.log1p(F.greatest(bsr, F.lit(0.0)))
    return df.withColumns(
        {
            "num_bugs_sprint": F.col("bugs").cast("double"),
            "num_stories_sprint": F.col("stories").cast("double"),
            "num_tasks_sprint": F.col("tasks").cast("double"),
            "total_issues_sprint": total.cast("double"),
            "log_avg_cycle_time": cycle_log,
            "log_bug_story_ratio": bsr_log,
            "log_total_issues": F.log1p(total),
            "sprint_year": F.col("year").cast("double"),
            "sprint_month_sin": F.sin(F.expr(MONTH_ANGLE.format("month"))),
            "sprint_month_cos": F.cos(F.expr(MONTH_ANGLE.format("month"))),
            "deploy_frequency_weekly": deploy,
            "change_failure_rate": cfr,
            "bsr_missing": N.flag(bsr_missing),
            "cycle_missing": N.flag(cycle_missing),
            "dora_missing": dora_missing,
            "bugs_per_issue": F.col("bugs") / total,
            "log_cycle_x_bsr": cycle_log * bsr_log,
        }
    )


def what_if_app(df: DataFrame) -> DataFrame:
    """Rows (bugs, stories, tasks, cycle, year, month): ratio over stories, no delivery data."""
    stories = F.col("stories")
    total = F.greatest(F.col("bugs") + stories + F.col("tasks"), F.lit(1))
    bsr = F.when(stories > 0, F.col("bugs") / stories).otherwise(0.0)
    cycle = F.coalesce(F.col("cycle"), F.lit(0.0))
    return _what_if(df, bsr, total, stories == 0, cycle == 0, F.lit(0.0), F.lit(0.0), F.lit(1))


def what_if_dashboard(df: DataFrame) -> DataFrame:
    """Same inputs plus deploy and cfr: ratio over stories and tasks, negatives clipped to 0."""
    clip = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0))
    raw_total = F.greatest(F.col("bugs") + F.col("stories") + F.col("tasks"), F.lit(1))
    df = df.withColumns({"__total": raw_total} | {c: clip(c) for c in ("bugs", "stories", "tasks")})
    bsr = F.col("bugs") / F.greatest(F.col("stories") + F.col("tasks"), F.lit(1))
    positive = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0))
    return _what_if(
        df,
        bsr,
        F.col("__total"),
        (F.col("bugs") == 0) | (F.col("stories") == 0),
        F.col("cycle").isNull(),
        positive("deploy"),
        positive("cfr"),
        F.col("deploy").isNull().cast("int"),
    ).drop("__total")


# -- class balance and imputation -------------------------------------------------


def class_weights(df: DataFrame, label: str = P.LABEL) -> DataFrame:
    """Per class: rows and n / (2 * rows); positive weight neg/pos on both rows (at most two)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    totals = df.agg(
        F.count(F.lit(1)).alias("n"),
        N.ratio(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).alias("pos_weight"),
    )
    return with_row(counts, "t", totals).select(
        label,
        "rows",
        N.ratio(F.col("t.n"), 2 * F.col("rows")).alias("weight"),
        F.col("t.pos_weight").alias("scale_pos_weight"),
    )


def add_balanced_weight(df: DataFrame, label: str = P.LABEL) -> DataFrame:
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("p"))
    mine = F.when(F.col(label) == 1, F.col("__t.p")).otherwise(F.col("__t.n") - F.col("__t.p"))
    return with_row(df, "__t", stats).withColumn("weight", N.ratio(F.col("__t.n"), 2 * mine)).drop("__t")


def impute_and_scale(df: DataFrame, features: Sequence[str], id_columns: Sequence[str]) -> DataFrame:
    """Exact-median imputation, then (x - mean) / sample deviation of the imputed column.

    The medians come from the chunked percentile operator; the two lookup maps hold one
    entry per feature.
    """
    medians = exact_percentiles(to_long(df, features), "value", [0.5], ["feature"])
    by_feature = medians.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.get("percentiles", F.lit(0))))).alias("of")
    )
    imputed = with_row(df, "__median", by_feature).select(
        *id_columns,
        *[
            F.coalesce(F.col(f).cast("double"), F.try_element_at("__median.of", F.lit(f)), F.lit(0.0)).alias(f)
            for f in features
        ],
    )
    moments = imputed.agg(
        *[F.avg(f).alias(f"m_{f}") for f in features],
        *[F.stddev_samp(f).alias(f"s_{f}") for f in features],
    )
    return with_row(imputed, "__x", moments).select(
        *id_columns,
        *[
            F.coalesce(N.ratio(F.col(f) - F.col(f"__x.m_{f}"), F.col(f"__x.s_{f}")), F.lit(0.0)).alias(f)
            for f in features
        ],
    )
