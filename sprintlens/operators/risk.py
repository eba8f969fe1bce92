"""Risk levels, snapshot tables, score histogram, sensitivity."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.functions import numeric as N
from sprintlens.functions import text as X
from sprintlens.operators.features import what_if_app


def risk_level(p: Column, threshold: float = P.OPERATING_THRESHOLD) -> Column:
    return F.when(p >= P.HIGH_RISK, "alto").when(p >= threshold, "medio").otherwise("bajo")


def risk_snapshot(scored: DataFrame, drivers: DataFrame, threshold: float = P.OPERATING_THRESHOLD) -> DataFrame:
    """One row per scored sprint with level and its two drivers."""
    return scored.join(drivers, "sprint_id", "left").select(
        "sprint_id",
        "project",
        "sprint_year",
        F.col("p").alias("probabilidad"),
        risk_level(F.col("p"), threshold).alias("riesgo_categoria"),
        "num_bugs_sprint",
        "driver_1",
        "driver_2",
    )


def riskiest(
    snapshot: DataFrame, project: str = "ALL", year: int | str = "ALL", level: str = "ALL", limit: int = 30
) -> DataFrame:
    """The `limit` riskiest sprints after the optional filters, with display columns."""
    for column, wanted in (("project", project), ("sprint_year", year), ("riesgo_categoria", level)):
        if wanted != "ALL":
            snapshot = snapshot.where(F.col(column) == wanted)
    top = snapshot.orderBy(F.col("probabilidad").desc(), "sprint_id").limit(limit)
    return top.select(
        X.labelled(F.col("riesgo_categoria"), P.RISK_SYMBOLS).alias("semaforo"),
        "sprint_id",
        "project",
        "sprint_year",
        F.round(F.col("probabilidad") * 100, 1).alias("prob_pct"),
        "num_bugs_sprint",
        X.labelled(F.col("driver_1"), P.FEATURE_LABELS).alias("driver1"),
        X.labelled(F.col("driver_2"), P.FEATURE_LABELS).alias("driver2"),
    )


def risk_by(snapshot: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Mean score, high-risk count and rows per key; with a limit, the riskiest keys."""
    table = snapshot.groupBy(key).agg(
        F.avg("probabilidad").alias("prob_media"),
        F.count_if(F.col("riesgo_categoria") == "alto").alias("n_alto"),
        F.count("riesgo_categoria").alias("n_total"),
    )
    return table if limit is None else table.orderBy(F.col("prob_media").desc(), key).limit(limit)


def level_totals(snapshot: DataFrame) -> DataFrame:
    """Rows and share of each level, all three levels listed."""
    wide = snapshot.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("riesgo_categoria") == level).alias(level) for level in P.RISK_SYMBOLS],
    )
    return wide.unpivot("n", list(P.RISK_SYMBOLS), "riesgo_categoria", "rows").select(
        "riesgo_categoria", "rows", N.ratio(F.col("rows"), F.col("n")).alias("share")
    )


def score_histogram(snapshot: DataFrame, per_unit: int = 50, threshold: float = P.OPERATING_THRESHOLD) -> DataFrame:
    """Counts per level band and bin of width 1/per_unit."""
    p = F.col("probabilidad")
    return snapshot.groupBy(
        risk_level(p, threshold).alias("band"), F.floor(p * per_unit).cast("int").alias("bin")
    ).agg(F.count(F.lit(1)).alias("n"))


def bug_sensitivity(
    inputs: DataFrame, score: Callable[[DataFrame], DataFrame], keep: Sequence[str], most: int = 20
) -> DataFrame:
    """Each input row with 0..most bugs, dependent features rebuilt, rescored."""
    expanded = inputs.withColumn("bugs", F.explode(F.sequence(F.lit(0), F.lit(most))))
    return score(what_if_app(expanded)).select(*keep, "bugs", "p")


def champion_vs_baseline(champion: DataFrame, baseline: DataFrame) -> DataFrame:
    """Two one-row suites side by side, long form: model, metric, score."""
    metrics = ["f2", "precision", "recall", "brier"]
    both = champion.select(F.lit("champion").alias("model"), *metrics).unionByName(
        baseline.select(F.lit("baseline").alias("model"), *metrics)
    )
    return both.unpivot("model", metrics, "metric", "score")
