"""Contributions, importance, local cases, partial dependence."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.operators.features import to_long
from sprintlens.operators.metrics import with_cell
from sprintlens.operators.ranking import exact_percentiles, running_totals
from sprintlens.operators.shaping import with_row


def linear_contributions(
    df: DataFrame, coefficients: dict[str, float], keep: Sequence[str]
) -> DataFrame:
    """Exact additive contributions of a linear model: coefficient x (value - mean value)."""
    means = df.agg(*[F.avg(f).alias(f) for f in coefficients])
    return with_row(df, "__mean", means).select(
        *keep, *[(float(c) * (F.col(f) - F.col(f"__mean.{f}"))).alias(f) for f, c in coefficients.items()]
    ).unpivot(list(keep), list(coefficients), "feature", "contribution")


def sampled_contributions(
    model, df: DataFrame, features: Sequence[str], row_id: str, rounds: int = 8,
    background: DataFrame | None = None, seed: int = P.SEED,
) -> DataFrame:
    """Shapley values by sampled feature orders (any model): id, feature, contribution, std_error.

    Each row is explained in `rounds` orders, each against a row drawn by position from all rows
    of `background` (by default the explained rows). For every order
    the model scores the mixed rows with 0, 1, .. features switched on; a score counts
    positively for the feature just switched on and negatively for the next, so the sum per
    feature needs no ordering of the scores. Contributions of a row add up to its score
    minus the mean of its background scores.
    """
    size = len(features)
    x = F.array(*[F.col(f).cast("double") for f in features])
    ident = F.col(row_id).cast("string")
    rows = (
        (df if background is None else background)
        .where(ident.isNotNull())
        .groupBy(ident.alias("i"))
        .agg(F.min(x).alias("z"), F.lit(1).cast("bigint").alias("n"))
    )
    pool = running_totals(rows, "i", ["n"]).select((F.col("n_upto") - 1).alias("at"), "z")
    drawn = with_row(df, "pool", rows.agg(F.count(F.lit(1)).alias("n"))).select(
        ident.alias("id"), x.alias("x"), F.col("pool.n").alias("pool_size"),
        F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("round"),
    )
    order = F.transform(
        F.array_sort(
            F.transform(
                F.sequence(F.lit(0), F.lit(size - 1)),
                lambda k: F.struct(F.xxhash64(F.lit(seed), F.col("id"), F.col("round"), k).alias("h"), k.alias("k")),
            )
        ),
        lambda e: e["k"],
    )
    draw = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("id"), F.col("round")), F.nullif("pool_size", F.lit(0)))
    ordered = drawn.select("id", "round", "x", draw.alias("at"), order.alias("order")).join(pool, "at")
    steps = ordered.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(size))))
    on = [
        F.when(F.array_position("order", F.lit(k)) <= F.col("step"), F.col("x")[k]).otherwise(F.col("z")[k])
        for k in range(size)
    ]
    keep = ("id", "round", "order", "step")
    if hasattr(model, "stages"):  # imputation, scaling and assembly belong to the model
        mixed = steps.select(*keep, *[c.alias(f) for c, f in zip(on, features)])
    else:
        mixed = steps.select(*keep, array_to_vector(F.array(*on)).alias("features"))
    scored = model.transform(mixed).select(*keep, vector_to_array(F.col("probability"))[1].alias("p"))
    signed = F.array(
        F.struct(F.get("order", F.col("step") - 1).alias("k"), F.col("p").alias("d")),
        F.struct(F.get("order", F.col("step")).alias("k"), (-F.col("p")).alias("d")),
    )
    name = F.array(*[F.lit(f) for f in features])
    return (
        scored.select("id", "round", F.explode(signed).alias("e"))
        .where(F.col("e.k").isNotNull())
        .groupBy("id", "round", F.col("e.k").alias("k"))
        .agg(F.sum("e.d").alias("d"))
        .groupBy("id", "k")
        .agg(
            F.avg("d").alias("contribution"),
            (F.coalesce(F.stddev_samp("d"), F.lit(0.0)) / F.sqrt(F.count("d"))).alias("std_error"),
        )
        .select(F.col("id").alias(row_id), F.get(name, F.col("k")).alias("feature"), "contribution", "std_error")
    )


def global_importance(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return (
        contributions.groupBy("feature")
        .agg(F.avg(F.abs("contribution")).alias("importancia"))
        .orderBy(F.col("importancia").desc(), "feature")
    )


def local_cases(
    scored: DataFrame, cases: Sequence[tuple[str, str]], row_id: str = "sprint_id", threshold: float = 0.5,
    label: str = P.LABEL, score: str = "p",
) -> DataFrame:
    """Most extreme row of each (cell, project) case; any project when that one has no such row.

    Flagged cells take the highest score, cleared cells the lowest, ties the first id. One
    pass with partial minima; a cell without any row gives no case.
    """
    celled = with_cell(scored, label, score, threshold)
    strength = F.when(F.col("cell").isin("tp", "fp"), F.col(score)).otherwise(-F.col(score))
    row = F.struct((-strength).alias("order"), *[F.col(c) for c in (row_id, "project", score, label)])
    wanted = F.array(*[F.struct(F.lit(c).alias("cell"), F.lit(p).alias("project")) for c, p in cases])
    asked = celled.select(row.alias("row"), "cell", F.explode(wanted).alias("case")).where(
        F.col("case.cell") == F.col("cell")
    )
    inside = F.col("row.project") == F.col("case.project")
    found = asked.groupBy("case").agg(
        F.min(F.when(inside, F.col("row"))).alias("own"), F.min("row").alias("any")
    )
    return found.select(
        F.col("case.cell").alias("cell"),
        F.col("case.project").alias("wanted_project"),
        *[F.coalesce("own", "any")[c].alias(c) for c in (row_id, "project", score, label)],
    )


def top_drivers(contributions: DataFrame, keep: Sequence[str], count: int = 2) -> DataFrame:
    """driver_1, driver_2, ..: features with the largest contributions of each row (ties by name).

    A row has one entry per feature, so the array is as short as the feature list.
    """
    ordered = F.array_sort(
        F.collect_list(F.struct((-F.col("contribution")).alias("c"), F.col("feature").alias("f")))
    )
    return (
        contributions.groupBy(*keep)
        .agg(ordered.alias("d"))
        .select(*keep, *[F.get("d", F.lit(i))["f"].alias(f"driver_{i + 1}") for i in range(count)])
    )


def partial_dependence_grid(
    df: DataFrame, features: Sequence[str], points: int = 50, low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """(feature, grid array): the distinct values when fewer than `points`, else an even grid
    between the two percentiles."""
    long = to_long(df, features)
    ends = exact_percentiles(long, "value", [low, high], ["feature"])
    distinct = (
        long.select("feature", "value").distinct()
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )
    few = (
        long.select("feature", "value").distinct()
        .join(F.broadcast(distinct.where(F.col("n_distinct") < points)), "feature")
        .groupBy("feature")
        .agg(F.sort_array(F.collect_list("value")).alias("values"))
    )
    lo, hi = F.col("percentiles")[0], F.col("percentiles")[1]
    even = F.transform(
        F.sequence(F.lit(0), F.lit(points - 1)), lambda i: lo + (hi - lo) * i.cast("double") / float(points - 1)
    )
    return ends.join(few, "feature", "left").select("feature", F.coalesce("values", even).alias("grid"))


def partial_dependence(
    df: DataFrame, score: Callable[[DataFrame], DataFrame], features: Sequence[str], points: int = 50
) -> DataFrame:
    """Mean score with the feature set to each grid value, over all rows: feature, value, mean_p.

    Rows are expanded by the grid (narrow), scored once, and averaged per grid point. The
    grid is one array of at most `points` values per listed feature.
    """
    grid = partial_dependence_grid(df, features, points)
    grids = grid.agg(F.map_from_entries(F.collect_list(F.struct("feature", "grid")))).scalar()

    def points_of(f: str):
        values = F.coalesce(F.try_element_at(F.col("__grids"), F.lit(f)), F.array().cast("array<double>"))
        return F.transform(values, lambda v: F.struct(F.lit(f).alias("feature"), v.alias("value")))

    pairs = F.flatten(F.array(*[points_of(f) for f in features]))
    expanded = df.withColumn("__grids", grids).withColumn("__pair", F.explode(pairs)).drop("__grids")
    for f in features:
        expanded = expanded.withColumn(
            f, F.when(F.col("__pair.feature") == f, F.col("__pair.value")).otherwise(F.col(f))
        )
    return (
        score(expanded)
        .groupBy(F.col("__pair.feature").alias("feature"), F.col("__pair.value").alias("value"))
        .agg(F.avg("p").alias("mean_p"))
    )
