"""Minority oversampling by interpolation between near minority rows.

Neighbours are exact (`neighbours.nearest_rows`). `exact=False` compares each row only with the
rows within `reach` ranks on a few unit projections (chunked running totals, no single-task
sort): one round, whatever the data, and neighbours that are near, not always the nearest.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sprintlens import params as P
from sprintlens.functions import numeric as N
from sprintlens.operators.neighbours import nearest_rows
from sprintlens.operators.ranking import running_totals
from sprintlens.operators.shaping import with_row


def ranked_axes(rows: DataFrame, row_id: str, size: int, axes: int, seed: int) -> DataFrame:
    """(axis, position, at, id, x): rank of every row on every unit projection, ties by id."""
    rng = random.Random(seed)
    projections = []
    for _ in range(axes):
        row = [rng.gauss(0.0, 1.0) for _ in range(size)]
        norm = math.sqrt(sum(w * w for w in row))
        projections.append(sum((F.col("x")[i] * (w / norm) for i, w in enumerate(row)), F.lit(0.0)))
    long = rows.select(
        F.col(row_id).alias("id"), "x", F.posexplode(F.array(*projections)).alias("axis", "at")
    ).select("axis", F.struct("at", "id").alias("place"), "id", "x", F.lit(1).alias("n"))
    return running_totals(long, "place", ["n"], ["axis"]).select(
        "axis", F.col("n_upto").alias("position"), F.col("place.at").alias("at"), "id", "x"
    )


def _compare(asking: DataFrame, ranked: DataFrame, size: int, k: int, reach: int) -> DataFrame:
    """id, x, the k nearest rows of the windows.

    Windows are joined by blocks of an eighth of the reach: a row is copied to 17 blocks or
    so, and the pairs of a block are cut to the k nearest before they are shuffled.
    """
    width = max(reach // 8, 1)
    block = lambda position: F.floor((position - 1) / F.lit(width))
    place = F.col("position")
    copied = asking.select(
        "axis", "id", "x", "position", F.explode(F.sequence(block(place - reach), block(place + reach))).alias("block")
    )
    asked = ranked.select(
        "axis", block(place).alias("block"), place.alias("there"), F.col("id").alias("other"), F.col("x").alias("z")
    )
    step = F.abs(F.col("there") - F.col("position"))
    gaps = [F.get("x", F.lit(i)) - F.get("z", F.lit(i)) for i in range(size)]
    pairs = copied.join(asked, ["axis", "block"]).where((step <= reach) & (step > 0)).select(
        "id", "axis", "x", "other", "z", sum((g * g for g in gaps), F.lit(0.0)).alias("d")
    )

    def nearest(df: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy("d", "other")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    return (
        nearest(nearest(pairs, "id", "axis").drop("rank").dropDuplicates(["id", "other"]), "id")
        .groupBy("id")
        .agg(F.first("x").alias("x"), F.array_sort(F.collect_list(F.struct("rank", "other", "z"))).alias("neighbours"))
    )


def near_rows(
    rows: DataFrame, row_id: str, size: int, k: int = 5, axes: int = 4, reach: int = 8, seed: int = P.SEED
) -> DataFrame:
    """id, x, neighbours (array of the k nearest vectors of the windows, nearest first)."""
    reach = max(reach, k)  # the first and last rows of an axis have neighbours on one side only
    ranked = ranked_axes(rows, row_id, size, axes, seed)
    return _compare(ranked, ranked, size, k, reach).select("id", "x", "neighbours")


def smote(
    df: DataFrame, features: Sequence[str], label: str = P.LABEL, row_id: str = "sprint_id", k: int = 5,
    axes: int = 4, reach: int = 8, exact: bool = True,
) -> DataFrame:
    """Original rows plus synthetic minority rows: id, label, features, `synthetic` flag."""
    plain = df.select(
        F.col(row_id).cast("string").alias(row_id),
        F.col(label).cast("double").alias(label),
        *[F.col(f).cast("double").alias(f) for f in features],
    )
    sizes = plain.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    counts = sizes.select(
        F.when(F.col("p") < F.col("n"), 1.0).otherwise(0.0).alias("minority"),
        F.abs(F.col("p") - F.col("n")).alias("gap"),
        F.least("p", "n").alias("have"),
    )
    small = with_row(plain, "__c", counts).where(F.col(label) == F.col("__c.minority")).select(
        row_id, F.array(*features).alias("x")
    )
    found = nearest_rows(small, row_id, k) if exact else near_rows(small, row_id, len(features), k, axes, reach)

    # Row i of m gets floor(gap / m) copies, the first gap mod m rows one more.
    gap, have = F.col("__c.gap"), F.col("__c.have")
    order = ranked_axes(small, row_id, len(features), 1, P.SEED).select("id", "position")
    copies = F.floor(N.ratio(gap, have)) + (F.col("position") <= gap % have).cast("bigint")
    drawn = (
        with_row(found.join(order, "id"), "__c", counts)
        .where(copies > 0)
        .select("id", "x", "neighbours", "__c", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)).alias("copy"))
    )
    text = F.concat_ws("#", "id", "copy")
    pick = F.floor(N.hash_uniform(F.concat(text, F.lit("#row"))) * F.size("neighbours")).cast("int")
    step = N.hash_uniform(F.concat(text, F.lit("#step")))
    synthetic = drawn.select(
        text.alias(row_id),
        F.col("__c.minority").alias(label),
        F.zip_with("x", F.get("neighbours", pick)["z"], lambda a, b: a + (b - a) * step).alias("v"),
    ).select(
        row_id, label, *[F.col("v")[i].alias(f) for i, f in enumerate(features)], F.lit(True).alias("synthetic")
    )
    return plain.withColumn("synthetic", F.lit(False)).unionByName(synthetic)
