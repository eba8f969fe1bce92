"""Bootstrap replicates of exactly n draws with replacement, by splitting cells.

Rows are collapsed to (score, class) cells. The n draws of a replicate go down a binary tree over
the ordered cells: of the draws that reach a node, a binomial number goes to its left half, in
proportion to the rows there. One generator per node, keyed by the seed and the node's row range,
draws for all replicates at once, so a task that runs again draws the same. The top of the tree,
over chunks of cells with about equal numbers of rows, is split first; every chunk then goes on
by itself. The cost is cells x replicates, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.operators.metrics import score_counts, suite_from_counts
from sprintlens.operators.ranking import running_totals

DRAWN = "replicate int, s double, pos long, neg long"


def split_draws(draws: np.ndarray, sizes: np.ndarray, first: int, seed: int) -> np.ndarray:
    """cells x replicates: how many of the draws (one number per replicate) fall into each cell.

    sizes: rows of each cell, `first` rows lie before them."""
    out = np.zeros((len(sizes), len(draws)), np.int64)
    ends = np.cumsum(sizes)
    stack = [(0, len(sizes), draws)]
    while stack:
        lo, hi, here = stack.pop()
        if hi - lo == 1:
            out[lo] = here
            continue
        middle = (lo + hi) // 2
        start = int(ends[lo - 1]) if lo else 0
        left, whole = int(ends[middle - 1]) - start, int(ends[hi - 1]) - start
        rng = np.random.Generator(np.random.Philox(key=[seed, (first + start) << 1], counter=[0, 0, 0, whole]))
        taken = rng.binomial(here, left / whole)
        stack += [(lo, middle, taken), (middle, hi, here - taken)]
    return out


def multinomial_counts(df: DataFrame, label: str, score: str, replicates: int, seed: int = P.SEED) -> DataFrame:
    """replicate, s, pos, neg: drawn rows of each class per distinct score; rows without score or
    label are left out. No rows give no replicates."""
    spark = df.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = score_counts(df.where(F.col(label).isNotNull()).withColumn("s", F.col(score).cast("double")), label, "s")
    cells = cells.withColumn("n", F.col("pos") + F.col("neg")).where("n > 0")
    placed = running_totals(cells, "s", ["n"]).withColumn(
        "chunk", F.floor((F.col("n_upto") - F.col("n")) / F.ceil(F.col("n_total") / slots)).cast("int")
    )
    chunks = placed.groupBy("chunk").agg(F.sum("n").alias("n"), F.min(F.col("n_upto") - F.col("n")).alias("first")).orderBy("chunk").collect()
    if not chunks:
        return spark.createDataFrame([], DRAWN)
    sizes = np.array([r["n"] for r in chunks])  # one row per slot at most
    top = split_draws(np.full(replicates, sizes.sum()), sizes, 0, seed)
    given = {r["chunk"]: (top[i], r["first"]) for i, r in enumerate(chunks)}

    def draw(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("s")
        draws, first = given[int(key[0])]
        sides = rows[["neg", "pos"]].to_numpy().ravel()
        taken = np.zeros((len(sides), replicates), np.int64)
        some = np.flatnonzero(sides)
        taken[some] = split_draws(draws, sides[some], int(first), seed + 1)
        neg, pos = taken[::2], taken[1::2]
        cell, replicate = np.nonzero(neg + pos)
        return pd.DataFrame({"replicate": replicate.astype(np.int32), "s": rows["s"].to_numpy()[cell], "pos": pos[cell, replicate], "neg": neg[cell, replicate]})

    return placed.groupBy("chunk").applyInPandas(draw, DRAWN)


def multinomial_replicates(
    df: DataFrame, label: str = P.LABEL, score: str = "p", threshold: float = 0.5, replicates: int = 1000,
    digits: int | None = 4, seed: int = P.SEED,
) -> DataFrame:
    """Metric suite of each replicate."""
    counts = multinomial_counts(df, label, score, replicates, seed)
    return suite_from_counts(counts, "s", threshold, ["replicate"], digits)
