"""Non-decreasing fit of a rate over an ordered score, by chunks.

Scores are range-partitioned; each chunk pools neighbouring blocks while their rates fall, which
leaves the lower convex hull of its running (rows, positives) sums. Neighbouring chunks are then
pooled pairwise, level by level, by the same rule: pooling in any order gives the same blocks.
Blocks hold whole numbers, so rates are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = "chunk int, place int, low double, high double, positives long, n long"


def pooled(blocks: Iterator[tuple[float, float, int, int]]) -> list[list]:
    """Blocks (lowest score, highest score, positives, rows) in score order, without falling rates."""
    out: list[list] = []
    for low, high, positives, n in blocks:
        out.append([low, high, positives, n])
        while len(out) > 1 and out[-2][2] * out[-1][3] >= out[-1][2] * out[-2][3]:
            _, high, positives, n = out.pop()
            out[-1][1:] = [high, out[-1][2] + positives, out[-1][3] + n]
    return out


def _frame(chunk: int, blocks: list[list]) -> pd.DataFrame:
    rows = [(chunk, i, *b) for i, b in enumerate(blocks)]
    return pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCKS.split(", ")])


def isotonic_blocks(df: DataFrame, label: str, score: str, chunks: int | None = None) -> DataFrame:
    """low, high, positives, n of each block, in any order. Rows without score or label don't count."""
    chunks = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("s"))
        .agg(F.count_if(F.col(label) == 1).alias("positives"), F.count(F.lit(1)).alias("n"))
    )

    def pool_chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for b in batches for r in zip(b["s"], b["s"], b["positives"].tolist(), b["n"].tolist()))
        yield _frame(TaskContext.get().partitionId(), pooled(rows))

    def pool_pair(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["chunk", "place"])
        blocks = zip(rows["low"], rows["high"], rows["positives"].tolist(), rows["n"].tolist())
        return _frame(int(rows["chunk"].iloc[0]) // 2, pooled(blocks))

    blocks = counts.repartitionByRange(chunks, "s").sortWithinPartitions("s").mapInPandas(pool_chunk, BLOCKS)
    while chunks > 1:
        blocks, chunks = blocks.groupBy(F.floor(F.col("chunk") / 2)).applyInPandas(pool_pair, BLOCKS), -(-chunks // 2)
    return blocks.select("low", "high", "positives", "n")


def isotonic_points(df: DataFrame, label: str, score: str, chunks: int | None = None) -> tuple[list[float], list[float]]:
    """Scores and values of the fitted steps: both ends of each block."""
    scores, values = [], []
    for r in isotonic_blocks(df, label, score, chunks).orderBy("low").collect():
        for end in dict.fromkeys((r["low"], r["high"])):
            scores.append(end)
            values.append(r["positives"] / r["n"])
    return scores, values
