"""Exact k-nearest join of a table of vectors with itself, in cells around pivots.

Rows with equal vectors are one point with its k + 1 smallest ids, so a vector that a third of all
rows share is one row. Pivots are points with the lowest hashes, about one per CELL_ROWS points,
so dense regions have many; a point belongs to the cell of its nearest pivot.

1. Of each cell: its radius and the k + 1 distances nearest to its pivot. From these follows, for
   every cell, a distance within which all its points have k + 1 points (themselves included):
   the k + 1 smallest sums of radius, distance of two pivots and distance from the second pivot.
2. A point is copied to a foreign cell only if it may be that near to one of its points: both its
   distance from the cell's ring and from the plane between the two pivots are lower bounds.
3. Each cell compares its own points with its own and the copied ones, in blocks of queries.

Every point is asked once and nothing is widened or repeated. Pivots are at most MOST_PIVOTS, so
what tasks hold of them is bounded; a cell's queries are dealt over as many tasks as it has
multiples of CELL_ROWS.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sprintlens import params as P
from sprintlens.session import scratch_dir

CELL_ROWS = 2048
MOST_PIVOTS = 2048
QUERY_BLOCK = 256
SLACK = 1 + 1e-9  # bounds are sums of rounded distances

ASSIGNED = "point long, x array<double>, ids array<string>, cell int, r double"
PLACED = "cell int, part int, asks boolean, point long, x array<double>, ids array<string>"
FOUND = "x array<double>, near array<struct<d: double, other: string, z: array<double>>>"


def squared(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances, summed feature by feature in their order."""
    out = np.zeros((len(points), len(to)))
    for i in range(points.shape[1]):
        out += (points[:, i, None] - to[None, :, i]) ** 2
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def cell_bounds(pivots: np.ndarray, radius: np.ndarray, nearest: list[np.ndarray], k: int) -> np.ndarray:
    """For each cell: every point of it has k + 1 points within this distance (inf if there are fewer)."""
    between = np.sqrt(squared(pivots, pivots))
    owner = np.repeat(np.arange(len(pivots)), [len(n) for n in nearest])
    reach = np.concatenate([*nearest, np.zeros(0)])
    out = np.full(len(pivots), np.inf)
    for i in range(len(pivots)):
        if len(reach) > k:
            out[i] = radius[i] + np.partition(between[i, owner] + reach, k)[k]
    return out * SLACK


def copies(x: np.ndarray, cell: np.ndarray, pivots: np.ndarray, radius: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(point, foreign cell) of all points that may be among the nearest of a point there."""
    d = np.sqrt(squared(x, pivots))
    between = np.sqrt(squared(pivots, pivots))
    own = d[np.arange(len(x)), cell]
    apart = np.maximum(between[cell], 1e-300)
    plane = (d**2 - own[:, None] ** 2) / (2 * apart)
    lower = np.maximum(d - radius, plane) / SLACK - 1e-12
    wanted = (lower <= bound) & (radius >= 0)
    wanted[np.arange(len(x)), cell] = False
    return np.nonzero(wanted)


def _nearest(queries: pd.DataFrame, others: pd.DataFrame, k: int) -> Iterator[tuple[np.ndarray, list]]:
    z, x = _matrix(others["x"]), _matrix(queries["x"])
    ids = others["ids"].to_list()
    for lo in range(0, len(x), QUERY_BLOCK):
        block = squared(x[lo : lo + QUERY_BLOCK], z)
        for row, d in zip(x[lo : lo + QUERY_BLOCK], block):
            most = min(k, len(d) - 1)
            found = np.flatnonzero(d <= np.partition(d, most)[most])
            near = sorted((float(d[j]), str(i), j) for j in found for i in ids[j])
            yield row, [{"d": a, "other": b, "z": z[j]} for a, b, j in near[: k + 1]]


def nearest_rows(rows: DataFrame, row_id: str, k: int = 5, seed: int = P.SEED, cell_rows: int = CELL_ROWS) -> DataFrame:
    """id, x, neighbours (rank, other, z): the k nearest other rows by distance, then id.

    rows: `row_id`, one per row, and `x`, an array of doubles without nulls. With fewer than k
    other rows, all of them."""
    spark, base = rows.sparkSession, scratch_dir(rows.sparkSession, "neighbours")
    named = rows.select(F.col(row_id).cast("string").alias("id"), F.col("x").cast("array<double>").alias("x"))
    # tasks keep the k + 1 first ids of a vector before they are shuffled
    few = lambda df, key, by: df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(by))).where(F.col("rank") <= k + 1)
    points = few(named, "x", "id").groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    points.withColumn("point", F.xxhash64("x")).write.parquet(f"{base}/points")
    points = spark.read.parquet(f"{base}/points")
    size = points.count()
    if not size:
        return spark.createDataFrame([], "id string, x array<double>, neighbours array<struct<rank: int, other: string, z: array<double>>>")
    wanted = min(MOST_PIVOTS, -(-size // cell_rows))
    drawn = points.orderBy(F.xxhash64(F.lit(seed), "x"), "x").limit(wanted).select("x").toPandas()
    pivots = _matrix(drawn["x"])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d = squared(_matrix(batch["x"]), pivots)
                cell = d.argmin(1)
                yield batch.assign(cell=cell.astype(np.int32), r=np.sqrt(d[np.arange(len(d)), cell]))[["point", "x", "ids", "cell", "r"]]

    points.mapInPandas(assign, ASSIGNED).write.parquet(f"{base}/assigned")
    assigned = spark.read.parquet(f"{base}/assigned")
    radius, sizes, reach = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64), [np.zeros(0)] * len(pivots)
    for r in assigned.groupBy("cell").agg(F.max("r").alias("radius"), F.count(F.lit(1)).alias("n")).collect():  # a row per pivot
        radius[r["cell"]], sizes[r["cell"]] = r["radius"], r["n"]
    for r in few(assigned, "cell", "r").groupBy("cell").agg(F.collect_list("r").alias("near")).collect():
        reach[r["cell"]] = np.array(r["near"])
    bound = cell_bounds(pivots, radius, reach, k)
    parts = np.maximum(1, -(-sizes // cell_rows)).astype(np.int32)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            cell = batch["cell"].to_numpy()
            point, foreign = copies(_matrix(batch["x"]), cell, pivots, radius, bound)
            at, target = np.concatenate([np.arange(len(batch)), point]), np.concatenate([cell, foreign])
            own = np.arange(len(at)) < len(batch)
            times = parts[target]  # a cell of several parts gets each candidate once per part
            spread = np.repeat(np.arange(len(at)), times)
            part = np.arange(len(spread)) - np.repeat(np.cumsum(times) - times, times)
            out = batch.iloc[at[spread]][["point", "x", "ids"]].reset_index(drop=True)
            mine = own[spread] & (np.mod(out["point"].to_numpy(), times[spread]) == part)
            yield out.assign(cell=target[spread].astype(np.int32), part=part.astype(np.int32), asks=mine)[["cell", "part", "asks", "point", "x", "ids"]]

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        queries = rows[rows["asks"]]
        found = list(_nearest(queries, rows, k)) if len(queries) else []
        return pd.DataFrame({"x": pd.Series([f[0] for f in found], dtype=object), "near": pd.Series([f[1] for f in found], dtype=object)})

    found = assigned.mapInPandas(place, PLACED).groupBy("cell", "part").applyInPandas(compare, FOUND)
    others = F.slice(F.filter("near", lambda n: n["other"] != F.col("id")), 1, k)
    numbered = F.transform(others, lambda n, i: F.struct((i + 1).cast("int").alias("rank"), n["other"].alias("other"), n["z"].alias("z")))
    return named.join(found, "x").select("id", "x", numbered.alias("neighbours"))
