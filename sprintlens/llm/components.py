"""Connected components of a link table by alternating large-star and small-star steps.

First the links are united in slices of at most SLICE_LINKS, each of which hands on one link of
each node; the steps join what different slices hold (a table of a single slice needs none). Each
step is an aggregation and a join over the links; nothing is collected. The links after each round
are written to the shared scratch folder, so that rounds don't pile up lineage.

Defined cases: links of a node with itself, repeated links and either direction count once; null
ends link nothing; no links give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintlens.llm.common import released, shuffles_released, written

#: Links that a task unites at once, 16 bytes each.
SLICE_LINKS = 1 << 19


def stars_of(ends: np.ndarray) -> np.ndarray:
    """Links (two rows of nodes) -> a link of each node with the smallest it reaches, itself left out."""
    nodes, at = np.unique(ends.ravel(), return_inverse=True)
    a, b = np.split(at.ravel(), 2)
    label = np.arange(len(nodes))
    while len(a):
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    up = np.flatnonzero(label != np.arange(len(nodes)))
    return np.stack([nodes[up], nodes[label[up]]])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    held, rows = [np.zeros((2, 0), np.int64)], 0
    for batch in batches:
        held.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]))
        rows += batch.num_rows
        if rows >= SLICE_LINKS:
            yield np.concatenate(held, axis=1)
            held, rows = [np.zeros((2, 0), np.int64)], 0
    if rows:
        yield np.concatenate(held, axis=1)


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ends in _slices(batches):
        yield pa.RecordBatch.from_arrays([*map(pa.array, stars_of(ends))], ["u", "v"])


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of the nodes of one slice."""
    for ends in _slices(batches):
        u, v = stars_of(ends)
        roots = np.unique(v)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(x, roots)) for x in (u, v)], ["node", "component"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    kept = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def _is_stars(links: DataFrame) -> bool:
    """Whether every node has one node below, or only links from above: then nothing is left to do."""
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("down"), F.lit(0).alias("up")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("down"), F.lit(1).alias("up"))
    )
    per_node = ends.groupBy("node").agg(F.min("down").alias("least"), F.max("down").alias("most"), F.max("up").alias("up"))
    with shuffles_released(links.sparkSession):
        return per_node.filter("least < most OR (least IS NOT NULL AND up = 1)").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every linked node; component is the smallest node reachable."""
    ends = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b")
    ends = written(ends, "links")
    slices = -(-(ends.count() + 1) // SLICE_LINKS)
    ends = ends.coalesce(slices)
    if slices == 1:
        return ends.mapInArrow(released(_labelled), "node long, component long")
    stars = written(ends.mapInArrow(released(_united), "u long, v long"), "stars")
    while not _is_stars(stars):
        stars = written(_small_star(_large_star(stars)), "stars")
    return (
        stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .distinct()
    )
