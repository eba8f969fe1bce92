"""Exact top-k inner-product search with cover trees over queries and data together.

Vectors become integers (floor of `scale` times each component). Rows are dealt to the nearest
of a bounded number of pivots (the trees' top level); a pivot with many rows is split by hash
into shards of about `shard_rows`. Every shard and every query group is a cover tree: centres
are vectors, every child lies within its covering radius. For a query node (c, r) and a data
node (c', r') no inner product exceeds <c,c'> + r|c'| + r'|c| + r r'; a node pair is dropped
when this is below the worst kth score of the query node.

Round one searches each query group in one shard of its own pivot, which bounds the worst kth
score. Round two pairs the group with the shards of those pivots whose ball it cannot rule
out; groups travel to shards in chunks, shards are never gathered. What either round finds
is merged per query by (score descending, id). With unit vectors that have no structure the
balls overlap and few pairs are dropped: the result stays exact, the work becomes blocks of
matrix products.

Defined cases: vectors that are null, or hold null or non-finite components, and rows with null
vec_id take no part; shorter vectors count as padded with zeros; rows that repeat a vec_id count
once, with the best score, and never for the query of that id; ties go to the smaller id; an
empty table gives no rows; other columns are not read. Integer scores are exact while the sum of
products stays below 2^53.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sprintlens.llm.common import written

SCALE = 64
PIVOTS = 16
SHARD_ROWS = 8192
GROUP_ROWS = 512
CHUNK_GROUPS = 128
LEAF = 512
QUERY_LEAF = 64
FANOUT = 16

FOUND = "query_id long, vec_id long, score long"


class Tree:
    """ids and vectors in tree order; nodes as arrays, children of a node side by side."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int):
        self.leaf = leaf
        order = np.argsort(ids, kind="stable")
        x = vectors[order].astype(np.float64)
        place, nodes = np.arange(len(x)), []
        root = int(((x - x.mean(0)) ** 2).sum(1).argmin())
        nodes.append([root, 0, len(x), 0, 0])
        at = 0
        while at < len(nodes):
            center, start, end, _, _ = nodes[at]
            if end - start > leaf:
                rows = place[start:end].copy()
                side, centers = self._net(x[rows], int(np.flatnonzero(rows == center)[0]))
                if len(centers) > 1:
                    by = np.argsort(side, kind="stable")
                    place[start:end] = rows[by]
                    sizes = np.bincount(side, minlength=len(centers))
                    nodes[at][3], nodes[at][4] = len(nodes), len(nodes) + len(centers)
                    for c, size in zip(centers, sizes):
                        nodes.append([int(rows[c]), start, start + int(size), 0, 0])
                        start += int(size)
            at += 1
        table = np.array(nodes)
        self.start, self.end, self.first, self.last = table[:, 1], table[:, 2], table[:, 3], table[:, 4]
        self.center = x[table[:, 0]]
        self.norm = np.sqrt((self.center**2).sum(1))
        self.radius = np.array([np.sqrt(((x[place[s:e]] - c) ** 2).sum(1).max()) for c, s, e in zip(self.center, self.start, self.end)])
        self.ids, self.vectors = ids[order][place], x[place]

    @staticmethod
    def _net(x: np.ndarray, first: int) -> tuple[np.ndarray, list[int]]:
        """Farthest-first centres until every row is within half the covering radius."""
        near = ((x - x[first]) ** 2).sum(1)
        side, centers, half = np.zeros(len(x), np.int64), [first], near.max() / 4
        while len(centers) < FANOUT and near.max() > half:
            c = int(near.argmax())
            d = ((x - x[c]) ** 2).sum(1)
            closer = d < near
            side[closer], near = len(centers), np.minimum(near, d)
            centers.append(c)
        return side, centers


def search(queries: Tree, data: Tree, k: int, worst: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k of a shard for every query of a group, at least `worst` (per query, may be -inf).

    Returns query row, id, score, by (query, score descending, id)."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    rows = data.vectors
    edge = 1e-6  # bounds are rounded; scores are integers

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        return (
            data.center[nodes] @ queries.center[q] + queries.radius[q] * data.norm[nodes]
            + data.radius[nodes] * (queries.norm[q] + queries.radius[q]) + edge
        )

    def visit(q: int, nodes: np.ndarray) -> None:
        a, b = queries.start[q], queries.end[q]
        nodes = nodes[bounds(q, nodes) >= worst[a:b].min()]
        if queries.last[q]:
            inner = data.last[nodes] > 0
            nodes = np.concatenate([nodes[~inner], *[np.arange(data.first[n], data.last[n]) for n in nodes[inner]]])
            for child in range(queries.first[q], queries.last[q]):
                visit(child, nodes)
            return
        mine = queries.vectors[a:b]
        at, ids, score = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        while len(nodes):
            bound = bounds(q, nodes)
            best = int(bound.argmax())
            if bound[best] < worst[a:b].min():
                break
            node, nodes = int(nodes[best]), np.delete(nodes, best)
            if data.last[node]:
                nodes = np.concatenate([nodes, np.arange(data.first[node], data.last[node])])
                continue
            s, e = data.start[node], data.end[node]
            block = mine @ rows[s:e].T
            block[queries.ids[a:b][:, None] == data.ids[s:e][None, :]] = -np.inf
            r, c = np.nonzero(block >= np.maximum(worst[a:b], -1e300)[:, None])
            at, ids, score = np.concatenate([at, r]), np.concatenate([ids, data.ids[s:e][c]]), np.concatenate([score, block[r, c]])
            at, ids, score = best_of(at, ids, score, k)
            full = np.bincount(at, minlength=b - a) >= k
            last = np.searchsorted(at, np.arange(b - a), "right") - 1
            worst[a:b][full] = np.maximum(worst[a:b][full], score[last[full]])
        found.append((at + a, ids, score))

    if len(queries.ids) and len(data.ids):
        visit(0, np.array([0]))
    return tuple(np.concatenate(part) for part in zip(*found))


def best_of(at: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query the k best by (score descending, id); an id counts once."""
    order = np.lexsort((-score, ids, at))
    at, ids, score = at[order], ids[order], score[order]
    once = np.ones(len(at), bool)
    once[1:] = (at[1:] != at[:-1]) | (ids[1:] != ids[:-1])
    at, ids, score = at[once], ids[once], score[once]
    order = np.lexsort((ids, -score, at))
    at, ids, score = at[order], ids[order], score[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at, "left")
    return at[rank < k], ids[rank < k], score[rank < k]


def _quantised(vectors: DataFrame, scale: int, pivots: np.ndarray | None) -> DataFrame:
    """vec_id, v (whole numbers as float64 bytes, zero-padded), pivot."""
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0 if pivots is None else pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out, homes = [], [], []
            for vec_id, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64) if x.is_valid and x.values is not None else None
                if v is None or not np.isfinite(v).all():
                    continue
                padded = np.zeros(width)
                padded[: len(v)] = np.floor(scale * v)
                ids.append(vec_id)
                out.append(padded)
            if pivots is not None and out:
                x = np.array(out, np.float64)
                homes = ((pivots**2).sum(1)[None, :] - 2 * x @ pivots.T).argmin(1).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([v.tobytes() for v in out], pa.binary()), pa.array(homes or [0] * len(ids), pa.int32())],
                ["vec_id", "v", "pivot"],
            )

    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long"), "embedding")
    return rows.mapInArrow(run, "vec_id long, v binary, pivot int")


def _trees(rows: DataFrame, key: str, leaf: int) -> DataFrame:
    """One pickled tree per value of key."""

    def run(table: pa.Table) -> pa.Table:
        ids = table["vec_id"].to_numpy()
        vectors = np.array([np.frombuffer(v) for v in table["v"].to_pylist()])
        tree = Tree(ids, vectors, leaf)
        tree_bytes = pickle.dumps(tree, protocol=5)
        far = float(np.sqrt(((tree.vectors - tree.center[0]) ** 2).sum(1)).max())
        return pa.table({
            key: table[key][:1], "pivot": table["pivot"][:1], "center": pa.array([tree.center[0].tolist()], pa.list_(pa.float64())),
            "radius": pa.array([far]), "tree": pa.array([tree_bytes], pa.binary()),
        })

    return rows.groupBy(key).applyInArrow(run, f"{key} long, pivot int, center array<double>, radius double, tree binary")


def _searched(groups: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """Searches each row of groups (shard, chunk, tree, worst) in its shard."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        if left.num_rows and right.num_rows:
            data = pickle.loads(right["data"][0].as_py())
            for blob, worst in zip(left["tree"], left["worst"]):
                queries = pickle.loads(blob.as_py())
                limit = np.array(worst.as_py() or [-np.inf] * len(queries.ids), np.float64)
                at, ids, score = search(queries, data, k, limit)
                out.append((queries.ids[at], ids, score.astype(np.int64)))
        q, v, s = (np.concatenate(x) for x in zip(*out))
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.int64())})

    renamed = shards.select(F.col("shard").alias("_shard"), F.col("chunk").alias("_chunk"), F.col("tree").alias("data"))
    return groups.groupBy("shard", "chunk").cogroup(renamed.groupBy("_shard", "_chunk")).applyInArrow(run, FOUND)


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: int = SCALE, pivots: int = PIVOTS,
          shard_rows: int = SHARD_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score; is_query: condition on vec_id."""
    spark = vectors.sparkSession
    plain = _quantised(vectors, scale, None)
    # a bounded sample: `pivots` vectors, the same ones in every run
    sample = plain.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots).collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centers = np.unique(np.array([np.frombuffer(r["v"]) for r in sample], np.float64), axis=0)
    rows = written(_quantised(vectors, scale, centers), "search-rows")
    counts = {r["pivot"]: (r["n"], r["q"]) for r in rows.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("int")).alias("q")).collect()}
    split = lambda size, which: F.create_map(*[F.lit(int(x)) for p, c in counts.items() for x in (p, max(1, -(-(c[which] or 0) // size)))])
    placed = lambda df, size, which, seed: F.col("pivot").cast("long") * (1 << 32) + F.pmod(F.xxhash64(F.lit(seed), "vec_id"), split(size, which)[F.col("pivot")])
    shards = written(_trees(rows.withColumn("shard", placed(rows, shard_rows, 0, "shard")), "shard", LEAF), "search-shards")
    groups = written(_trees(rows.filter(is_query).withColumn("grp", placed(rows, group_rows, 1, "group")), "grp", QUERY_LEAF), "search-groups")
    # round one: any shard of the group's own pivot
    home = shards.groupBy("pivot").agg(F.min("shard").alias("shard"))
    first_pairs = groups.join(home, "pivot").select(
        "shard", F.lit(0).alias("chunk"), "tree", F.lit(None).cast("array<double>").alias("worst"),
    )
    one = F.lit(0).alias("chunk")
    first = written(_searched(first_pairs, shards.select("shard", one, "tree").join(home.select("shard"), "shard", "left_semi"), k), "search-first")
    # round two: pivots whose ball the group cannot rule out; one row per pivot, a fixed number
    balls = {r["pivot"]: r["far"] for r in shards.groupBy("pivot").agg(
        F.max(F.col("radius") + _distance(F.col("center"), F.col("pivot"), centers)).alias("far")).collect()}
    kth = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    worst = _worst_of_groups(rows.filter(is_query).withColumn("grp", placed(rows, group_rows, 1, "group")), kth)

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for grp, blob, by_id in zip(*(batch.column(i) for i in range(3))):
                tree = pickle.loads(blob.as_py())
                known = {x["vec_id"]: x["kth"] for x in by_id.as_py() or []}
                limit = [-np.inf if known.get(int(i)) is None else float(known[int(i)]) for i in tree.ids]
                c, r = tree.center[0], tree.radius[0]
                for p, far in balls.items():
                    top = c @ centers[p] + r * np.sqrt((centers[p] ** 2).sum()) + far * (tree.norm[0] + r) + 1e-6
                    if top >= min(limit):
                        out.append((grp.as_py(), p, blob.as_py(), limit))
            g, p, t, w = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(g, pa.int64()), pa.array(p, pa.int32()), pa.array(t, pa.binary()), pa.array(w, pa.list_(pa.float64()))], ["grp", "pivot", "tree", "worst"])

    chunks = max(1, -(-groups.count() // CHUNK_GROUPS))
    chunk = F.pmod(F.xxhash64("grp"), F.lit(chunks)).cast("int")
    alive = groups.join(worst, "grp").select("grp", "tree", "kths").mapInArrow(survivors, "grp long, pivot int, tree binary, worst array<double>")
    second_pairs = (
        alive.join(shards.select("pivot", "shard").join(home.select("pivot", F.col("shard").alias("_home")), "pivot"), "pivot")
        .filter((F.shiftright("grp", 32) != F.col("pivot")) | (F.col("shard") != F.col("_home")))
        .select("shard", chunk.alias("chunk"), "tree", "worst")
    )
    spread = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "tree")
    both = first.unionByName(_searched(second_pairs, spread, k))
    best = both.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _distance(center, pivot, centers: np.ndarray):
    """Distance between a shard's centre and its pivot."""
    known = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in centers])
    other = F.element_at(known, pivot + 1)
    return F.sqrt(F.aggregate(F.zip_with(center, other, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v))


def _worst_of_groups(queries: DataFrame, kth: DataFrame) -> DataFrame:
    """Per group its queries with the kth score known so far (a group has a bounded number of rows)."""
    known = queries.select("grp", "vec_id").join(kth, F.col("vec_id") == F.col("query_id"), "left")
    return known.groupBy("grp").agg(F.collect_list(F.struct("vec_id", "kth")).alias("kths"))
