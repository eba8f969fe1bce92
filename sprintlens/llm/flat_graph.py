"""Embedding near-dedup on a robust-pruned flat graph, built in overlapping cluster shards.

Equal vectors are one class first. Classes are dealt to the cells of their `overlap` nearest
pivots; a cell with many members is split by hash into blocks, so a hot cell is many shards.
Each shard links its members to their nearest ones and prunes robustly (a link goes when a kept
neighbour is `alpha` times closer to its end); the adjacency lists of all shards are united per
class. Every class then searches, in each block of its cells and of as many more near ones, the
united graph: a greedy beam from the block's medoid, then, from what it found in range and from the class's own links,
expansion through neighbours in range until nothing new turns up. What is found is verified by
cosine in double precision.

A dense group has links in the square of its size, so these are not written out: a search returns
how many vectors it found, each counted in the first cell that is both classes' own, and the links
of a block reduced to a forest. Both are as long as the list of searches. Only links of classes
without a common own cell, which either may miss, are written as pairs.

Recall is audited against brute force for a bounded sample of classes (the sample is shipped to
the data), drawn until AUDIT_LINKED of them have true links or AUDIT_MOST are drawn; it is the
mean, over classes with true links, of the share found. Below `recall`, the search runs again with
more overlap and a wider beam; below LEAST_RECALL in the last run, it fails.

Defined cases: vectors that are null, zero, empty or hold null or non-finite components link
with nothing and are kept; vectors of different length don't link; rows that repeat a vec_id
count as vectors of their own but keep its id; null vec_id stays a row without links; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintlens.llm.common import written
from sprintlens.llm.components import components

THRESHOLD = 0.95
SHARD_ROWS = 3000
MOST_PIVOTS = 1024
OVERLAP = 2
#: Cells a class searches, for each cell it is a member of.
PROBES = 2
DEGREE = 24
BEAM = 24
#: Nodes of the beam that a step expands together.
EXPAND = 4
ALPHA = 1.2
AUDIT = 200
AUDIT_LINKED, AUDIT_MOST = 50, 3200
LEAST_RECALL = 0.9
#: Expansion passes through neighbours up to so many times as far as the threshold.
SLACK = 2.0
RECALL = 0.95


def _numbers(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.float64) for x in column.to_pylist()]


def _is_usable() -> Column:
    """Whether a row's vector can link."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = []
        for x in batch.column(1):
            v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
            v = v / np.abs(v).max()
            units.append((v / np.sqrt((v * v).sum())).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(units, pa.binary())], ["id", "n", "v"])


def _cells(classes: DataFrame, pivots: list[np.ndarray], overlap: int) -> DataFrame:
    """id, v, n, cell, own, cells: each class in the cells of its nearest pivots of its own length;
    the first `overlap` of them are its own, the others are searched only."""
    by_width = {w: np.array([i for i, p in enumerate(pivots) if len(p) == w]) for w in {len(p) for p in pivots}}
    tables = {w: np.array([pivots[i] for i in rows]) for w, rows in by_width.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cells, own, lists = [], [], [], []
            for i, v in enumerate(_numbers(batch.column(1))):
                near = np.argsort(-(tables[len(v)] @ v), kind="stable")[: overlap * PROBES] if len(v) in tables else []
                numbers = by_width[len(v)][near] if len(near) else [-len(v)]
                rows += [i] * len(numbers)
                cells += [int(c) for c in numbers]
                own += [k < overlap for k in range(len(numbers))]
                lists += [[int(c) for c in numbers]] * len(numbers)
            part = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(cells, pa.int64()), pa.array(own, pa.bool_()), pa.array(lists, pa.list_(pa.int64()))],
                ["id", "v", "n", "cell", "own", "cells"],
            )

    return classes.select("id", "v", "n").mapInArrow(run, "id long, v binary, n long, cell long, own boolean, cells array<long>")


def robust_prune(points: np.ndarray, candidates: np.ndarray, vectors: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Which candidates (per point, nearest first) stay: those that no kept one is alpha times
    nearer to than the point is, up to `degree`."""
    x = vectors[candidates]
    far = 1 - np.einsum("ikd,id->ik", x, points)
    apart = 1 - np.matmul(x, x.transpose(0, 2, 1))
    alive, kept = np.ones(candidates.shape, bool), np.zeros(candidates.shape, bool)
    for i in range(candidates.shape[1]):
        take = alive[:, i] & (kept.sum(1) < degree)
        kept[:, i] = take
        alive &= ~take[:, None] | (alpha * apart[:, i] > far)
    return kept


def _graph(table: pa.Table) -> pa.Table:
    """Adjacency of one shard: id, out."""
    ids = table["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], np.array(_numbers(table["v"]))[order]
    most, ends = min(2 * DEGREE, len(x) - 1), []
    for start in range(0, len(x), 256):
        points = x[start : start + 256]
        sims = points @ x.T
        sims[np.arange(len(sims)), np.arange(start, start + len(sims))] = -2
        near = np.argpartition(-sims, most - 1, axis=1)[:, :most] if most else np.zeros((len(sims), 0), int)
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, 1), axis=1, kind="stable"), 1)
        kept = robust_prune(points, near, x, DEGREE, ALPHA)
        at, k = np.nonzero(kept)
        ends.append(np.column_stack([at + start, near[at, k]]))
    there = np.concatenate(ends)
    pairs = np.unique(np.concatenate([there, there[:, ::-1]]), axis=0)  # links go both ways
    sims = np.einsum("ij,ij->i", x[pairs[:, 0]], x[pairs[:, 1]])
    pairs = pairs[np.lexsort((-sims, pairs[:, 0]))]
    rank = np.arange(len(pairs)) - np.searchsorted(pairs[:, 0], pairs[:, 0], "left")
    pairs = pairs[rank < 2 * DEGREE]
    bounds = np.searchsorted(pairs[:, 0], np.arange(len(ids) + 1))
    out = [ids[pairs[a:b, 1]].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.table({"id": pa.array(ids, pa.int64()), "out": pa.array(out, pa.list_(pa.int64()))})


def range_search(q: np.ndarray, seeds: list[np.ndarray], x: np.ndarray, links: list[np.ndarray], beam: int, threshold: float) -> list[np.ndarray]:
    """Members in range of each query: greedy beam from the medoid, then expansion in range."""
    n, width = len(x), max(1, max(len(a) for a in links))
    table = np.full((n, width), -1)
    for i, a in enumerate(links):
        table[i, : len(a)] = a
    onward = np.where(table < 0, n, table)
    medoid = int((x @ x.mean(0)).argmax())
    beam = min(beam, n)
    found: list[np.ndarray] = []
    for start in range(0, len(q), 256):
        part = q[start : start + 256]
        m = len(part)
        best = np.full((m, beam), -1)
        score = np.full((m, beam), -2.0)
        done = np.ones((m, beam), bool)
        best[:, 0], score[:, 0], done[:, 0] = medoid, part @ x[medoid], False
        seen = np.zeros((m, n), bool)
        seen[:, medoid] = True
        rows = np.arange(m)
        while True:
            open_score = np.where(done, -3.0, score)
            pick = np.argsort(-open_score, axis=1, kind="stable")[:, :EXPAND]
            useful = np.take_along_axis(open_score, pick, 1) > -3
            active = rows[useful.any(1)]
            if not len(active):
                break
            pick, useful = pick[active], useful[active]
            near = np.where(useful[:, :, None], table[np.take_along_axis(best[active], pick, 1)], -1).reshape(len(active), -1)
            done[active[:, None], pick] = True
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            fresh = (near >= 0) & ~seen[active[:, None], near]
            seen[active[:, None], np.where(near >= 0, near, medoid)] = True
            sims = np.where(fresh, np.matmul(x[near], part[active][:, :, None])[:, :, 0], -2.0)
            all_best = np.concatenate([best[active], np.where(fresh, near, -1)], 1)
            all_score = np.concatenate([score[active], sims], 1)
            all_done = np.concatenate([done[active], ~fresh], 1)
            top = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
            best[active], score[active] = np.take_along_axis(all_best, top, 1), np.take_along_axis(all_score, top, 1)
            done[active] = np.take_along_axis(all_done, top, 1)
        for i in range(m):
            known = np.zeros(n + 1, bool)
            known[n] = True
            frontier = np.unique(np.concatenate([best[i][best[i] >= 0], seeds[start + i]]).astype(np.int64))
            known[frontier] = True
            hits = []
            while len(frontier):
                near = x[frontier] @ part[i]
                hits.append(frontier[near >= threshold])
                reach = onward[frontier[1 - near <= SLACK * (1 - threshold)]].ravel()
                fresh = reach[~known[reach]]
                known[fresh] = True
                frontier = np.unique(fresh)
            found.append(np.concatenate(hits))
    return found


class Forest:
    """Links among a task's ids, reduced to one root per group while they come in."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.parent = ids, np.arange(len(ids))

    def _roots(self, at: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[at]
            if np.array_equal(up, at):
                return at
            at = up

    def link(self, ids: np.ndarray) -> None:
        roots = self._roots(np.searchsorted(self.ids, ids))
        self.parent[roots] = roots.min()

    def root_of(self, ids: np.ndarray) -> np.ndarray:
        return self.ids[self._roots(np.searchsorted(self.ids, ids))]


def _search(beam: int, threshold: float, overlap: int):
    def run(key, probes: pa.Table, members: pa.Table) -> pa.Table:
        q_ids, count = probes["id"].to_numpy(), np.zeros(probes.num_rows, np.int64)
        far: list[list[int]] = [[] for _ in range(probes.num_rows)]
        forest = Forest(np.unique(q_ids))  # members of a cell are among those that search it
        if probes.num_rows and members.num_rows:
            cell = key[0].as_py()
            ids = members["m_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, sizes = ids[order], members["m_n"].to_numpy()[order]
            x = np.array(_numbers(members["m_v"]))[order]
            place = lambda out: (lambda at: at[ids[at] == out])(np.minimum(np.searchsorted(ids, out), len(ids) - 1)) if len(out) else np.zeros(0, np.int64)
            own = lambda column: [place(np.asarray(o if o is not None else [], np.int64)) for o in column.to_pylist()]
            links = own(members["m_out"])
            links = [links[i] for i in order]
            cells = members["m_cells"].to_pylist()
            homes = np.full((len(ids), overlap), np.iinfo(np.int64).min)
            for i, at in enumerate(order):
                homes[i, : min(overlap, len(cells[at]))] = cells[at][:overlap]
            q = np.array(_numbers(probes["v"]))
            asked = probes["cells"].to_pylist()
            for i, hits in enumerate(range_search(q, own(probes["out"]), x, links, beam, threshold)):
                hits = hits[ids[hits] != q_ids[i]]
                if len(hits):
                    forest.link(np.append(ids[hits], q_ids[i]))
                    mine = asked[i][:overlap]
                    if cell in mine:  # the first cell that is both theirs counts
                        count[i] = sizes[hits[~np.isin(homes[hits], mine[: mine.index(cell)]).any(1)]].sum()
                    else:
                        far[i] = ids[hits[~np.isin(homes[hits], mine).any(1)]].tolist()
        return pa.table({"id": q_ids, "others": count, "root": forest.root_of(q_ids), "far": pa.array(far, pa.list_(pa.int64()))})

    return run


def _links(classes: DataFrame, threshold: float, overlap: int, beam: int, shard_rows: int) -> DataFrame:
    """id, others (vectors linked in this block), root (a class of the same component), far (linked
    classes that share no own cell with it): a row per class and block that it searched."""
    n = classes.count()
    # pivots are a bounded sample; their number follows the table up to MOST_PIVOTS
    wanted = max(1, min(MOST_PIVOTS, overlap * n // shard_rows))
    pivots = [np.frombuffer(r["v"], np.float64) for r in classes.orderBy(F.xxhash64("id"), "id").limit(wanted).select("v").collect()]
    homes = written(_cells(classes, pivots, overlap), "graph-cells")
    sizes = {r["cell"]: r["count"] for r in homes.filter("own").groupBy("cell").count().collect()}  # one row per pivot
    blocks = F.create_map(*[F.lit(int(x)) for c, k in sizes.items() for x in (c, max(1, round(k / shard_rows)))])[F.col("cell")] if sizes else F.lit(1)
    members = homes.filter("own").withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    graphs = members.groupBy("cell", "block").applyInArrow(_graph, "id long, out array<long>")
    united = written(
        graphs.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("out"))).alias("out")), "graph-united"
    )  # at most `overlap` lists per class
    members = members.join(united, "id").select(
        "cell", "block", F.col("id").alias("m_id"), F.col("v").alias("m_v"), F.col("n").alias("m_n"), F.col("cells").alias("m_cells"), F.col("out").alias("m_out")
    )
    probes = homes.withColumn("_block", F.explode(F.sequence(F.lit(0), F.coalesce(blocks - 1, F.lit(0)).cast("int")))).join(
        united.select(F.col("id").alias("_id"), F.col("out")), F.col("id") == F.col("_id")
    ).select("id", "v", "cells", F.col("cell").alias("_cell"), "_block", "out")
    found = probes.groupBy("_cell", "_block").cogroup(members.groupBy("cell", "block")).applyInArrow(
        _search(beam, threshold, overlap), "id long, others long, root long, far array<long>"
    )
    return written(found.filter("others > 0 OR id <> root OR size(far) > 0"), "graph-links")


def _totals(links: DataFrame, classes: DataFrame) -> DataFrame:
    """id, others: vectors of other classes linked with each class, whichever of both found it."""
    far = links.select("id", F.explode("far").alias("to")).select(F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b")).distinct()
    both = far.unionByName(far.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(classes.select(F.col("id").alias("b"), "n"), "b")
    rows = links.select("id", "others").unionByName(both.select(F.col("a").alias("id"), F.col("n").alias("others")))
    return rows.groupBy("id").agg(F.sum("others").alias("others"))


def _audit(classes: DataFrame, totals: DataFrame, threshold: float, sample: int) -> float:
    """Mean share of the linked vectors of a class that were found, over drawn classes that have
    any; 1 where none of AUDIT_MOST drawn classes has one."""
    while True:
        drawn = classes.orderBy(F.xxhash64(F.lit("audit"), "id"), "id").limit(sample).select("id", "v").collect()
        found = classes.sparkSession.createDataFrame([(r["id"],) for r in drawn], "id long").join(totals, "id")
        hit = {r["id"]: r["others"] for r in found.collect()}  # as many as were drawn
        true = {r["id"]: r["n"] for r in _true_counts(classes, drawn, threshold).collect()}
        linked = [i for i, n in true.items() if n]
        if len(linked) >= AUDIT_LINKED or len(drawn) < sample or sample >= AUDIT_MOST:
            return float(np.mean([hit.get(i, 0) / true[i] for i in linked])) if linked else 1.0
        sample *= 4


def _true_counts(classes: DataFrame, drawn: list, threshold: float) -> DataFrame:
    """id, n: vectors of other classes in range of each drawn class, by brute force."""
    q_ids, q = np.array([r["id"] for r in drawn], np.int64), [np.frombuffer(r["v"], np.float64) for r in drawn]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, rows = batch.column(0).to_numpy(), batch.column(2).to_numpy(), _numbers(batch.column(1))
            total = np.zeros(len(q_ids), np.int64)
            for width in {len(v) for v in rows}:
                at = np.array([i for i, v in enumerate(rows) if len(v) == width])
                mine = np.array([i for i, v in enumerate(q) if len(v) == width], np.int64)
                if len(mine):
                    near = np.array([q[i] for i in mine]) @ np.array([rows[i] for i in at]).T >= threshold
                    total[mine] += (near & (q_ids[mine][:, None] != ids[at])) @ sizes[at]
            yield pa.RecordBatch.from_arrays([pa.array(q_ids), pa.array(total)], ["id", "n"])

    counted = classes.select("id", "v", "n").mapInArrow(run, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP, beam: int = BEAM,
                    shard_rows: int = SHARD_ROWS, recall: float = RECALL, audit: int = AUDIT) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    keys = ["_h1", "_h2"]
    usable = vectors.filter(_is_usable()).select(
        F.col("vec_id").cast("long"), "embedding", F.xxhash64("embedding").alias("_h1"), F.xxhash64(F.lit(1), "embedding", F.size("embedding")).alias("_h2")
    )
    grouped = usable.groupBy(*keys).agg(F.min_by("embedding", "vec_id").alias("embedding"), F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
    by_key = written(grouped, "graph-classes")
    classes = written(by_key.select("id", "embedding", "n").mapInArrow(_unit, "id long, n long, v binary"), "graph-units")
    for _ in range(3):
        links = _links(classes, threshold, overlap, beam, shard_rows)
        totals = written(_totals(links, classes), "graph-totals")
        measured = _audit(classes, totals, threshold, audit)
        if measured >= recall:
            break
        overlap, beam = overlap + 2, beam * 2
    else:
        if measured < LEAST_RECALL:
            raise ValueError(f"near_duplicates found {measured:.3f} of the audited links, less than {LEAST_RECALL}")
    degree = totals.withColumnRenamed("id", "a")
    group = components(links, "id", "root")
    per_class = (
        by_key.select(*keys, "id", "n")
        .join(degree, F.col("id") == F.col("a"), "left")
        .join(group, F.col("id") == F.col("node"), "left")
        .select(*keys, (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    linked = usable.select("vec_id", *keys).join(per_class, keys).select("vec_id", "n_links", "component_id")
    odd = vectors.select(F.col("vec_id").cast("long"), "embedding").filter(~_is_usable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(odd).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
