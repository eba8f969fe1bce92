"""Vector search and near duplicates against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sprintlens.llm import cover_tree, flat_graph
from sprintlens.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, id long, pivot int, shard long"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2, 3) for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 16))
    x = np.concatenate([x, x[:60] + rng.normal(size=(60, 16)) * 0.05, np.repeat(x[5:6], 40, 0)])
    out = list(enumerate(x / np.linalg.norm(x, axis=1, keepdims=True)))
    out += [(1000, None), (1001, [None] * 16), (1002, [float("nan")] * 16), (1003, [0.0] * 16), (None, [1.0] * 16)]
    return out


def test_top_k_equals_brute_force(spark, rows):
    found = {}
    for r in cover_tree.top_k(table(spark, rows).repartition(3), F.col("vec_id") % 20 == 0, k=7, shard_rows=90, group_rows=6, pivots=4).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    usable = [(i, np.floor(64 * np.float32(v).astype(float))) for i, v in rows if i is not None and v is not None and i not in (1001, 1002)]
    queries = [i for i, _ in usable if i % 20 == 0]
    assert sorted(found) == sorted(queries)
    vectors = dict(usable)
    for q in queries:
        best = sorted(((-int(vectors[q] @ v), i) for i, v in usable if i != q))[:7]
        assert [found[q][k + 1] for k in range(7)] == [(i, -s) for s, i in best]


def test_top_k_of_few_and_none(spark):
    two = table(spark, [(0, [0.5, 0.5]), (1, [0.1, 0.2]), (1, [0.1, 0.2])])
    assert [(r.query_id, r["rank"], r.vec_id) for r in cover_tree.top_k(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1)]
    assert cover_tree.top_k(two.limit(0), F.col("vec_id") == 0).count() == 0


def test_tree_bounds_hold():
    rng = np.random.default_rng(0)
    tree = cover_tree.Tree(np.arange(500), rng.integers(-64, 64, (500, 8)).astype(np.int32), 20)
    for c, r, s, e in zip(tree.center, tree.radius, tree.start, tree.end):
        assert np.sqrt(((tree.vectors[s:e] - c) ** 2).sum(1)).max() <= r + 1e-9


def test_near_duplicates_equal_brute_force(spark, rows):
    out = {r.vec_id: r for r in flat_graph.near_duplicates(table(spark, rows), shard_rows=120).collect()}
    assert len(out) == len(rows)
    usable = [(i, np.float32(v).astype(float)) for i, v in rows if i is not None and i < 1000]
    x = np.array([v / np.linalg.norm(v) for _, v in usable])
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    links = sum(out[i].n_links for i, _ in usable)
    assert links >= 0.97 * near.sum() and all(out[i].n_links <= near[k].sum() for k, (i, _) in enumerate(usable))
    assert all(out[i].n_links == 0 and out[i].kept for i in (1000, 1001, 1002, 1003))
    assert out[5].n_links >= 40 and out[399].component_id == out[5].component_id <= 5 and not out[399].kept
    assert flat_graph.near_duplicates(table(spark, [])).count() == 0


def test_components_of_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 10 for i in range(10, 41)}, **{i: 100 for i in range(100, 160)}, 3: 3, 200: 3}
