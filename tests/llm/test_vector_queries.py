"""The registered vector queries, with production parameters, against brute force (sf0.001)."""

import numpy as np
import pyarrow as pa
import pytest

from sprintlens.llm import flat_graph
from sprintlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)


def test_op2(spark, vectors):
    ids, x = vectors
    whole = np.floor(64 * x).astype(np.int64)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in QUERIES["op2_cover_tree"](spark, FOLDER).collect()}
    want = {}
    for i in np.flatnonzero(ids % 20 == 0):
        score = whole @ whole[i]
        best = sorted((-int(s), int(v)) for s, v in zip(score, ids) if v != ids[i])[:20]
        want |= {(int(ids[i]), k + 1): (v, -s) for k, (s, v) in enumerate(best)}
    assert got == want


def test_op3(spark, vectors):
    ids, x = vectors
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in QUERIES["op3_flat_graph"](spark, FOLDER).collect()}
    assert len(got) == len(ids)
    links = np.array([got[i].n_links for i in ids])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.97 * near.sum()
    for i in ids:
        assert got[i].kept == (got[i].component_id == i) and got[got[i].component_id].component_id == got[i].component_id


def test_audit_fails_a_search_that_loses_links(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 8))
    x = np.concatenate([base, base + 0.01 * rng.normal(size=base.shape)])
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert sum(r.n_links for r in flat_graph.near_duplicates(df).collect()) >= 78

    def finds_nothing(key, probes, members):
        none = pa.array(np.zeros(probes.num_rows, np.int64))
        far = pa.array([[]] * probes.num_rows, pa.list_(pa.int64()))
        return pa.table({"id": probes["id"], "others": none, "root": probes["id"], "far": far})

    monkeypatch.setattr(flat_graph, "_search", lambda *args: finds_nothing)
    with pytest.raises(ValueError):
        flat_graph.near_duplicates(df)
