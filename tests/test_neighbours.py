"""Exact nearest rows in pivot cells against brute force."""

import numpy as np
import pytest

from sprintlens.operators import neighbours


def brute(x, k):
    out = {}
    for i, row in enumerate(x):
        d = np.zeros(len(x))
        for j in range(x.shape[1]):
            d += (row[j] - x[:, j]) ** 2
        order = sorted((float(v), f"r{j}") for j, v in enumerate(d) if j != i)
        out[f"r{i}"] = [name for _, name in order[:k]]
    return out


CASES = {
    "spread": lambda rng: rng.normal(size=(400, 5)),
    "clusters": lambda rng: np.concatenate([rng.normal(c, 0.05, (80, 3)) for c in (0, 1, 5)] + [rng.normal(0, 30, (60, 3))]),
    "grid with ties": lambda rng: rng.integers(0, 5, (400, 2)).astype(float),
    "one hot vector": lambda rng: np.concatenate([np.zeros((200, 3)), rng.normal(size=(200, 3))]),
    "all equal": lambda rng: np.ones((60, 2)),
    "few": lambda rng: rng.normal(size=(4, 2)),
    "one": lambda rng: np.ones((1, 2)),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("cell_rows", [25, 5000])
def test_equal_to_brute_force(spark, name, cell_rows):
    x = np.round(CASES[name](np.random.default_rng(3)), 3)
    df = spark.createDataFrame([(f"r{i}", [float(v) for v in r]) for i, r in enumerate(x)], "i string, x array<double>")
    rows = neighbours.nearest_rows(df, "i", 5, cell_rows=cell_rows).collect()
    assert {r["id"]: [n["other"] for n in r["neighbours"]] for r in rows} == brute(x, 5) and len(rows) == len(x)
    assert all([n["rank"] for n in r["neighbours"]] == list(range(1, len(r["neighbours"]) + 1)) for r in rows)


def test_empty(spark):
    df = spark.createDataFrame([], "i string, x array<double>")
    assert neighbours.nearest_rows(df, "i").count() == 0


def test_rings_spare_most_copies():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.1, (200, 3)) for c in range(10)])
    pivots = x[::50]
    d = np.sqrt(neighbours.squared(x, pivots))
    cell, r = d.argmin(1), d.min(1)
    radius = np.array([r[cell == c].max() for c in range(len(pivots))])
    near = [np.sort(r[cell == c])[:6] for c in range(len(pivots))]
    bound = neighbours.cell_bounds(pivots, radius, near, 5)
    point, foreign = neighbours.copies(x, cell, pivots, radius, bound)
    assert len(point) < len(x) * len(pivots) / 5
    copied = set(zip(point.tolist(), foreign.tolist()))
    for i in range(0, len(x), 37):  # no neighbour is spared
        order = np.argsort(((x - x[i]) ** 2).sum(1))[:6]
        assert all(cell[j] == cell[i] or (j, cell[i]) in copied for j in order)
