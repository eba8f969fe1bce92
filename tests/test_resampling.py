"""Bootstrap by splitting cells: exact sizes, the right distribution, repeatable."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sprintlens.operators import metrics, resampling


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    p = np.round(rng.random(700), 2)
    y = (rng.random(700) < p).astype(int)
    return spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)] + [(None, 1), (0.5, None)], "p double, y int").repartition(3).persist()


def test_draws_of_a_node_are_binomial():
    sizes = np.array([1, 5, 2, 12])
    drawn = resampling.split_draws(np.full(20_000, 20), sizes, 0, 3)
    assert (drawn.sum(0) == 20).all()
    assert np.allclose(drawn.mean(1), sizes, rtol=0.03)
    share = sizes / 20
    want = np.diag(share) - np.outer(share, share)  # covariance of one draw
    assert np.allclose(np.cov(drawn) / 20, want, atol=0.01)
    assert (drawn == resampling.split_draws(np.full(20_000, 20), sizes, 0, 3)).all()
    assert (drawn != resampling.split_draws(np.full(20_000, 20), sizes, 0, 4)).any()


def test_replicates_have_all_draws_and_repeat(spark, rows):
    counts = resampling.multinomial_counts(rows, "y", "p", 50)
    table = {(r["replicate"], r["s"]): (r["pos"], r["neg"]) for r in counts.collect()}
    for i in range(50):
        assert sum(a + b for (k, _), (a, b) in table.items() if k == i) == 700
    again = resampling.multinomial_counts(rows.repartition(5), "y", "p", 50)
    assert table == {(r["replicate"], r["s"]): (r["pos"], r["neg"]) for r in again.collect()}
    own = {(r["p"], r["y"]): r["n"] for r in rows.dropna().groupBy("p", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert all((b == 0 or (s, 0) in own) and (a == 0 or (s, 1) in own) for (_, s), (a, b) in table.items())
    assert resampling.multinomial_counts(rows.limit(0), "y", "p", 5).count() == 0


def test_intervals_match_draws_of_rows(rows):
    got = metrics.bootstrap_ci(resampling.multinomial_replicates(rows, "y", replicates=400, digits=None))
    mine = {r["metric"]: (r["ci_lo"], r["ci_hi"]) for r in got.collect()}
    data = np.array([(r["p"], r["y"]) for r in rows.dropna().collect()])
    rng = np.random.default_rng(1)
    def recall(d):
        return ((d[:, 0] >= 0.5) & (d[:, 1] == 1)).sum() / (d[:, 1] == 1).sum()
    drawn = [data[rng.integers(0, len(data), len(data))] for _ in range(400)]
    for name, f in (("recall", recall), ("brier", lambda d: ((d[:, 0] - d[:, 1]) ** 2).mean())):
        want = np.percentile([f(d) for d in drawn], [2.5, 97.5])
        assert np.allclose(mine[name], want, atol=0.012)
