"""Boosted trees: gains, leaf order, both ways of training, search, exact contributions."""

import heapq
import itertools
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.operators import boosting, models, scoring, search, shapley, stages
from sprintlens.operators.boosting import Layout, Settings
from sprintlens.sources import readers, writers

FEATURES = ("a", "b", "c", "d")


def made_rows(n=260, seed=1, missing=0.15):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 4)), 1)
    x[:, 3] = x[:, 3] > 0
    y = (x[:, 0] + x[:, 1] * x[:, 3] + 0.4 * rng.normal(size=n) > 0).astype(float)
    x[rng.random((n, 4)) < missing] = np.nan
    return x, y


def layout_of(x):
    return Layout(FEATURES, tuple(tuple(np.unique(c[~np.isnan(c)]).tolist()) for c in x.T))


@pytest.fixture(scope="module")
def table(spark):
    x, y = made_rows()
    rows = [(f"r{i}", float(t), *[None if np.isnan(v) else float(v) for v in r]) for i, (t, r) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, "sprint_id string, y double, a double, b double, c double, d double").repartition(3).persist()
    yield df
    df.unpersist()


def naive_split(x, g, h, s):
    """Best cut of one node by trying every value of every feature, both ways for missing values."""
    def score(mask):
        total = np.sign(g[mask].sum()) * max(abs(g[mask].sum()) - s.reg_alpha, 0)
        return total**2 / (h[mask].sum() + s.reg_lambda)
    best = (-np.inf, None)
    for k in range(x.shape[1]):
        for cut in np.unique(x[:, k][~np.isnan(x[:, k])]):
            for missing_left in (False, True):
                left = np.where(np.isnan(x[:, k]), missing_left, x[:, k] <= cut).astype(bool)
                right = ~left
                if min(h[left].sum(), h[right].sum()) < s.min_child_weight or min(left.sum(), right.sum()) < s.min_child_samples or not left.any() or not right.any():
                    continue
                gain = score(left) + score(right) - score(left | right)
                if gain > best[0] + 1e-9:
                    best = (gain, (k, cut, missing_left))
    return best


SOME = [
    Settings(reg_alpha=0.0, min_child_weight=1.0),
    Settings(reg_alpha=2.5, reg_lambda=7.0, min_child_weight=6.0),
    Settings(gamma=3.0, min_child_samples=40, min_child_weight=0.0),
]


@pytest.mark.parametrize("s", SOME)
def test_gains_equal_trying_every_cut(s):
    x, y = made_rows()
    layout = layout_of(x)
    bins, starts = layout.binned(list(x.T)), layout.starts
    g, h = boosting.gradients(np.linspace(-1, 1, len(y)), y, (1.0, 0.7))
    node = np.arange(len(y)) % 3 - 1
    columns = np.ones(4, bool)
    dense = boosting.best_splits(boosting.counted(bins, node, 2, g, h, int(starts[-1])), starts, s, columns)
    pairs, totals = boosting.Entries(bins).best_splits(node, 2, g, h, starts, s, columns)
    for k in range(2):
        mine = node == k
        gain, where = naive_split(x[mine], g[mine] / boosting.UNIT, h[mine] / boosting.UNIT, s)
        assert totals[k].tolist() == [g[mine].sum(), h[mine].sum(), mine.sum()]
        for got in (dense[k], pairs[k]):
            if gain < max(s.gamma, boosting.LEAST_GAIN):
                assert got is None
            else:
                assert got["gain"] == pytest.approx(gain) and got["feature"] == where[0]
                assert layout.cuts[where[0]][got["cut"] - starts[where[0]]] == where[1]
        assert (dense[k] is None) == (pairs[k] is None) and (dense[k] is None or dense[k]["cut"] == pairs[k]["cut"])


def naive_leafwise(x, g, h, s):
    """Leaves from a queue that always splits the leaf with the highest gain."""
    queue, leaves, count = [], [], itertools.count()
    def offer(rows, depth):
        gain, where = naive_split(x[rows], g[rows], h[rows], s) if depth < s.max_depth else (-np.inf, None)
        if gain >= boosting.LEAST_GAIN:
            heapq.heappush(queue, (-gain, next(count), rows, depth, where))
        else:
            leaves.append(rows)
    offer(np.arange(len(x)), 0)
    order = []
    while queue and len(order) < s.num_leaves - 1:
        gain, _, rows, depth, (k, cut, missing_left) = heapq.heappop(queue)
        order.append(-gain)
        left = np.where(np.isnan(x[rows, k]), missing_left, x[rows, k] <= cut).astype(bool)
        offer(rows[left], depth + 1)
        offer(rows[~left], depth + 1)
    leaves += [rows for _, _, rows, _, _ in queue]
    return order, {tuple(sorted(r.tolist())) for r in leaves}


@pytest.mark.parametrize("leaves,depth", [(6, 9), (9, 3), (300, 4)])
def test_best_leaf_first(leaves, depth):
    x, y = made_rows(seed=4)
    layout = layout_of(x)
    bins = layout.binned(list(x.T))
    s = Settings(n_estimators=1, num_leaves=leaves, max_depth=depth, min_child_samples=7, min_child_weight=1e-3, reg_lambda=0.5, scale_pos_weight=None)
    forest = boosting.fit_rows(layout, bins, y, np.arange(len(y)), s)
    positives = int(y.sum())
    w = boosting.weights_of(s, positives, len(y) - positives)
    g, h = boosting.gradients(np.full(len(y), boosting.start_margin(w, positives, len(y) - positives)), y, w)
    order, want = naive_leafwise(x, g / boosting.UNIT, h / boosting.UNIT, s)
    at = forest.trees[0].leaf_of(bins, layout.starts)
    assert {tuple(np.flatnonzero(at == leaf).tolist()) for leaf in np.unique(at)} == want
    assert len(want) == len(order) + 1 <= leaves
    for leaf in np.unique(at):
        rows = at == leaf
        assert forest.trees[0].value[leaf] == pytest.approx(-s.learning_rate * g[rows].sum() / (h[rows].sum() + s.reg_lambda * boosting.UNIT))
        assert forest.trees[0].cover[leaf] == rows.sum()


def same(a, b):
    return len(a.trees) == len(b.trees) and a.base == b.base and all(
        np.array_equal(getattr(s, c), getattr(t, c)) for s, t in zip(a.trees, b.trees) for c in stages.COLUMNS
    )


def test_both_ways_of_training_give_the_same_trees(spark, table, monkeypatch):
    monkeypatch.setattr(boosting, "WRITE_EVERY", 2)
    trials = {
        3: Settings(n_estimators=4, max_depth=3, subsample=0.7, colsample_bytree=0.6, reg_alpha=0.1, gamma=0.2, scale_pos_weight=0.6),
        5: Settings(n_estimators=5, max_depth=4, num_leaves=5, min_child_samples=9, min_child_weight=1e-3, scale_pos_weight=None, learning_rate=1.0, patience=2),
    }
    fit_part, seen = table.where("c IS NULL OR c < 0.6"), table.where("c >= 0.6")
    args = (fit_part, trials, FEATURES, "y", "sprint_id", seen)
    one, many = boosting.fit(*args), boosting.fit(*args, one_task_rows=10)
    assert all(same(one[t], many[t]) for t in trials)
    assert 0 < len(one[5].trees) < 5  # the watched loss rose before the last round
    again = boosting.fit(fit_part.repartition(7), *args[1:])
    assert all(same(one[t], again[t]) for t in trials)


def test_rows_and_columns_are_drawn_in_their_shares():
    s = Settings(subsample=0.3, colsample_bytree=0.5)
    keys = np.arange(-20_000, 20_000)
    assert abs(boosting.drawn_rows(keys, 1, s).mean() - 0.3) < 0.01
    assert (boosting.drawn_rows(keys, 1, s) != boosting.drawn_rows(keys, 2, s)).mean() > 0.3
    assert [boosting.drawn_columns(15, i, s).sum() for i in range(5)] == [7] * 5


def test_fits_of_empty_and_one_sided_tables(spark, table):
    for rows in (table.limit(0), table.where("y = 1"), table.select("sprint_id", "y", *[F.lit(None).cast("double").alias(f) for f in FEATURES])):
        for s in (Settings(n_estimators=2), Settings(n_estimators=2, num_leaves=4, scale_pos_weight=None)):
            forest = boosting.fit(rows, {0: s}, FEATURES, "y")[0]
            p = scoring.predict(stages.BoostedTrees(forest), table).agg(F.min("p"), F.max("p")).first()
            assert 0 <= p[0] == p[1] <= 1


# -- proposals ---------------------------------------------------------------------------


def test_densities_add_up_to_one_and_follow_the_points():
    centres, widths = search.parzen(np.array([1.0, 1.5, 7.0]), 0.0, 10.0)
    assert centres.tolist() == [1.0, 1.5, 7.0, 5.0] and widths.tolist() == [2.0, 3.5, 3.0, 10.0]
    grid = np.linspace(0, 10, 20_001)
    density = np.exp(search.log_density(grid, centres, widths, 0.0, 10.0))
    assert density.mean() * 10 == pytest.approx(1, abs=1e-3)
    def normal(v, c, w):
        cdf = lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2)))
        return math.exp(-0.5 * ((v - c) / w) ** 2) / (w * math.sqrt(2 * math.pi) * (cdf((10 - c) / w) - cdf(-c / w)))
    want = np.mean([normal(2.0, c, w) for c, w in zip(centres, widths)])
    assert math.exp(search.log_density(np.array([2.0]), centres, widths, 0.0, 10.0)[0]) == pytest.approx(want)


def test_good_trials_are_the_best_tenth_earlier_ones_first():
    done = [(i, {"n": i}, f2) for i, f2 in enumerate([0.5, 0.9, 0.9, 0.1] + [0.3] * 11)]
    good, others = search.split_trials(done)
    assert [p["n"] for p in good] == [1, 2] and [p["n"] for p in others][:3] == [0, 4, 5] and others[-1] == {"n": 3}


@pytest.mark.parametrize("family", search.SPACES)
def test_proposals_stay_in_the_space_and_move_to_good_values(family):
    random = [search.propose(family, i, []) for i in range(40)]
    assert random[3] == search.propose(family, 3, [])
    for p in random:
        for name, (kind, low, high) in search.SPACES[family].items():
            assert low <= p[name] <= high and isinstance(p[name], int if kind == "int" else float)
    assert search.SPACES[family].keys() == random[0].keys()
    done = [(i, p, 1.0 - abs(p["max_depth"] - 8) / 10 - abs(math.log(p["learning_rate"] / 0.02)) / 10) for i, p in enumerate(random)]
    later = [search.propose(family, 40 + i, done) for i in range(60)]
    assert np.mean([p["max_depth"] for p in later]) > np.mean([p["max_depth"] for p in random]) + 1
    gap = lambda ps: np.mean([abs(math.log(p["learning_rate"] / 0.02)) for p in ps])
    assert gap(later) < gap(random)
    assert set(search.settings_of(family, later[0], True).__dict__) >= set(later[0])


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        values = {f: float(rng.integers(0, 5)) for f in P.FEATURES}
        y = float(values["num_bugs_sprint"] + 0.5 * values["log_avg_cycle_time"] + rng.normal() > 3)
        rows.append((f"s{i}", ("train", "train", "val", "test")[i % 4], y, *values.values()))
    names = ", ".join(f"{f} double" for f in P.FEATURES)
    df = spark.createDataFrame(rows, f"sprint_id string, split string, {P.LABEL} double, {names}").persist()
    yield df
    df.unpersist()


def test_search_is_resumed_by_what_is_stored(spark, matrix, tmp_path, monkeypatch):
    short = {k: v | {"n_estimators": ("int", 2, 4)} for k, v in search.SPACES.items()}
    monkeypatch.setattr(search, "SPACES", short)
    monkeypatch.setattr(search, "BATCHES", (10, 12))
    fitted, whole = [], boosting.fit
    monkeypatch.setattr(boosting, "fit", lambda rows, trials, *a, **k: fitted.append(len(trials)) or whole(rows, trials, *a, **k))
    train, val = (matrix.where(F.col("split") == s) for s in ("train", "val"))
    path = str(tmp_path / "trials")
    models.tree_search(path, train, val, 11)
    assert fitted == [20, 2]
    table = models.tree_search(path, train, val, 13)
    assert fitted == [20, 2, 2, 2]
    rows = table.collect()
    assert sorted((r["study"], r["trial"]) for r in rows) == sorted((f, i) for f in models.FAMILIES for i in range(13))
    whole_run = models.tree_search(str(tmp_path / "other"), train, val, 13).collect()
    assert {(r["study"], r["trial"], r["params"], r["f2"]) for r in rows} == {(r["study"], r["trial"], r["params"], r["f2"]) for r in whole_run}
    one = rows[0]
    settings = search.settings_of(one["study"], json.loads(one["params"]), watched=True)
    forest = boosting.fit(train, {0: settings}, label=P.LABEL, watched=val)[0]
    suite = models.measured(scoring.predict(stages.BoostedTrees(forest), val).withColumn("k", F.lit(1)), ["k"]).first()
    assert (suite["f2"], suite["brier"]) == (one["f2"], one["brier"])


# -- saved models --------------------------------------------------------------------------


def test_saved_pipeline_of_trees_and_map_scores_alike(spark, table, tmp_path):
    trees = stages.BoostedTrees(boosting.fit(table, {0: Settings(n_estimators=5)}, FEATURES, "y")[0])
    for i, calibration in enumerate((stages.SigmoidMap({"a": 3.0, "b": -1.0}), stages.StepMap({"scores": [0.1, 0.4, 0.8], "values": [0.0, 0.5, 0.9]}))):
        path = str(tmp_path / f"model{i}")
        model = stages.as_pipeline(stages.as_pipeline(trees), calibration)
        writers.save_model(model, path)
        loaded = readers.load_model(path)
        p = {r[0]: r[1] for r in scoring.predict(model, table).select("sprint_id", "p").collect()}
        raw = {r[0]: r[1] for r in scoring.predict(trees, table).select("sprint_id", "p").collect()}
        assert p == {r[0]: r[1] for r in scoring.predict(loaded, table).select("sprint_id", "p").collect()}
        want = (lambda v: 1 / (1 + math.exp(-(3 * v - 1)))) if i == 0 else (lambda v: np.interp(v, [0.1, 0.4, 0.8], [0.0, 0.5, 0.9]))
        assert all(p[k] == pytest.approx(want(raw[k])) for k in raw)


# -- contributions -----------------------------------------------------------------------


def enumerated(tree, row, starts, size):
    """Shapley values over all feature sets; absent features are averaged by cover."""
    def value(known, node=0):
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        left, right = tree.left[node], tree.right[node]
        if f in known:
            goes_left = tree.missing_left[node] if row[f] == starts[f + 1] - 1 else row[f] <= tree.cut[node]
            return value(known, left if goes_left else right)
        return (tree.cover[left] * value(known, left) + tree.cover[right] * value(known, right)) / tree.cover[node]
    out = np.zeros(size)
    for i in range(size):
        others = [j for j in range(size) if j != i]
        for k in range(size):
            weight = math.factorial(k) * math.factorial(size - k - 1) / math.factorial(size)
            out[i] += weight * sum(value({*c, i}) - value(set(c)) for c in itertools.combinations(others, k))
    return out


@pytest.mark.parametrize("leaves", [None, 12])
def test_tree_contributions_equal_all_feature_sets(spark, table, leaves):
    s = Settings(n_estimators=3, max_depth=5, num_leaves=leaves, min_child_weight=0.5)
    forest = boosting.fit(table, {0: s}, FEATURES, "y")[0]
    got = shapley.tree_contributions(stages.as_pipeline(stages.BoostedTrees(forest)), table, "sprint_id").collect()
    mine = {(r["sprint_id"], r["feature"]): r["contribution"] for r in got}
    rows = table.collect()
    bins = forest.layout.binned([np.array([np.nan if r[f] is None else r[f] for r in rows]) for f in FEATURES])
    margin = forest.margin(bins)
    for i, r in enumerate(rows):
        assert forest.base is not None
        total = sum(mine[r["sprint_id"], f] for f in FEATURES)
        assert total + shapley.expected_margin(forest) == pytest.approx(margin[i])
        if i % 20 == 0:
            want = sum(enumerated(t, bins[i], forest.layout.starts, 4) for t in forest.trees)
            assert [mine[r["sprint_id"], f] for f in FEATURES] == pytest.approx(want.tolist())


class Score:
    """A model whose probability is a given expression."""

    def __init__(self, expression):
        self.expression = expression

    def transform(self, df):
        from pyspark.ml.functions import array_to_vector
        p = F.expr(self.expression)
        return df.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def kernel(df, expression, features, **options):
    rows = shapley.kernel_contributions(Score(expression), df, features, "i", **options).collect()
    return {(r["i"], r["feature"]): r["contribution"] for r in rows}


def test_kernel_contributions_equal_exact_values(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(12, 4)), 2)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i long, a double, b double, c double, d double")
    got = kernel(df, "a * b + 3 * c * d + a", FEATURES)
    f = lambda v: v[0] * v[1] + 3 * v[2] * v[3] + v[0]
    mean = x.mean(0)
    for i, row in enumerate(x):
        for k, name in enumerate(FEATURES):
            want = 0.0
            for size in range(4):
                for c in itertools.combinations([j for j in range(4) if j != k], size):
                    weight = math.factorial(size) * math.factorial(3 - size) / 24
                    base = np.where(np.isin(range(4), c), row, mean)
                    more = np.where(np.isin(range(4), [*c, k]), row, mean)
                    want += weight * (f(more) - f(base))
            assert got[i, name] == pytest.approx(want, abs=1e-9)


def test_kernel_contributions_of_a_linear_model_with_drawn_coalitions(spark):
    rng = np.random.default_rng(8)
    names = [f"x{i}" for i in range(9)]
    x = np.round(rng.normal(size=(6, 9)), 2)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "i long, " + ", ".join(f"{n} double" for n in names))
    got = kernel(df, " + ".join(f"{k + 1} * {n}" for k, n in enumerate(names)), names, budget=60)
    for i, row in enumerate(x):
        for k, n in enumerate(names):
            assert got[i, n] == pytest.approx((k + 1) * (row[k] - x[:, k].mean()), abs=1e-6)


# -- isotonic fit ----------------------------------------------------------------------------


def pooled_one_by_one(points):
    blocks = []
    for s, y, n in points:
        blocks.append([s, s, y, n])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][3] >= blocks[-1][2] / blocks[-1][3]:
            b = blocks.pop()
            blocks[-1] = [blocks[-1][0], b[1], blocks[-1][2] + b[2], blocks[-1][3] + b[3]]
    return [tuple(b) for b in blocks]


@pytest.mark.parametrize("order", ["random", "rising", "falling", "equal", "sawtooth"])
def test_isotonic_chunks_equal_one_pass(spark, order):
    from sprintlens.operators.isotonic import isotonic_blocks

    rng = np.random.default_rng(5)
    n = 400
    s = np.round(rng.random(n), 2) if order != "equal" else np.full(n, 0.5)
    rate = {"random": rng.random(n), "rising": s, "falling": 1 - s, "equal": s, "sawtooth": (s * 10) % 1}[order]
    y = (rng.random(n) < rate).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)] + [(None, 1), (0.3, None)], "p double, y int")
    want = pooled_one_by_one([(v, int(y[s == v].sum()), int((s == v).sum())) for v in np.unique(s)])
    for chunks in (1, 5, 8):
        got = sorted(map(tuple, isotonic_blocks(df, "y", "p", chunks).collect()))
        assert got == want
    assert isotonic_blocks(df.limit(0), "y", "p", 3).count() == 0


def test_a_fit_holds_few_bytes_a_row():
    """Bins, gradients and what a feature needs at a time; not all (row, feature) pairs at once."""
    import tracemalloc

    rng, n, k = np.random.default_rng(3), 60_000, 17
    x = rng.integers(0, 40, (n, k)).astype(float)
    layout = boosting.Layout(tuple(f"f{i}" for i in range(k)), tuple(tuple(map(float, range(40))) for _ in range(k)))
    bins, y = layout.binned(list(x.T)), (x[:, 0] + x[:, 1] > 39).astype(float)
    tracemalloc.start()
    try:
        forest = boosting.fit_rows(layout, bins, y, np.arange(n), Settings(n_estimators=2, max_depth=4))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(forest.trees) == 2 and peak < 250 * n


def test_counts_of_drawn_columns_are_those_of_all():
    x, y = made_rows()
    layout = layout_of(x)
    bins, starts = layout.binned(list(x.T)), layout.starts
    g, h = boosting.gradients(np.linspace(-1, 1, len(y)), y, (1.0, 0.7))
    node, size = np.arange(len(y)) % 3 - 1, int(starts[-1])
    whole = boosting.counted(bins, node, 2, g, h, size)
    drawn = boosting.counted(boosting.compact(bins, size), node, 2, g, h, size, starts, np.array([False, True, False, True]))
    assert not drawn[:, starts[2] : starts[3]].any()
    for k in (0, 1, 3):
        assert (drawn[:, starts[k] : starts[k + 1]] == whole[:, starts[k] : starts[k + 1]]).all()


def test_rows_end_at_the_leaves_that_trees_send_them_to():
    """Margins are kept up by the nodes in which rows ended, also below splits that best-first drops."""
    x, y = made_rows()
    layout = layout_of(x)
    bins, keys = layout.binned(list(x.T)), np.arange(len(y))
    for s in (Settings(n_estimators=6, max_depth=5, subsample=0.6), Settings(n_estimators=6, max_depth=7, num_leaves=5)):
        forest = boosting.fit_rows(layout, bins, y, keys, s)
        less = boosting.fit_rows(layout, bins, y, keys, boosting.replace(s, n_estimators=5))
        g, _ = boosting.gradients(less.margin(bins), y, (1.0, 1.0))
        drawn = boosting.drawn_rows(keys, 5, s)
        tree = forest.trees[5]
        ends = tree.leaf_of(bins, layout.starts)
        for leaf in np.unique(ends[drawn]):
            mine = drawn & (ends == leaf)
            _, h = boosting.gradients(less.margin(bins), y, (1.0, 1.0))
            assert tree.value[leaf] == pytest.approx(boosting.leaf_value(g[mine].sum() / boosting.UNIT, h[mine].sum() / boosting.UNIT, s))
