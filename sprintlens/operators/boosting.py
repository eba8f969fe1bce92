"""Second-order boosted trees on binned features, for one or many parameter sets at once.

Features are cut at quantiles into at most BINS bins and a bin for missing values. A split's
worth is T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2) with G, H the sums of
gradients and hessians of the logistic loss and T(.) their shrinkage by l1; missing values go to
the better side. Trees grow by level, or best leaf first up to a number of leaves: a split's
worth depends on the rows of its node only, so a tree is grown by level and the best-first order
is then taken from a queue of leaves.

Gradients and hessians are rounded to multiples of 1 / UNIT and summed as integers. Sums do not
depend on the order of rows, tasks or retries, so both ways of training give the same trees:

* `fit_in_tasks`: tables of at most ONE_TASK_ROWS rows (checked by count) go to every task, and
  each task fits parameter sets of its own.
* `fit_by_level`: larger tables stay where they are. Each level of all trees is one job: tasks
  send every row down the trees so far and count (trial, node, feature, bin), Spark sums the
  counts, and each (trial, node, feature) yields its best split. The driver sees splits only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.session import scratch_dir

BINS = 254
UNIT = 1 << 24
ONE_TASK_ROWS = 1_000_000
LEAST_GAIN = 1e-6
LEAST_HESSIAN = 1e-3
WRITE_EVERY = 16
SLAB_NODES = 32  # whose splits are searched together


@dataclass(frozen=True)
class Settings:
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    min_child_samples: int = 1
    scale_pos_weight: float | None = 1.0  # None: the rarer class weighs as much as the other
    num_leaves: int | None = None  # None: by level
    patience: int | None = None  # rounds without a better loss on the watched rows
    seed: int = P.SEED


# -- bins ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Upper bounds of each feature's bins; bins of all features are numbered one after another,
    the last of each feature is for missing values."""

    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])])

    def binned(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """rows x features, as bin numbers; values over the last bound belong to the last bin."""
        out = np.empty((len(columns[0]), len(self.cuts)), np.int32)
        for k, (cuts, start, column) in enumerate(zip(self.cuts, self.starts, columns)):
            x = np.asarray(column, float)
            at = np.minimum(np.searchsorted(cuts, x), max(0, len(cuts) - 1))
            out[:, k] = start + np.where(np.isnan(x), len(cuts), at)
        return out


def bin_layout(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> Layout:
    """Quantiles of all features in one aggregation; one row comes to the driver."""
    ranks = F.array(*[F.lit((i + 1) / bins) for i in range(bins)])
    value = lambda f: F.when(~F.isnan(f), F.col(f).cast("double"))
    row = rows.agg(*[F.percentile_approx(value(f), ranks, 100_000).alias(f) for f in features]).first()
    return Layout(tuple(features), tuple(tuple(sorted(set(row[f] or ()))) for f in features))


# -- trees --------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes of one tree: feature -1 for a leaf; rows with bin <= cut go left."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray  # hessian sum, or rows where leaves are grown best first

    def leaf_of(self, bins: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return walk(self, bins, starts)

    def predict(self, bins: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return self.value[walk(self, bins, starts)]


def walk(tree, bins: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The node at which each row ends."""
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    while len(rows):
        at = node[rows]
        inner = tree.feature[at] >= 0
        rows, at = rows[inner], at[inner]
        if not len(rows):
            break
        f = tree.feature[at]
        b = bins[rows, f]
        go_left = np.where(b == starts[f + 1] - 1, tree.missing_left[at], b <= tree.cut[at])
        node[rows] = np.where(go_left, tree.left[at], tree.right[at])
    return node


@dataclass
class Forest:
    layout: Layout
    base: float
    trees: list[Tree]

    def margin(self, bins: np.ndarray) -> np.ndarray:
        starts = self.layout.starts
        return sum((t.predict(bins, starts) for t in self.trees), np.full(len(bins), self.base))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def log_loss(margin: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, margin) - y * margin))


# -- splits -------------------------------------------------------------------------


def shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def worth(g, h, s: Settings):
    return shrunk(g, s.reg_alpha) ** 2 / (h + s.reg_lambda)


def leaf_value(g, h, s: Settings):
    return -s.learning_rate * shrunk(g, s.reg_alpha) / (h + s.reg_lambda)


def _gains(left: np.ndarray, missing: np.ndarray, total: np.ndarray, allowed, s: Settings) -> np.ndarray:
    """Worth of cuts (last axes: cut, way) with missing values to the right, then to the left;
    -inf where a side is too light. All sums (.., 3) in whole units, total broadcast over cuts."""
    sides = np.stack([left, left + missing], axis=-2)
    other = total[..., None, :] - sides
    part = lambda x: (x[..., 0] / UNIT, x[..., 1] / UNIT)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = worth(*part(sides), s) + worth(*part(other), s) - worth(*part(total), s)[..., None]
    lightest = max(s.min_child_weight, LEAST_HESSIAN if s.num_leaves else 0) * UNIT
    valid = (
        (np.asarray(allowed) & (left[..., 2] > 0))[..., None]  # a cut below all values is one above them, mirrored
        & (np.minimum(sides[..., 1], other[..., 1]) >= lightest)
        & (np.minimum(sides[..., 2], other[..., 2]) >= max(1, s.min_child_samples))
    )
    return np.where(valid, gain, -np.inf)


def _split(gain: float, cut: int, way: int, left, missing, starts: np.ndarray, s: Settings) -> dict | None:
    if gain < max(s.gamma, LEAST_GAIN):
        return None
    feature = int(np.searchsorted(starts, cut, "right") - 1)
    return {"gain": float(gain), "feature": feature, "cut": int(cut), "missing_left": bool(way), "sums": left + missing * way}


def best_splits(hist: np.ndarray, starts: np.ndarray, s: Settings, columns: np.ndarray) -> list[dict | None]:
    """Of nodes x bins x (g, h, rows): the best allowed split of each node.

    Equal gains go to the first feature, then the lowest cut, then missing values to the right."""
    if len(hist) > SLAB_NODES:
        slabs = (hist[i : i + SLAB_NODES] for i in range(0, len(hist), SLAB_NODES))
        return [split for slab in slabs for split in best_splits(slab, starts, s, columns)]
    total = hist[:, : starts[1]].sum(1)
    upto = np.cumsum(hist, axis=1)
    first, width = starts[:-1], np.diff(starts)
    before = np.where((first > 0)[None, :, None], upto[:, first - 1], 0)
    left = upto - np.repeat(before, width, axis=1)
    missing = np.repeat(hist[:, starts[1:] - 1], width, axis=1)
    allowed = np.repeat(columns, width)
    allowed[starts[1:] - 1] = False
    gain = _gains(left, missing, total[:, None], allowed, s).reshape(len(hist), -1)
    best = gain.argmax(1)
    return [
        _split(gain[k, at], at // 2, at % 2, left[k, at // 2], missing[k, at // 2], starts, s) for k, at in enumerate(best)
    ]


class Entries:
    """Rows by feature and bin, sorted once per table and feature when first asked for: nodes with
    fewer rows than bins find their splits by running sums over their own rows, one feature after
    another, in the same order as bins."""

    def __init__(self, bins: np.ndarray):
        self.bins, self.order = bins, {}

    def _sorted_rows(self, feature: int) -> np.ndarray:
        if feature not in self.order:
            self.order[feature] = np.argsort(self.bins[:, feature], kind="stable").astype(np.int32)
        return self.order[feature]

    def best_splits(self, slot, slots: int, g, h, starts: np.ndarray, s: Settings, columns: np.ndarray):
        """Best split of each slot and the sums (g, h, rows) of each slot."""
        inside = np.flatnonzero(slot >= 0)
        count = lambda at, v, n: np.bincount(at, v, n).astype(np.int64)
        total = np.stack([count(slot[inside], v, slots) for v in (g[inside], h[inside], None)], axis=-1)
        best, out = np.full(slots, -np.inf), [None] * slots
        for feature in np.flatnonzero(columns).tolist() if len(inside) else ():
            row = self._sorted_rows(feature)
            row = row[slot[row] >= 0]
            row = row[np.argsort(slot[row].astype(np.uint16), kind="stable")]
            at, b = slot[row], self.bins[row, feature].astype(np.int64)
            start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(row))))
            values = np.stack([g[row], h[row], np.ones(len(row), np.int64)], axis=-1)
            upto = np.cumsum(values, axis=0)
            lost = b == starts[feature + 1] - 1
            missing = np.stack([count(of[lost], values[lost, i], len(start)) for i in range(3)], axis=-1)
            end = np.append((b[1:] != b[:-1]) | (at[1:] != at[:-1]), True)
            cut = np.flatnonzero(end & ~lost)
            if not len(cut):
                continue
            left = upto[cut] - (upto[start] - values[start])[of[cut]]
            gain = _gains(left, missing[of[cut]], total[at[cut]], True, s)
            first = np.flatnonzero(np.concatenate([[True], at[cut][1:] != at[cut][:-1]]))
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(cut)]):
                i, way = lo + int(gain[lo:hi].argmax()) // 2, int(gain[lo:hi].argmax()) % 2
                k = int(at[cut[i]])
                if gain[i, way] > best[k]:  # equal gains stay with the first feature
                    best[k], out[k] = gain[i, way], (b[cut[i]], way, left[i], missing[of[cut[i]]])
        return [x and _split(best[k], *x, starts, s) for k, x in enumerate(out)], total


class Growth:
    """A tree that grows by level: `examined` nodes get a split or stay leaves."""

    def __init__(self, s: Settings):
        self.s = s
        self.feature, self.cut, self.missing_left = [-1], [0], [False]
        self.left, self.right, self.depth, self.gain = [0], [0], [0], [0.0]
        self.sums: list[np.ndarray | None] = [None]
        self.examined = [0]

    def take(self, splits: dict[int, dict | None], totals: dict[int, np.ndarray]) -> list[tuple[int, int, int]]:
        """Splits of the examined nodes; returns (node, left, right) of those that were split."""
        made, self.examined = [], []
        for node, split in splits.items():
            self.sums[node] = totals[node]
            if split is None:
                continue
            self.feature[node], self.cut[node], self.missing_left[node] = split["feature"], split["cut"], split["missing_left"]
            self.gain[node] = split["gain"]
            children = []
            for sums in (split["sums"], totals[node] - split["sums"]):
                children.append(len(self.feature))
                for column, start in ((self.feature, -1), (self.cut, 0), (self.missing_left, False), (self.left, 0), (self.right, 0), (self.gain, 0.0), (self.sums, sums), (self.depth, self.depth[node] + 1)):
                    column.append(start)
                if self.depth[-1] < self.s.max_depth and sums[2] >= 2 * max(1, self.s.min_child_samples) and sums[1] / UNIT >= 2 * self.s.min_child_weight:
                    self.examined.append(children[-1])
            self.left[node], self.right[node] = children
            made.append((node, *children))
        return made

    def arrays(self):
        """The tree so far, for `walk`."""
        as_array = lambda x, kind: np.asarray(x, kind)
        return Tree(as_array(self.feature, np.int64), as_array(self.cut, np.int64), as_array(self.missing_left, bool), as_array(self.left, np.int64), as_array(self.right, np.int64), np.zeros(0), np.zeros(0))

    def kept_splits(self) -> list[int]:
        """Nodes whose splits stay, in the order they are made."""
        if self.s.num_leaves is None:
            return [i for i, f in enumerate(self.feature) if f >= 0]
        queue, kept = [(-self.gain[0], 0)] if self.feature[0] >= 0 else [], []
        while queue and len(kept) < self.s.num_leaves - 1:
            _, node = heapq.heappop(queue)
            kept.append(node)
            for child in (self.left[node], self.right[node]):
                if self.feature[child] >= 0:
                    heapq.heappush(queue, (-self.gain[child], child))
        return kept

    def _kept_order(self) -> tuple[set[int], list[int], dict[int, int]]:
        """Nodes with splits that stay, all nodes that stay in their order, and their places."""
        kept = set(self.kept_splits())
        order, at = [0], {0: 0}
        for node in order:
            if node in kept:
                for child in (self.left[node], self.right[node]):
                    at[child] = len(order)
                    order.append(child)
        return kept, order, at

    def kept_nodes(self) -> np.ndarray:
        """For each node of the growth the node of `tree` at which its rows end up."""
        kept, _, at = self._kept_order()
        out = np.zeros(len(self.feature), np.int64)
        out[list(at)] = list(at.values())
        for node, f in enumerate(self.feature):  # children come after their parent
            if f >= 0 and node not in kept:
                out[[self.left[node], self.right[node]]] = out[node]
        return out

    def tree(self) -> Tree:
        kept, order, at = self._kept_order()
        inner = np.array([n in kept for n in order])
        sums = np.array([self.sums[n] for n in order], float)
        value = np.where(inner, 0.0, leaf_value(sums[:, 0] / UNIT, sums[:, 1] / UNIT, self.s))
        pick = lambda x, other: np.array([x[n] if i else other for n, i in zip(order, inner)])
        child = lambda x: np.array([at[x[n]] if i else 0 for n, i in zip(order, inner)], np.int64)
        return Tree(
            pick(self.feature, -1).astype(np.int64), pick(self.cut, 0).astype(np.int64), pick(self.missing_left, False).astype(bool),
            child(self.left), child(self.right), value, sums[:, 2] if self.s.num_leaves else sums[:, 1] / UNIT,
        )


# -- what both ways of training share -------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: evenly spread numbers from any keys."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def drawn_rows(keys: np.ndarray, round_: int, s: Settings) -> np.ndarray:
    """Rows of a round by a hash of their key: the same wherever a row lies."""
    if s.subsample >= 1 or s.num_leaves:  # best-first libraries draw rows only if told how often
        return np.ones(len(keys), bool)
    start = mixed(np.array([s.seed * 1_000_003 + round_]))
    with np.errstate(over="ignore"):
        return mixed(keys.astype(np.uint64) + start) < np.uint64(int(s.subsample * 2**64) - 1)


def drawn_columns(count: int, round_: int, s: Settings) -> np.ndarray:
    take = max(1, int(s.colsample_bytree * count))
    order = np.random.default_rng([s.seed, round_]).permutation(count)
    return np.isin(np.arange(count), order[:take])


def weights_of(s: Settings, positives: int, negatives: int) -> tuple[float, float]:
    """Weights of classes 0 and 1."""
    if s.scale_pos_weight is not None:
        return 1.0, s.scale_pos_weight
    if not positives or not negatives:
        return 1.0, 1.0
    return (positives / negatives, 1.0) if positives > negatives else (1.0, negatives / positives)


def start_margin(w: tuple[float, float], positives: int, negatives: int) -> float:
    share = min(max(w[1] * positives / max(w[1] * positives + w[0] * negatives, 1e-12), 1e-6), 1 - 1e-6)
    return float(np.log(share / (1 - share)))


def gradients(margin: np.ndarray, y: np.ndarray, w: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Whole multiples of 1 / UNIT."""
    p, weight = sigmoid(margin), np.where(y > 0, w[1], w[0])
    return np.rint(weight * (p - y) * UNIT).astype(np.int64), np.rint(weight * np.maximum(p * (1 - p), 1e-16) * UNIT).astype(np.int64)


def counted(bins: np.ndarray, slot: np.ndarray, slots: int, g: np.ndarray, h: np.ndarray, size: int, starts: np.ndarray | None = None, columns: np.ndarray | None = None) -> np.ndarray:
    """slots x bins x (g, h, rows), feature by feature; rows with slot -1 are left out. With
    `columns`, of the drawn ones and the first alone: its sums are the totals."""
    use = np.flatnonzero(slot >= 0)
    pick = (lambda x: x) if len(use) == len(slot) else (lambda x: x[use])
    at, sums = pick(slot), [pick(g).astype(float), pick(h).astype(float), None]
    out = np.zeros((slots, size, 3), np.int64)
    for k in range(bins.shape[1]):
        if columns is not None and k and not columns[k]:
            continue
        lo, hi = (0, size) if starts is None else (int(starts[k]), int(starts[k + 1]))
        cell = pick(bins[:, k]) + (at * (hi - lo) - lo)
        for i, v in enumerate(sums):
            out[:, lo:hi, i] += np.bincount(cell, v, slots * (hi - lo)).astype(np.int64).reshape(slots, hi - lo)  # sums stay below 2^53
    return out


# -- in tasks -------------------------------------------------------------------------


def fit_rows(layout: Layout, bins, y, keys, s: Settings, watched: tuple | None = None) -> Forest:
    """Trees of rows at hand; with `watched` (bins, y) and patience, those up to the best round."""
    starts, size = layout.starts, int(layout.starts[-1])
    bins = compact(bins, size)
    positives = int((y > 0).sum())
    w = weights_of(s, positives, len(y) - positives)
    forest = Forest(layout, start_margin(w, positives, len(y) - positives), [])
    margin = np.full(len(y), forest.base)
    seen = np.full(len(watched[1]), forest.base) if watched else None
    best, at_best = np.inf, 0
    entries = Entries(bins)
    for round_ in range(s.n_estimators):
        g, h = gradients(margin, y, w)
        drawn, node = drawn_rows(keys, round_, s), np.zeros(len(y), np.int64)
        columns, growth = drawn_columns(len(layout.features), round_, s), Growth(s)
        hists: dict | None = None
        while growth.examined:
            asked = growth.examined
            slot = np.full(len(growth.feature) + 1, -1)
            slot[asked] = np.arange(len(asked))
            slot = np.where(drawn, slot[node], -1)
            if 2 * len(asked) * size <= np.count_nonzero(slot >= 0) * len(columns) and (hists is not None or asked == [0]):
                hists = hists or {0: counted(bins, slot, 1, g, h, size, starts, columns)[0]}
                stack = np.stack([hists[n] for n in asked])
                totals, splits = stack[:, : starts[1]].sum(1), best_splits(stack, starts, s, columns)
            else:
                hists = None
                splits, totals = entries.best_splits(slot, len(asked), g, h, starts, s, columns)
            made = growth.take(dict(zip(asked, splits)), dict(zip(asked, totals)))
            _send_down(growth, bins, node, starts)
            hists = _child_counts(growth, made, hists, bins, drawn, node, g, h, starts, columns) if hists else None
        tree = growth.tree()
        forest.trees.append(tree)
        margin = margin + tree.value[growth.kept_nodes()[node]]
        if watched and s.patience:
            seen = seen + tree.predict(watched[0], starts)
            loss = log_loss(seen, watched[1])
            if loss < best:
                best, at_best = loss, round_ + 1
            elif round_ + 1 - at_best >= s.patience:
                break
    if watched and s.patience:
        forest.trees = forest.trees[:at_best]
    return forest


def _send_down(growth: Growth, bins, node, starts) -> None:
    """Rows (`node`, in place) of the nodes just split go to the children, all others stay."""
    arrays = growth.arrays()
    rows = np.flatnonzero((arrays.feature >= 0)[node])
    at = node[rows]
    f = arrays.feature[at]
    b = bins[rows, f]
    go_left = np.where(b == starts[f + 1] - 1, arrays.missing_left[at], b <= arrays.cut[at])
    node[rows] = np.where(go_left, arrays.left[at], arrays.right[at])


def _child_counts(growth: Growth, made: list, hists: dict, bins, drawn, node, g, h, starts, columns) -> dict:
    """Counts the smaller child of each split; its sibling is the parent less that child."""
    into, counts = np.full(len(growth.feature) + 1, -1), {}
    for parent, *children in made:
        small = min(children, key=lambda c: growth.sums[c][2])
        if any(c in growth.examined for c in children):
            into[small] = len(counts)
            counts[small] = (parent, children[0] if small == children[1] else children[1])
    stack = counted(bins, np.where(drawn, into[node], -1), len(counts), g, h, int(starts[-1]), starts, columns)
    out = {}
    for (small, (parent, sibling)), hist in zip(counts.items(), stack):
        out[small], out[sibling] = hist, hists[parent] - hist
    return out


def compact(bins: np.ndarray, size: int) -> np.ndarray:
    """The same bin numbers, feature after feature in memory and no wider than needed."""
    return np.asfortranarray(bins, np.min_scalar_type(size))


def binned_rows(layout: Layout, rows: DataFrame, label: str, row_id: str):
    """(bins, y, keys) of a table of at most ONE_TASK_ROWS rows."""
    got = rows.select(F.xxhash64(row_id).alias("k"), F.col(label).cast("double").alias("y"), *[F.col(f).cast("double") for f in layout.features]).toPandas().sort_values("k")
    bins = layout.binned([got[f].to_numpy() for f in layout.features])
    return compact(bins, int(layout.starts[-1])), got["y"].to_numpy(), got["k"].to_numpy()


def fit_in_tasks(layout: Layout, rows: DataFrame, trials: dict[int, Settings], label: str, row_id: str, watched: DataFrame | None = None) -> dict[int, Forest]:
    """One task per parameter set; rows and watched rows (each at most ONE_TASK_ROWS) go to all."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((layout, binned_rows(layout, rows, label, row_id), watched and binned_rows(layout, watched, label, row_id)[:2]))

    def fit(trial: int):
        layout, (bins, y, keys), seen = shared.value
        return trial, fit_rows(layout, bins, y, keys, trials[trial], seen)

    # the largest first, each in a task of its own: their number is the search's, not the data's
    order = sorted(trials, key=lambda t: -trials[t].n_estimators * trials[t].max_depth)
    return dict(context.parallelize(order, max(1, len(order))).map(fit).collect())


# -- by level -------------------------------------------------------------------------

COUNTED = "trial int, node int, bin int, g long, h long, n long"
FOUND = "trial int, node int, feature int, gain double, cut int, missing_left boolean, sums array<long>, total array<long>"


def fit_by_level(layout: Layout, rows: DataFrame, trials: dict[int, Settings], label: str, row_id: str, watched: DataFrame | None = None) -> dict[int, Forest]:
    """All trials together, one job per level; rows and their margins stay distributed."""
    starts, names = layout.starts, list(trials)
    base_rows = rows.select(F.xxhash64(row_id).alias("k"), F.col(label).cast("double").alias("y"), F.lit(True).alias("fit"), *layout.features)
    if watched is not None:
        base_rows = base_rows.unionByName(watched.select(F.xxhash64(row_id).alias("k"), F.col(label).cast("double").alias("y"), F.lit(False).alias("fit"), *layout.features))
    positives, negatives = base_rows.filter("fit").agg(F.count_if(F.col("y") > 0), F.count_if(F.col("y") <= 0)).first()
    weights = {t: weights_of(s, positives, negatives) for t, s in trials.items()}
    forests = {t: Forest(layout, start_margin(weights[t], positives, negatives), []) for t in names}
    state = _binned_state(layout, base_rows, [forests[t].base for t in names])
    best = {t: (np.inf, 0) for t in names}
    applied, round_ = 0, 0
    active = {t for t in names if trials[t].n_estimators}
    while active:
        growths = {t: Growth(trials[t]) for t in sorted(active)}
        pending = {t: forests[t].trees[applied:] for t in names}
        while any(x.examined for x in growths.values()):
            found = _level(state, layout, trials, weights, names, growths, pending, round_)
            for t, growth in growths.items():
                splits, totals = found.get(t, ({}, {}))
                growth.take({n: splits.get(n) for n in growth.examined}, totals)
        for t, growth in growths.items():
            forests[t].trees.append(growth.tree())
        round_ += 1
        if watched is not None and any(trials[t].patience for t in active):
            losses = _losses(state, layout, names, {t: forests[t].trees[applied:] for t in names})
            for t in list(active):
                if trials[t].patience:
                    if losses[t] < best[t][0]:
                        best[t] = (losses[t], round_)
                    elif round_ - best[t][1] >= trials[t].patience:
                        active.discard(t)
        active = {t for t in active if round_ < trials[t].n_estimators}
        if round_ - applied >= WRITE_EVERY and active:
            state, applied = _kept(_with_margins(state, layout, names, {t: forests[t].trees[applied:] for t in names}), "margins"), round_
    for t, s in trials.items():
        if watched is not None and s.patience:
            forests[t].trees = forests[t].trees[: best[t][1]]
    return forests


STATE = "k long, y double, fit boolean, bins array<int>, margins array<double>"


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(STATE).parquet(path)


def _binned_state(layout: Layout, rows: DataFrame, bases: list[float]) -> DataFrame:
    def bin_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins = layout.binned([batch[f].to_numpy(float) for f in layout.features])
            yield batch[["k", "y", "fit"]].assign(bins=list(bins), margins=[bases] * len(batch))

    return _kept(rows.mapInPandas(bin_rows, STATE), "binned")


def _unpacked(batch: pd.DataFrame, layout: Layout, names: list, pending: dict) -> tuple[np.ndarray, np.ndarray]:
    bins = np.stack(batch["bins"].to_numpy()).astype(np.int64)
    margins = np.stack(batch["margins"].to_numpy()).astype(float)
    for i, t in enumerate(names):
        for tree in pending[t]:
            margins[:, i] += tree.predict(bins, layout.starts)
    return bins, margins


def _with_margins(state: DataFrame, layout: Layout, names: list, pending: dict) -> DataFrame:
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(margins=list(_unpacked(batch, layout, names, pending)[1]))

    return state.mapInPandas(add, STATE)


def _losses(state: DataFrame, layout: Layout, names: list, pending: dict) -> dict:
    added = _with_margins(state.filter("NOT fit"), layout, names, pending)
    m, y = F.col("margins"), F.col("y")
    loss = lambda i: F.avg(F.log1p(F.exp(-F.abs(m[i]))) + F.greatest(m[i], F.lit(0.0)) - y * m[i])
    return dict(zip(names, added.agg(*[loss(i).alias(f"l{i}") for i in range(len(names))]).first()))


def _level(state, layout, trials, weights, names, growths, pending, round_) -> dict:
    """{trial: ({node: split}, {node: sums})} of all examined nodes of all trials, by one job."""
    starts = layout.starts
    asked = {t: (g.arrays(), list(g.examined)) for t, g in growths.items() if g.examined}
    columns = {t: drawn_columns(len(layout.features), round_, trials[t]) for t in asked}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            bins, margins = _unpacked(batch, layout, names, pending)
            keys, y = batch["k"].to_numpy(), batch["y"].to_numpy()
            for t, (tree, nodes) in asked.items():
                g, h = gradients(margins[:, names.index(t)], y, weights[t])
                into = np.full(len(tree.feature), -1)
                into[nodes] = np.arange(len(nodes))
                slot = np.where(drawn_rows(keys, round_, trials[t]), into[walk(tree, bins, starts)], -1)
                hist = counted(bins, slot, len(nodes), g, h, int(starts[-1]), starts, columns[t])
                at, b = np.nonzero(hist[..., 2])
                yield pd.DataFrame({"trial": t, "node": np.array(nodes)[at], "bin": b, "g": hist[at, b, 0], "h": hist[at, b, 1], "n": hist[at, b, 2]})

    def best(key, rows: pd.DataFrame) -> pd.DataFrame:
        trial, node, feature = key
        lo, hi = starts[feature], starts[feature + 1]
        hist = np.zeros((1, hi - lo, 3), np.int64)
        hist[0, rows["bin"].to_numpy() - lo] = rows[["g", "h", "n"]].to_numpy()
        split = best_splits(hist, np.array([0, hi - lo]), trials[trial], columns[trial][feature : feature + 1])[0] or {}
        out = {"trial": trial, "node": node, "feature": feature, "gain": split.get("gain", -np.inf), "cut": split.get("cut", 0) + int(lo), "missing_left": split.get("missing_left", False)}
        return pd.DataFrame([out | {"sums": split.get("sums", hist[0].sum(0)), "total": hist[0].sum(0)}])

    sums = state.filter("fit").mapInPandas(count, COUNTED).groupBy("trial", "node", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])
    owner = F.expr(f"{int(len(starts) - 1)} - size(filter(array({', '.join(map(str, starts[1:]))}), x -> x > bin))")
    found: dict = {}
    for r in sums.withColumn("feature", owner).groupBy("trial", "node", "feature").applyInPandas(best, FOUND).collect():
        splits, totals = found.setdefault(r["trial"], ({}, {}))
        totals[r["node"]] = np.array(r["total"])
        old, new = splits.get(r["node"]), {"gain": r["gain"], "feature": r["feature"], "cut": r["cut"], "missing_left": r["missing_left"], "sums": np.array(r["sums"])}
        if np.isfinite(new["gain"]) and (old is None or (-new["gain"], new["feature"]) < (-old["gain"], old["feature"])):
            splits[r["node"]] = new
    return found


def fit(rows: DataFrame, trials: dict[int, Settings], features: Sequence[str] = P.FEATURES, label: str = P.LABEL, row_id: str = "sprint_id", watched: DataFrame | None = None, one_task_rows: int = ONE_TASK_ROWS) -> dict[int, Forest]:
    """Forests of all parameter sets over all rows; `watched` rows end trials that have patience."""
    rows, layout = rows.filter(F.col(label).isNotNull()), bin_layout(rows, features)
    watched = watched if any(s.patience for s in trials.values()) else None
    largest = max(rows.count(), watched.count() if watched is not None else 0)
    way = fit_in_tasks if largest <= one_task_rows else fit_by_level
    return way(layout, rows, trials, label, row_id, watched)


def without_patience(s: Settings) -> Settings:
    return replace(s, patience=None)
