"""Shapley values of fitted models: exact for trees, by weighted coalitions for any model."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.operators.boosting import Forest, Tree
from sprintlens.operators.scoring import predict
from sprintlens.operators.shaping import with_row
from sprintlens.operators.stages import BoostedTrees, decoded

# -- trees ----------------------------------------------------------------------------


def leaf_paths(tree: Tree) -> list[tuple[int, dict[int, tuple[float, list[tuple[int, bool]]]]]]:
    """(leaf, {feature: (share of cover that its splits let through, [(node, goes left)])})."""
    out, stack = [], [(0, {})]
    while stack:
        node, path = stack.pop()
        if tree.feature[node] < 0:
            out.append((node, path))
            continue
        feature = int(tree.feature[node])
        share, steps = path.get(feature, (1.0, []))
        for child, is_left in ((int(tree.left[node]), True), (int(tree.right[node]), False)):
            ratio = tree.cover[child] / tree.cover[node] if tree.cover[node] else 0.0
            stack.append((child, path | {feature: (share * ratio, [*steps, (node, is_left)])}))
    return out


def extended(shares: np.ndarray, let_in: np.ndarray) -> np.ndarray:
    """Coefficients of prod_j (share_j + in_j t) per row of let_in: how much weight each number of
    features that are present carries."""
    out = np.zeros((len(let_in), len(shares) + 1))
    out[:, 0] = 1
    for j, share in enumerate(shares):
        out[:, 1:] = out[:, 1:] * share + out[:, :-1] * let_in[:, j : j + 1]
        out[:, 0] *= share
    return out


def unwound(path: np.ndarray, share: float, let_in: np.ndarray) -> np.ndarray:
    """The same product without one feature: the factor share + in t divided out again."""
    out = np.zeros((len(path), path.shape[1] - 1))
    over = np.zeros(len(path))
    for k in range(path.shape[1] - 1, 0, -1):
        over = np.where(let_in > 0, path[:, k] - share * over, 0)
        out[:, k - 1] = over
    if share > 0:
        out = np.where((let_in > 0)[:, None], out, path[:, :-1] / share)
    return out


def tree_values(tree: Tree, bins: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """rows x features: contributions to the tree's value, features that are absent being averaged
    over by the cover of their splits."""
    out = np.zeros(bins.shape)
    if tree.feature[0] < 0 or not len(bins):
        return out
    goes_left = {}
    for node in np.flatnonzero(tree.feature >= 0):
        f = tree.feature[node]
        goes_left[int(node)] = np.where(bins[:, f] == starts[f + 1] - 1, tree.missing_left[node], bins[:, f] <= tree.cut[node])
    for leaf, path in leaf_paths(tree):
        size, code = len(path), np.zeros(len(bins), np.int64)
        for j, (_, steps) in enumerate(path.values()):
            inside = np.logical_and.reduce([goes_left[n] == left for n, left in steps])
            code |= inside.astype(np.int64) << j
        patterns, at = np.unique(code, return_inverse=True)  # far fewer than rows
        let_in = (patterns[:, None] >> np.arange(size) & 1).astype(float)
        shares = np.array([share for share, _ in path.values()])
        whole = extended(shares, let_in)
        weight = np.array([math.factorial(k) * math.factorial(size - k - 1) for k in range(size)]) / math.factorial(size)
        for j, feature in enumerate(path):
            rest = unwound(whole, shares[j], let_in[:, j]) @ weight
            out[:, feature] += (tree.value[leaf] * rest * (let_in[:, j] - shares[j]))[at]
    return out


def expected_margin(forest: Forest) -> float:
    """The margin when no feature is known."""
    known = lambda t: sum(t.value[leaf] * math.prod(share for share, _ in path.values()) for leaf, path in leaf_paths(t))
    return forest.base + sum(known(t) for t in forest.trees)


def tree_contributions(model: PipelineModel | BoostedTrees, df: DataFrame, row_id: str) -> DataFrame:
    """row_id, feature, contribution to the margin: with `expected_margin` they add up to it."""
    stage = next(s for s in getattr(model, "stages", [model]) if isinstance(s, BoostedTrees))
    text, features = stage.getOrDefault(stage.trees), stage.forest.layout.features

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = decoded(text)
        starts = forest.layout.starts
        for batch in batches:
            bins = forest.layout.binned([batch[f].to_numpy(float) for f in features])
            total = sum((tree_values(t, bins, starts) for t in forest.trees), np.zeros(bins.shape))
            yield pd.DataFrame(total, columns=list(features)).assign(**{row_id: batch[row_id].to_numpy()})

    kind = dict(df.dtypes)[row_id]
    rows = df.select(row_id, *[F.col(f).cast("double").alias(f) for f in features])
    wide = rows.mapInPandas(explain, ", ".join([*[f"`{f}` double" for f in features], f"`{row_id}` {kind}"]))
    return wide.unpivot([row_id], list(features), "feature", "contribution")


# -- any model ------------------------------------------------------------------------


def coalitions(size: int, budget: int, seed: int = P.SEED) -> tuple[list[int], np.ndarray]:
    """Bit masks of feature sets and their weights, without the empty and the whole set.

    Sizes 1 and size - 1, 2 and size - 2, .. are taken whole while the budget lasts; the weight of
    the sizes that are left goes evenly to sets drawn from them, with their complements."""
    by_size = {k: (size - 1) / (k * (size - k)) for k in range(1, size)}  # of all sets of a size
    masks, weights, left = [], [], set(by_size)
    for k in range(1, size // 2 + 1):
        pair = sorted({k, size - k})
        count = sum(math.comb(size, j) for j in pair)
        if len(masks) + count > budget:
            break
        for j in pair:
            sets = [sum(1 << f for f in c) for c in combinations(range(size), j)]
            masks += sets
            weights += [by_size[j] / len(sets)] * len(sets)
            left.discard(j)
    if left and len(masks) < budget:
        rng, found = np.random.default_rng(seed), {}
        sizes = sorted(k for k in left if k <= size // 2)
        chance = np.array([by_size[k] + (by_size[size - k] if size - k != k else 0) for k in sizes])
        for _ in range((budget - len(masks)) // 2):
            k = sizes[rng.choice(len(sizes), p=chance / chance.sum())]
            mask = sum(1 << int(f) for f in rng.choice(size, k, replace=False))
            for m in (mask, (1 << size) - 1 - mask):
                found[m] = found.get(m, 0) + 1
        rest = sum(by_size[k] for k in left)
        drawn = sum(found.values())
        masks += list(found)
        weights += [rest * n / drawn for n in found.values()]
    return masks, np.array(weights)


def kernel_contributions(model, df: DataFrame, features: Sequence[str], row_id: str, budget: int | None = None, background: DataFrame | None = None) -> DataFrame:
    """row_id, feature, contribution to the score of any model, against the mean background row.

    Every row is scored once per coalition (its features there, the background's elsewhere). The
    weighted least-squares fit is constrained to add up to score minus background score; its
    normal equations have one matrix for all rows, so a row needs only the weighted sums of its
    scores per feature, which are aggregated."""
    size = len(features)
    masks, weights = coalitions(size, budget or 2 * size + 2048)
    member = np.array([[m >> k & 1 for k in range(size)] for m in masks], float).reshape(len(masks), size)
    design = member[:, :-1] - member[:, -1:]
    inverse = np.linalg.pinv(design.T @ (weights[:, None] * design))
    sets = [0, (1 << size) - 1, *masks]

    means = (df if background is None else background).agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features])
    numbered = with_row(df, "__mean", means).select(
        F.col(row_id), "__mean", *[F.col(f).cast("double").alias(f"__x_{i}") for i, f in enumerate(features)],
        F.explode(F.sequence(F.lit(0), F.lit(len(sets) - 1))).alias("__at"),
    ).withColumn("__set", F.get(F.lit(sets).cast("array<long>"), F.col("__at")))
    has = lambda k: F.col("__set").bitwiseAND(F.lit(1 << k)) != 0
    mixed = numbered.select(
        row_id, "__at", "__set", *[F.when(has(i), F.col(f"__x_{i}")).otherwise(F.col(f"__mean.{f}")).alias(f) for i, f in enumerate(features)]
    )
    scored = predict(model, mixed, "__p").select(row_id, "__at", "__set", "__p")
    weight = F.get(F.lit([0.0, 0.0, *map(float, weights)]), F.col("__at"))
    at = lambda k: has(k).cast("double")
    end = lambda n: F.max(F.when(F.col("__at") == n, F.col("__p")))
    last = at(size - 1)
    # sums of w d_k p, w d_k and w d_k in_last, d_k = in_k - in_last, give the right-hand side below
    sums = scored.groupBy(row_id).agg(
        end(0).alias("__empty"), end(1).alias("__full"),
        *[F.sum(weight * (at(k) - last) * F.col("__p")).alias(f"__b{k}") for k in range(size - 1)],
    )
    constant, share = design.T @ weights, design.T @ (weights * member[:, -1])
    gap = F.col("__full") - F.col("__empty")
    right = [F.col(f"__b{k}") - float(constant[k]) * F.col("__empty") - float(share[k]) * gap for k in range(size - 1)]
    values = sums.select(row_id, gap.alias("__gap"), F.array(*right).alias("__right"))
    solved = [sum((float(inverse[i, k]) * F.col("__right")[k] for k in range(size - 1)), F.lit(0.0)).alias(f"__v{i}") for i in range(size - 1)]
    firsts = values.select(row_id, "__gap", *solved)
    rest = F.col("__gap") - sum((F.col(f"__v{i}") for i in range(size - 1)), F.lit(0.0))
    named = firsts.select(row_id, *[F.col(f"__v{i}").alias(f) for i, f in enumerate(features[:-1])], rest.alias(features[-1]))
    return named.unpivot([row_id], list(features), "feature", "contribution")
