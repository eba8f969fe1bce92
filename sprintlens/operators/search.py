"""Search of boosting parameters: spaces, proposals from what earlier trials found, trial table.

Trials come in batches. The first STARTUP are drawn at random; later ones are proposed from two
Parzen densities per parameter, of the good trials (the best tenth by F2) and of the others: of
CANDIDATES values drawn from the first, the one with the highest ratio of both is taken. A
proposal depends on the seed, its number and the stored trials of earlier batches alone, so a
search that was broken off goes on as if it had not been.

The trials of one batch, of all families, are fitted in one job and judged in one grouped job.
No objective reports values on the way, so there is nothing that a pruner could stop.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.operators import boosting
from sprintlens.operators.boosting import Forest, Settings

# The published spaces (kind, lowest, highest).
COMMON = {
    "n_estimators": ("int", 100, 1000),
    "max_depth": ("int", 3, 9),
    "learning_rate": ("log", 0.005, 0.3),
    "subsample": ("float", 0.5, 1.0),
    "colsample_bytree": ("float", 0.4, 1.0),
    "reg_alpha": ("log", 1e-4, 10.0),
    "reg_lambda": ("log", 1e-4, 10.0),
}
SPACES = {
    "boosted": COMMON | {"min_child_weight": ("int", 1, 20), "gamma": ("float", 0.0, 5.0), "scale_pos_weight": ("float", 0.3, 1.5)},
    "leafwise": COMMON | {"num_leaves": ("int", 20, 300), "min_child_samples": ("int", 5, 100)},
}
PATIENCE = 50
STARTUP, CANDIDATES, GOOD_SHARE, MOST_GOOD = 10, 24, 0.1, 25
BATCHES = (10, 20, 30, 40, 50)  # trials known before each batch end here


def settings_of(family: str, params: dict, watched: bool = False) -> Settings:
    """Growth by level with sums of hessians, or best leaf first with row counts and balanced classes."""
    if family == "boosted":
        return Settings(**params)
    return Settings(**params, min_child_weight=1e-3, scale_pos_weight=None, patience=PATIENCE if watched else None)


# -- proposals ------------------------------------------------------------------------


def _scale(kind: str, lo: float, hi: float):
    """Bounds, way in and way out of the axis on which values are drawn."""
    if kind == "log":
        return math.log(lo), math.log(hi), math.log, math.exp
    if kind == "int":
        return lo - 0.5, hi + 0.5, float, lambda x: int(min(max(round(x), lo), hi))
    return lo, hi, float, float


def parzen(points: np.ndarray, lo: float, hi: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres and widths of the density's normals, cut at the bounds and of equal weight: one per
    point, as wide as the farther neighbour is away, and one for the whole range."""
    centres = np.append(points, (lo + hi) / 2)
    order = np.argsort(centres, kind="stable")
    at = np.concatenate([[lo], centres[order], [hi]])
    gaps = np.diff(at)
    widths = np.empty(len(centres))
    widths[order] = np.maximum(gaps[:-1], gaps[1:])
    widths = np.clip(widths, (hi - lo) / min(100, 1 + len(centres)), hi - lo)
    widths[-1] = hi - lo
    return centres, widths


def _below(x: np.ndarray) -> np.ndarray:
    return np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in np.ravel(x)]).reshape(np.shape(x))


def log_density(x: np.ndarray, centres: np.ndarray, widths: np.ndarray, lo: float, hi: float) -> np.ndarray:
    mass = _below((hi - centres) / widths) - _below((lo - centres) / widths)
    z = (x[:, None] - centres) / widths
    return np.log(np.mean(np.exp(-0.5 * z * z) / (widths * math.sqrt(2 * math.pi) * mass), axis=1) + 1e-300)


def _drawn(rng: np.random.Generator, centres, widths, lo: float, hi: float, count: int) -> np.ndarray:
    which, out = rng.integers(0, len(centres), count), np.empty(count)
    for i, k in enumerate(which):
        out[i] = rng.normal(centres[k], widths[k])
        while not lo <= out[i] <= hi:
            out[i] = rng.normal(centres[k], widths[k])
    return out


def split_trials(done: Sequence[tuple[int, dict, float]]) -> tuple[list[dict], list[dict]]:
    """Parameters of the good trials and of the others; earlier trials first among equals."""
    ranked = sorted(done, key=lambda t: (-t[2], t[0]))
    good = min(math.ceil(GOOD_SHARE * len(ranked)), MOST_GOOD)
    return [p for _, p, _ in ranked[:good]], [p for _, p, _ in ranked[good:]]


def propose(family: str, trial: int, done: Sequence[tuple[int, dict, float]], seed: int = P.SEED) -> dict:
    """Parameters of a trial, given (trial, params, f2) of those of earlier batches."""
    rng = np.random.default_rng([seed, zlib.crc32(family.encode()), trial])
    good, others = split_trials(done)
    out = {}
    for name, (kind, low, high) in SPACES[family].items():
        lo, hi, inward, outward = _scale(kind, low, high)
        if len(done) < STARTUP:
            x = rng.uniform(lo, hi)
        else:
            mine, rest = (parzen(np.array([inward(p[name]) for p in part]), lo, hi) for part in (good, others))
            x = _drawn(rng, *mine, lo, hi, CANDIDATES)
            x = x[np.argmax(log_density(x, *mine, lo, hi) - log_density(x, *rest, lo, hi))]
        value = outward(float(x))
        out[name] = value if kind == "int" else round(min(max(value, low), high), 6)
    return out


# -- trial table ------------------------------------------------------------------------


def stored(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # nothing stored yet
        return spark.createDataFrame([], schema)


def scored_by(forests: dict[int, Forest], rows: DataFrame, label: str = P.LABEL) -> DataFrame:
    """Long form (trial, label, p) of one scan scored by several forests."""
    features = next(iter(forests.values())).layout.features

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for trial, forest in forests.items():
                bins = forest.layout.binned([batch[f].to_numpy(float) for f in features])
                yield pd.DataFrame({"trial": trial, label: batch[label], "p": boosting.sigmoid(forest.margin(bins))})

    needed = rows.select(F.col(label).cast("double").alias(label), *[F.col(f).cast("double").alias(f) for f in features])
    return needed.mapInPandas(score, f"trial int, {label} double, p double")


def fingerprint(*frames: DataFrame) -> str:
    """Of the rows of the frames, in any order: trials of other rows are never taken for theirs."""
    parts = [df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0))).first() for df in frames]
    return f"{zlib.crc32(repr([tuple(map(str, p)) for p in parts]).encode()):08x}"
