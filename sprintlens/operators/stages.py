"""Fitted stages that pyspark.ml saves and loads: boosted trees, and calibration maps behind them.

Each keeps what it learned in one string parameter, so that the library's own writers and
readers of parameters are enough, and a pipeline of trees and map is saved as one model.
"""

from __future__ import annotations

import base64
import functools
import io
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintlens.functions import numeric as N
from sprintlens.operators.boosting import Forest, Layout, Tree

COLUMNS = ("feature", "cut", "missing_left", "left", "right", "value", "cover")


def encoded(forest: Forest) -> str:
    """All trees as one node table, packed into text."""
    stacked = lambda c: np.concatenate([getattr(t, c) for t in forest.trees]) if forest.trees else np.zeros(0)
    buffer = io.BytesIO()
    np.savez_compressed(
        buffer, base=forest.base, sizes=np.array([len(t.feature) for t in forest.trees], np.int64),
        features=np.array(forest.layout.features), widths=np.array([len(c) for c in forest.layout.cuts]),
        cuts=np.array([x for c in forest.layout.cuts for x in c], float), **{c: stacked(c) for c in COLUMNS},
    )
    return base64.b64encode(buffer.getvalue()).decode()


@functools.lru_cache(maxsize=8)
def decoded(text: str) -> Forest:
    with np.load(io.BytesIO(base64.b64decode(text))) as z:
        ends = np.cumsum(z["sizes"])[:-1] if len(z["sizes"]) else []
        parts = {c: np.split(z[c], ends) if len(z["sizes"]) else [] for c in COLUMNS}
        kinds = {"feature": np.int64, "cut": np.int64, "left": np.int64, "right": np.int64, "missing_left": bool}
        trees = [Tree(*[parts[c][i].astype(kinds.get(c, float)) for c in COLUMNS]) for i in range(len(z["sizes"]))]
        bounds = np.split(z["cuts"], np.cumsum(z["widths"])[:-1])
        layout = Layout(tuple(z["features"].tolist()), tuple(tuple(b.tolist()) for b in bounds))
        return Forest(layout, float(z["base"]), trees)


def _text_param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toString)


class BoostedTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds `probability` (vector) by the trees; features are columns, null counts as missing."""

    trees = _text_param("trees", "node table of all trees and their bins")

    def __init__(self, forest: Forest | None = None):
        super().__init__()
        if forest is not None:
            self._set(trees=encoded(forest))

    @property
    def forest(self) -> Forest:
        return decoded(self.getOrDefault(self.trees))

    def margin(self) -> Column:
        text, features = self.getOrDefault(self.trees), self.forest.layout.features

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            forest = decoded(text)
            for batch in batches:
                yield pd.Series(forest.margin(forest.layout.binned([batch[f].to_numpy(float) for f in forest.layout.features])))

        return score(F.struct(*[F.col(f).cast("double").alias(f) for f in features]))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = dataset.withColumn("__margin", self.margin()).withColumn("__p", N.sigmoid(F.col("__margin")))
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("__p"), "__p"))).drop("__margin", "__p")


class _CalibrationMap(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces `probability` by its calibrated value."""

    learned = _text_param("learned", "what the map learned, as JSON")

    def __init__(self, learned: dict | None = None):
        super().__init__()
        if learned is not None:
            self._set(learned=json.dumps(learned))

    def apply(self, p: Column) -> Column:
        raise NotImplementedError

    def on(self, df: DataFrame, score: str, name: str) -> DataFrame:
        return df.withColumn(name, self.apply(F.col(score)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = self.apply(vector_to_array("probability")[1])
        return dataset.withColumn("__p", p).withColumn("probability", array_to_vector(F.array(1 - F.col("__p"), "__p"))).drop("__p")


class SigmoidMap(_CalibrationMap):
    """p -> 1 / (1 + exp(-(a p + b)))."""

    def apply(self, p: Column) -> Column:
        x = json.loads(self.getOrDefault(self.learned))
        return N.sigmoid(x["a"] * p + x["b"])


class StepMap(_CalibrationMap):
    """Linear between the given (score, value) points, constant outside."""

    def apply(self, p: Column) -> Column:
        text = self.getOrDefault(self.learned)

        @F.pandas_udf("double")
        def interpolate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            points = json.loads(text)
            for batch in batches:
                yield pd.Series(np.interp(batch, points["scores"], points["values"])).where(batch.notna().to_numpy())

        return interpolate(p)


def as_pipeline(*stages: Transformer) -> PipelineModel:
    return PipelineModel(stages=[x for s in stages for x in (s.stages if isinstance(s, PipelineModel) else [s])])
