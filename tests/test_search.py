"""The registered model queries run the whole published search and fit what it found."""

import json

import pytest
from pyspark.sql import functions as F

from sprintlens.operators import models, search
from sprintlens.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trials(spark):
    return catalog.QUERIES["tree_trials"](spark, FOLDER)


def test_search_proposes_all_trials(trials):
    rows = {(r["study"], r["trial"]): r for r in trials.collect()}
    assert sorted(rows) == sorted((f, i) for f in models.FAMILIES for i in range(50)) and trials.count() == 100
    ends = (0, *search.BATCHES)
    for (family, i), row in rows.items():
        first = max(e for e in ends if e <= i)
        earlier = [(j, json.loads(rows[family, j]["params"]), rows[family, j]["f2"]) for j in range(first)]
        assert json.loads(row["params"]) == search.propose(family, i, earlier)


def test_later_queries_fit_the_best_trial(spark, trials, monkeypatch):
    fitted = []
    for family, build in list(models.FAMILIES.items()):
        seen = lambda params, *a, f=family, b=build: fitted.append((f, params)) or b(params, *a)
        monkeypatch.setitem(models.FAMILIES, family, seen)
    best = {r["study"]: json.loads(r["params"]) for r in models.best_trial(trials).collect()}
    for name in ("champion", "lopo_metrics"):
        fitted.clear()
        assert catalog.QUERIES[name](spark, FOLDER).count() > 0
        assert fitted and all(params == best[family] for family, params in fitted)


def test_trees_depend_on_the_five_most_important_features(spark, monkeypatch):
    parts = catalog.QUERIES["shapley_trees"](spark, FOLDER)
    top = [r["feature"] for r in catalog.explain.global_importance(parts).limit(5).collect()]
    seen, whole = [], catalog.explain.partial_dependence_grid
    monkeypatch.setattr(catalog.explain, "partial_dependence_grid", lambda df, names, points: seen.append((list(names), points)) or whole(df, names, points))
    table = catalog.QUERIES["partial_dependence_trees"](spark, FOLDER)
    assert seen == [(top, 50)]
    assert {r["feature"] for r in table.select("feature").distinct().collect()} == set(top)


def test_calibrated_scores_are_those_of_the_saved_pipeline(spark):
    table = catalog.QUERIES["calibrated_scores"](spark, FOLDER)
    assert table.where(F.col("p").isNull() | (F.col("p") < 0) | (F.col("p") > 1)).count() == 0
    assert table.count() == catalog._model_matrix(spark, FOLDER).count()
