"""The registered intervals rest on as many replicates as the operator draws by default."""

import inspect

import pytest

from sprintlens.operators import metrics
from sprintlens.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["bootstrap_ci", "bootstrap_poisson", "final_evaluation"])
def test_queries_draw_all_replicates(spark, monkeypatch, name):
    drawn, intervals = [], metrics.bootstrap_ci

    def seen(replicated, *args):
        drawn.append(replicated.select("replicate").distinct().count())
        return intervals(replicated, *args)

    monkeypatch.setattr(metrics, "bootstrap_ci", seen)
    catalog.QUERIES[name](spark, FOLDER)
    assert drawn == [1000] == [inspect.signature(metrics.bootstrap_replicates).parameters["replicates"].default]
