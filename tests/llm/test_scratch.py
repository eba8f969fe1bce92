"""Written tables and the shuffle files behind them."""

import os
import subprocess
import sys

import numpy as np
import pytest

from sprintlens.llm import components as components_module
from sprintlens.llm.common import CLEANUP, shuffles_released, written
from sprintlens.llm.components import components


def test_setting_comes_back(spark):
    before = spark.conf.get(CLEANUP)
    with pytest.raises(ValueError), shuffles_released(spark):
        assert spark.conf.get(CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(CLEANUP) == before


def test_written_rows_are_read_back_and_joined_again(spark):
    rows = written(spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count(), "test-written")
    again = written(rows.join(rows.withColumnRenamed("count", "n"), "k"), "test-written-again")
    assert again.count() == 7 == rows.count() and spark.conf.get(CLEANUP) == "false"


def test_components_of_odd_links(spark):
    links = [(1, 2), (2, 1), (1, 1), (None, 3), (5, None), (2, 9)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in found} == {1: 1, 2: 1, 9: 1}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_links_of_one_slice_need_no_rounds_and_slices_are_joined(spark, monkeypatch):
    rng, names, inner = np.random.default_rng(5), [], components_module.written
    ends = rng.permutation(400)[rng.integers(0, 400, (300, 2))].tolist() + [[7, 7], [7, 9], [9, 7], [None, 3]]
    links = spark.createDataFrame(ends, "a long, b long").repartition(7)
    parent = {n: n for e in ends[:-1] for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in ends[:-1]:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    linked = {n for a, b in ends[:-1] if a != b for n in (a, b)}
    monkeypatch.setattr(components_module, "written", lambda df, name: names.append(name) or inner(df, name))
    for slice_links, rounds in ((1 << 19, 0), (64, 1)):
        monkeypatch.setattr(components_module, "SLICE_LINKS", slice_links)
        names.clear()
        found = components(links, "a", "b").collect()
        assert sorted((r.node, r.component) for r in found) == sorted((n, find(n)) for n in linked)
        assert (names.count("stars") >= rounds) if rounds else names == ["links"]


def test_memory_of_a_task_goes_back_to_the_system():
    """Chunks that the allocator would keep, below one that stays."""
    code = """
import os
from sprintlens.llm.common import released
held = lambda: int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6
stays = []
def run(batches):
    chunks = [bytearray(b"x") * 100_000 for _ in range(1000)]
    stays.append(bytearray(b"x") * 100_000)
    yield from batches
before = held()
assert list(released(run)(iter([1, 2]))) == [1, 2]
print(held() - before)
"""
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, check=True).stdout
    assert float(out) < 40
