import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sprintlens.operators.ranking import collapse, exact_percentiles, running_totals


def skewed(rows=3000):
    """One group holds a third of the rows; a null group exists; values repeat."""
    rng = np.random.default_rng(7)
    group = np.where(rng.random(rows) < 1 / 3, "hot", np.array(["a", "b", "c", "d"])[rng.integers(0, 4, rows)])
    group = pd.Series(group, dtype=object)
    group[::97] = None
    return pd.DataFrame({"g": group, "v": np.round(rng.normal(size=rows), 2), "w": rng.integers(0, 3, rows)})


def test_running_totals_match_pandas(spark, many_chunks):
    pdf = skewed()
    counts = collapse(spark.createDataFrame(pdf), "v", ["g"], s=F.col("w"))
    got = running_totals(counts, "v", ["s"], ["g"]).toPandas()
    got["g"] = got.g.fillna("-")
    want = pdf.assign(g=pdf.g.fillna("-")).groupby(["g", "v"]).w.sum().reset_index(name="s").sort_values(["g", "v"])
    want["s_upto"] = want.groupby("g").s.cumsum()
    want["s_total"] = want.groupby("g").s.transform("sum")
    got = got.sort_values(["g", "v"]).reset_index(drop=True)
    for c in ("v", "s", "s_upto", "s_total"):
        assert np.allclose(got[c], want[c])


def test_hot_group_is_cut_into_chunks(spark, many_chunks):
    from sprintlens.operators import ranking

    counts = collapse(spark.range(1000).select(F.lit("hot").alias("g"), F.col("id").alias("v")), "v", ["g"], s=F.lit(1))
    key = F.struct("g", "v")
    chunk = ranking._chunk_of(key, F.col("ks"), 4)
    sizes = (
        counts.withColumn("ks", ranking._splitters(counts, key, 4)).groupBy(chunk.alias("c")).count().toPandas()
    )
    assert len(sizes) == 5 and sizes["count"].sum() == 1000


def test_running_totals_without_groups(spark, many_chunks):
    counts = collapse(spark.range(1, 101).select(F.col("id").alias("v")), "v", s=F.lit(1))
    got = running_totals(counts, "v", ["s"]).orderBy("v").collect()
    assert [r["s_upto"] for r in got] == list(range(1, 101))
    assert {r["s_total"] for r in got} == {100}


@pytest.mark.parametrize("chunked", [True, False])
def test_percentiles_match_numpy(spark, monkeypatch, chunked):
    from sprintlens.operators import ranking

    monkeypatch.setattr(ranking, "THINNING", 1 if chunked else 1024)
    pdf = skewed()
    probs = [0.0, 0.025, 0.1, 0.5, 0.9, 1.0]
    got = exact_percentiles(spark.createDataFrame(pdf), "v", probs, ["g"]).collect()
    for r in got:
        sub = pdf[pdf.g.isna()] if r["g"] is None else pdf[pdf.g == r["g"]]
        assert r["n"] == len(sub)
        assert np.allclose(r["percentiles"], np.percentile(sub.v, [q * 100 for q in probs]))


def test_nulls_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert exact_percentiles(df, "v", [0.5]).first()["percentiles"] == [2.0]
