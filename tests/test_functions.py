import datetime
import math

import pytest
from pyspark.sql import functions as F

from sprintlens.functions import numeric as N
from sprintlens.functions import text as X


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def applied(df, fn):
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_the_two_category_rules_differ(spark):
    df = column(spark, ["Sub-task", "Enhancement", "Bug report", "BUG", "Story", None, "Spike"])
    assert applied(df, X.category_by_substring) == ["task", "other", "bug", "bug", "story", "other", "other"]
    assert applied(df, X.category_by_name) == ["task", "story", "other", "bug", "story", "other", "task"]


def test_module_names(spark):
    df = column(spark, ["arc", "xerces-1.4.4", "log4j-1.2"])
    assert applied(df, X.module_project) == ["", "xerces", "log4j"]
    assert applied(df, X.module_version) == ["", "1.4.4", "1.2"]
    assert applied(column(spark, ["file:/a/b/log4j-1.2.csv"]), X.file_stem) == ["log4j-1.2"]


def test_repository_key_without_slash_is_null(spark):
    assert applied(column(spark, ["apache/camel", "nokey"]), X.repository_key) == ["CAMEL", None]


def test_dates(spark):
    iso = column(spark, ["2022-01-01T00:01:39Z", "2023/99/01", None])
    assert applied(iso, lambda _: X.timestamp_of(iso, "x")) == [datetime.datetime(2022, 1, 1, 0, 1, 39), None, None]
    day_first = column(spark, ["02/11/2023 10:00", "31/02/2023 10:00"])
    assert applied(day_first, lambda _: X.timestamp_of(day_first, "x", "dd/MM/yyyy HH:mm")) == [
        datetime.datetime(2023, 11, 2, 10, 0),
        None,
    ]


def test_null_date_gives_empty_sprint(spark):
    df = column(spark, [datetime.datetime(2023, 3, 4), None], "timestamp")
    assert applied(df, X.sprint_key) == ["2023-3", ""]
    assert [r[0] for r in spark.sql("select '' as x").select(X.sprint_part(F.col("x"), 0)).collect()] == [None]


def test_chi2_tail_against_erfc(spark):
    points = [0.0, 0.1, 1.0, 3.841, 6.635, 10.0, 17.9, 18.1, 30.0, 645.59]
    for x, p in zip(points, applied(column(spark, points, "double"), N.chi2_one_df_tail)):
        assert p == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-9)


def test_kolmogorov_tail_against_direct_series(spark):
    df = spark.createDataFrame([(0.1, 100.0, 80.0), (0.3, 50.0, 60.0), (0.0, 10.0, 10.0)], "d double, a double, b double")
    got = [r[0] for r in df.select(N.kolmogorov_tail(F.col("d"), F.col("a"), F.col("b"))).collect()]
    for (d, a, b), p in zip([(0.1, 100, 80), (0.3, 50, 60)], got):
        lam2 = d * d * a * b / (a + b)
        want = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam2) for k in range(1, 101))
        assert p == pytest.approx(min(1.0, want), abs=1e-12)
    assert got[2] == 1.0


def test_hash_uniform_and_poisson(spark):
    df = spark.range(20000).select(N.hash_uniform(F.col("id").cast("string")).alias("u"))
    row = df.select(F.min("u"), F.max("u"), F.avg("u"), F.avg(N.poisson_one(F.col("u"))), F.var_samp(N.poisson_one(F.col("u")))).first()
    assert 0 <= row[0] and row[1] < 1
    assert row[2] == pytest.approx(0.5, abs=0.01)
    assert row[3] == pytest.approx(1.0, abs=0.03)
    assert row[4] == pytest.approx(1.0, abs=0.05)


def test_clip_keeps_null(spark):
    assert applied(column(spark, [-1.0, None, 3.0], "double"), lambda c: N.at_least(c, 0.0)) == [0.0, None, 3.0]


def test_ratio_of_zero_is_null_or_zero(spark):
    df = spark.createDataFrame([(3, 0), (1, 4)], "a int, b int")
    assert [r[0] for r in df.select(N.ratio(F.col("a"), F.col("b"), 3)).collect()] == [None, 0.25]
    assert [r[0] for r in df.select(N.ratio_or_zero(F.col("a"), F.col("b"))).collect()] == [0.0, 0.25]
