import numpy as np
import pytest
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.operators import features, oversample
from sprintlens.operators.neighbours import nearest_rows


def gold(spark, rows):
    base = dict(
        project="A", sprint_year=2010, sprint_month=3, bug_story_ratio=1.0, avg_cycle_time_days=10.0,
        num_bugs_sprint=1, num_stories_sprint=1, num_tasks_sprint=0, total_issues_sprint=2,
        deploy_frequency_weekly=None, change_failure_rate=None, defecto_escapado=1,
    )
    schema = (
        "project string, sprint_year bigint, sprint_month bigint, bug_story_ratio double, avg_cycle_time_days double,"
        "num_bugs_sprint bigint, num_stories_sprint bigint, num_tasks_sprint bigint, total_issues_sprint bigint,"
        "deploy_frequency_weekly double, change_failure_rate double, defecto_escapado int"
    )
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], schema)


def test_missing_flags_come_before_filling(spark):
    df = gold(spark, [dict(bug_story_ratio=None, avg_cycle_time_days=None), dict(total_issues_sprint=0)])
    a, b = features.engineer_features(df).collect()
    assert (a["bsr_missing"], a["cycle_missing"], a["dora_missing"], a["log_bug_story_ratio"]) == (1, 1, 1, 0.0)
    assert (b["bsr_missing"], b["bugs_per_issue"]) == (0, 1.0)
    assert b["log_cycle_x_bsr"] == pytest.approx(np.log1p(10) * np.log1p(1))


def test_splits_are_disjoint_and_complete(spark):
    df = features.feature_matrix(gold(spark, [dict(sprint_year=y) for y in range(1999, 2024)]))
    counts = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert counts == {"train": 15, "cal": 1, "val": 3, "test": 3}


def test_folds_skip_absent_projects(spark):
    df = gold(spark, [dict(project=p) for p in "AABC"])
    parts = features.folds(df, ["A", "Z", "B"])
    assert [(p, tr.count(), te.count()) for p, tr, te in parts] == [("A", 2, 2), ("B", 3, 1)]
    sizes = {r["project"]: (r["train_rows"], r["test_rows"]) for r in features.fold_sizes(df, ["A", "Z", "B"]).collect()}
    assert sizes == {"A": (2, 2), "B": (3, 1)}


def test_the_two_what_if_variants_differ(spark):
    df = spark.createDataFrame(
        [(3, 0, 2, 5.0, 2020, 6, None, None), (-1, 2, 2, None, 2020, 6, 1.0, 0.5)],
        "bugs bigint, stories bigint, tasks bigint, cycle double, year bigint, month bigint, deploy double, cfr double",
    )
    app = features.what_if_app(df).collect()[0]
    board = features.what_if_dashboard(df).collect()
    assert (app["log_bug_story_ratio"], app["bsr_missing"], app["dora_missing"]) == (0.0, 1, 1)
    assert board[0]["log_bug_story_ratio"] == pytest.approx(np.log1p(1.5)) and board[0]["bsr_missing"] == 1
    assert (board[1]["num_bugs_sprint"], board[1]["total_issues_sprint"], board[1]["cycle_missing"]) == (0.0, 3.0, 1)
    assert (board[1]["deploy_frequency_weekly"], board[1]["dora_missing"]) == (1.0, 0)


def test_class_weights(spark):
    df = gold(spark, [dict(defecto_escapado=y) for y in (1, 1, 1, 0)])
    got = {r[P.LABEL]: (r["weight"], r["scale_pos_weight"]) for r in features.class_weights(df).collect()}
    assert got[0] == (2.0, 1 / 3) and got[1][0] == pytest.approx(2 / 3)
    weighted = features.add_balanced_weight(df)
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(4.0)


def test_impute_and_scale(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", None, 5.0), ("c", 4.0, 5.0), ("d", 7.0, 5.0)], "i string, x double, k double")
    out = features.impute_and_scale(df, ["x", "k"], ["i"]).orderBy("i").collect()
    x = np.array([1, 4, 4, 7.0])
    assert np.allclose([r["x"] for r in out], (x - x.mean()) / x.std(ddof=1))
    assert [r["k"] for r in out] == [0.0] * 4


def points(spark, minority=9, majority=31):
    rng = np.random.default_rng(3)
    rows = [(f"m{i:03d}", 0.0, *map(float, rng.normal(size=3))) for i in range(minority)]
    rows += [(f"M{i:02d}", 1.0, *map(float, rng.normal(2, 1, size=3))) for i in range(majority)]
    return spark.createDataFrame(rows, "i string, y double, a double, b double, c double"), rows


def test_neighbours_equal_brute_force(spark):
    df, rows = points(spark, minority=120, majority=1)
    small = df.where("y = 0").select("i", F.array("a", "b", "c").alias("x"))
    got = {r["id"]: [n["other"] for n in r["neighbours"]] for r in nearest_rows(small, "i", 5, cell_rows=16).collect()}
    vectors = {r[0]: np.array(r[2:]) for r in rows if r[1] == 0}
    assert len(got) == 120
    for i, v in vectors.items():
        want = sorted((o for o in vectors if o != i), key=lambda o: (np.sum((vectors[o] - v) ** 2), o))[:5]
        assert got[i] == want


def test_compared_pairs_stay_bounded_for_identical_rows(spark, many_chunks):
    same = spark.range(400).select(F.col("id").cast("string").alias("i"), F.array(F.lit(1.0), F.lit(2.0)).alias("x"))
    out = oversample.near_rows(same, "i", 2, reach=4).collect()
    assert len(out) == 400 and all(len(r["neighbours"]) == 5 for r in out)


def test_smote_balances_exactly_and_interpolates(spark):
    df, rows = points(spark)
    out = oversample.smote(df, ["a", "b", "c"], "y", "i").collect()
    assert sum(r["y"] == 0 for r in out) == sum(r["y"] == 1 for r in out) == 31
    new = [r for r in out if r["synthetic"]]
    assert len(new) == 22 and len({r["i"] for r in new}) == 22
    base = np.array([r[2:] for r in rows if r[1] == 0])
    for r in new:
        assert np.all(np.array([r["a"], r["b"], r["c"]]) >= base.min(axis=0) - 1e-9)
        assert np.all(np.array([r["a"], r["b"], r["c"]]) <= base.max(axis=0) + 1e-9)
    again = {r["i"]: r["a"] for r in oversample.smote(df.repartition(3), ["a", "b", "c"], "y", "i").collect()}
    assert again == {r["i"]: r["a"] for r in out}
