import numpy as np
import pytest
from pyspark.sql import functions as F

from sprintlens.operators import metrics as M

TIED = [(0.1, 0), (0.4, 0), (0.4, 1), (0.35, 1), (0.8, 1), (0.8, 0), (0.9, 1)]


def frame(spark, rows):
    return spark.createDataFrame([(float(p), int(y)) for p, y in rows], "p double, y int")


def random_scores(n=2000, seed=1):
    rng = np.random.default_rng(seed)
    p = np.round(rng.random(n), 3)
    return list(zip(p, (rng.random(n) < p).astype(int)))


def test_tied_scores(spark, many_chunks):
    row = M.metric_suite(frame(spark, TIED), "y").first()
    assert (row["roc_auc"], row["pr_auc"]) == (0.6667, 0.7333)
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (2, 1, 2, 2)


def test_auc_equals_spark_evaluator(spark, many_chunks):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = frame(spark, random_scores())
    mine = M.metric_suite(df, "y", digits=None).first()["roc_auc"]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0).evaluate(df)
    assert mine == pytest.approx(theirs, abs=1e-12)


def test_one_class_and_no_predicted_positives(spark):
    row = M.metric_suite(frame(spark, [(0.9, 1), (0.2, 1)]), "y").first()
    assert row["roc_auc"] is None and row["f2"] == pytest.approx(0.5556)
    row = M.metric_suite(frame(spark, [(0.01, 1), (0.01, 0)]), "y").first()
    assert (row["precision"], row["f2"], row["recall"]) == (0.0, 0.0, 0.0)


def test_grouped_suite_equals_separate_suites(spark, many_chunks):
    df = frame(spark, random_scores()).withColumn("g", (F.monotonically_increasing_id() % 3).cast("int"))
    df = spark.createDataFrame(df.collect(), df.schema)
    grouped = {r["g"]: r for r in M.metric_suite(df, "y", by=["g"]).collect()}
    for g in range(3):
        alone = M.metric_suite(df.where(F.col("g") == g), "y").first()
        assert all(alone[c] == grouped[g][c] for c in ("f2", "pr_auc", "roc_auc", "brier", "tp", "tn"))


def test_sweep_equals_loop_and_cells_sum_to_n(spark):
    rows = random_scores() + [(k / 100, k % 2) for k in range(101)] + [(np.nextafter(k / 100, 0), 1) for k in range(1, 101)]
    p, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    got = M.threshold_sweep(frame(spark, rows), "y", digits=None).orderBy("threshold").collect()
    assert len(got) == 91
    for i, r in enumerate(got):
        t = (5 + i) / 100.0
        hit = p >= t
        tp, fp, fn = (hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum()
        assert (r["threshold"], r["tp"], r["fp"], r["fn"]) == (t, tp, fp, fn)
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == len(rows)
        assert r["business_value"] == tp - fp - 3 * fn


def test_sweep_lists_every_threshold_even_without_scores_there(spark):
    got = M.threshold_sweep(frame(spark, [(0.99, 1), (0.01, 0)]), "y").collect()
    assert len(got) == 91 and all((r["tp"], r["fp"], r["fn"], r["tn"]) == (1, 0, 0, 1) for r in got)


def test_best_threshold_ties_go_low(spark):
    best = M.best_thresholds(M.threshold_sweep(frame(spark, [(0.9, 1), (0.5, 0)]), "y")).first()
    assert (best["threshold_f2"], best["f2_max"], best["threshold_value"]) == (0.51, 1.0, 0.51)


def test_report_chooses_on_val_only(spark):
    val = [(0.9, 1, "val"), (0.5, 0, "val")]
    test = [(0.3, 1, "test"), (0.6, 0, "test")]
    df = spark.createDataFrame(val + test, "p double, y int, split string")
    out = {(r["rule"], r["split"]): r for r in M.threshold_report(df, label="y").collect()}
    assert len(out) == 4 and {r["threshold"] for r in out.values()} == {0.51}
    assert (out[("f2", "test")]["fp"], out[("f2", "test")]["fn"]) == (1, 1)


def test_reliability_bins_close_on_the_right(spark):
    got = {r["bin"]: r["n"] for r in M.reliability_curve(frame(spark, [(0.1, 1), (0.10001, 0), (1.0, 1), (0.0, 0)]), "y").collect()}
    assert got == {0: 2, 1: 1, 9: 1}


def test_pr_curve_has_a_point_per_distinct_score(spark, many_chunks):
    got = {r["threshold"]: (r["precision"], r["recall"]) for r in M.pr_curve(frame(spark, TIED), "y").collect()}
    assert len(got) == 5 and got[0.9] == (1.0, 0.25) and got[0.1] == (pytest.approx(4 / 7), 1.0)


def test_mcnemar(spark):
    df = spark.createDataFrame([(1, 1, 1), (0, 0, 0)], "y int, a int, b int")
    same = M.mcnemar(df, "y", "a", "b").first()
    assert (same["statistic"], same["p_value"], same["significant"]) == (0.0, 1.0, False)
    rows = [(1, 1, 0)] * 30 + [(1, 0, 1)] * 10
    row = M.mcnemar(spark.createDataFrame(rows, "y int, a int, b int"), "y", "a", "b").first()
    assert row["statistic"] == pytest.approx(19**2 / 40) and row["p_value"] == pytest.approx(0.00266, abs=1e-5)


def test_bootstrap_interval_covers_the_point_and_is_repeatable(spark):
    rows = [(i, float(p), int(y)) for i, (p, y) in enumerate(random_scores(400))]
    df = spark.createDataFrame(rows, "id long, p double, y int")
    run = lambda d: {
        r["metric"]: (r["ci_lo"], r["ci_hi"])
        for r in M.bootstrap_ci(M.bootstrap_replicates(d, "id", "y", replicates=60, digits=None)).collect()
    }
    point, ci = M.metric_suite(df, "y", digits=None).first(), run(df)
    assert set(ci) == {"f2", "recall", "precision", "pr_auc", "brier"}
    for m, (lo, hi) in ci.items():
        assert lo < point[m] < hi
    again = run(df.repartition(5))
    assert all(again[m] == pytest.approx(ci[m]) for m in ci)


def test_bootstrap_width_matches_a_multinomial_one(spark):
    scores = random_scores(400)
    df = spark.createDataFrame([(i, float(p), int(y)) for i, (p, y) in enumerate(scores)], "id long, p double, y int")
    replicates = M.bootstrap_replicates(df, "id", "y", replicates=200, digits=None)
    mine = replicates.agg(F.stddev_samp("brier")).first()[0]
    rng, loss = np.random.default_rng(0), np.array([(p - y) ** 2 for p, y in scores])
    theirs = np.std([loss[rng.integers(0, 400, 400)].mean() for _ in range(500)], ddof=1)
    assert mine == pytest.approx(theirs, rel=0.2)


def test_leaderboard_orders_by_f2(spark):
    a = M.metric_suite(frame(spark, TIED), "y").withColumn("label", F.lit("a"))
    b = M.metric_suite(frame(spark, [(0.9, 1), (0.1, 0)]), "y").withColumn("label", F.lit("b")).withColumn("x", F.lit(1))
    table = M.leaderboard(a, b)
    assert table.columns[0] == "label" and "x" not in table.columns
    assert [r["label"] for r in table.collect()] == ["b", "a"]
