import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.operators import explain, metrics, models, risk, scoring
from sprintlens.sources import readers, writers


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        values = {f: float(rng.integers(0, 5)) for f in P.FEATURES}
        y = float(values["num_bugs_sprint"] + 0.5 * values["log_avg_cycle_time"] + rng.normal() > 3)
        rows.append((f"s{i}", "ABC"[i % 3], ("train", "train", "cal", "val", "test")[i % 5], y, *values.values()))
    names = ", ".join(f"{f} double" for f in P.FEATURES)
    df = spark.createDataFrame(rows, f"sprint_id string, project string, split string, {P.LABEL} double, {names}").persist()
    yield df
    df.unpersist()


def part(df, name):
    return df.where(F.col("split") == name)


def test_grid_has_fifteen_trials():
    grid = models.logistic_grid()
    assert len(grid) == 15 and sum(p["smote"] for p in grid) == 3


def test_logistic_trials_score_every_parameter(matrix):
    grid = [{"C": 1.0, "penalty": "l2", "smote": False}, {"C": 0.1, "penalty": "l1", "smote": False}, {"C": 1.0, "penalty": "l2", "smote": True}]
    table, fitted = models.logistic_trials(part(matrix, "train"), part(matrix, "val"), grid)
    rows = table.collect()
    assert len(rows) == 3 and len(fitted) == 3 and all(r["roc_auc"] > 0.8 for r in rows)
    best = models.best_trial(table).first()
    assert best["f2"] == max(r["f2"] for r in rows)


def test_models_score_in_a_session_that_observed_rows(spark, matrix):
    """The first observation gives a session a part that can't be sent to tasks."""
    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    train, val = part(matrix, "train"), part(matrix, "val")
    table, fitted = models.logistic_trials(train, val, [{"C": 1.0, "penalty": "l2", "smote": False}])
    assert table.count() == 1
    for model in (*fitted.values(), models.forest({"numTrees": 2, "maxDepth": 2})(train)):
        assert scoring.predict(model, val).where("p between 0 and 1").count() == val.count()


def test_grid_point_equals_newton_steps(matrix):
    """Coefficients of one l2 trial against Newton steps on the same prepared rows."""
    train = part(matrix, "train")
    _, fitted = models.logistic_trials(train, part(matrix, "val"), [{"C": 0.5, "penalty": "l2", "smote": False}])
    got = next(iter(fitted.values())).stages[-1]
    rows = np.array(train.select(P.LABEL, *P.FEATURES).collect(), float)
    y, x = rows[:, 0], rows[:, 1:]
    x = (x - x.mean(0)) / x.std(0, ddof=1)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    x1, beta = np.column_stack([x, np.ones(len(y))]), np.zeros(x.shape[1] + 1)
    penalty = np.diag([1 / 0.5] * x.shape[1] + [0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-x1 @ beta))
        beta -= np.linalg.solve(x1.T @ (x1 * (w * q * (1 - q))[:, None]) + penalty, x1.T @ (w * (q - y)) + penalty @ beta)
    assert np.allclose([*got.coefficients, got.intercept], beta, atol=2e-3)


def test_champion_needs_a_margin():
    assert models.select_champion(0.9, 0.904) == "boosted"
    assert models.select_champion(0.9, 0.906) == "leafwise"


def test_folds_and_summary(matrix):
    table = models.fold_metrics(matrix, models.boosted({"maxIter": 2, "maxDepth": 2}), ["A", "B", "Z"])
    assert {r["project"] for r in table.collect()} == {"A", "B"}
    assert models.fold_summary(table).first()["folds"] == 2


def test_isotonic_pools_violators(spark):
    rows = [(0.1, 0), (0.4, 0), (0.4, 1), (0.35, 1), (0.8, 1), (0.8, 0), (0.9, 1)]
    df = spark.createDataFrame([(float(p), int(y)) for p, y in rows], "p double, y int")
    apply = models.fit_isotonic(df, "y")
    probe = spark.createDataFrame([(0.0,), (0.4,), (0.9,), (2.0,)], "p double")
    assert [r["q"] for r in apply.on(probe, "p", "q").collect()] == pytest.approx([0.0, 0.6, 1.0, 1.0])


def test_platt_matches_newton_on_smoothed_targets(spark):
    rng = np.random.default_rng(4)
    p = np.round(rng.random(500), 2)
    y = (rng.random(500) < p**2).astype(int)
    apply = models.fit_platt(spark.createDataFrame(list(zip(map(float, p), map(int, y))), "p double, y int"), "y")
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, beta = np.column_stack([p, np.ones(500)]), np.zeros(2)
    for _ in range(50):
        q = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve(x.T @ (x * (q * (1 - q))[:, None]), x.T @ (t - q))
    probe = spark.createDataFrame([(v,) for v in (0.0, 0.3, 0.9)], "p double")
    want = 1 / (1 + np.exp(-(beta[0] * np.array([0.0, 0.3, 0.9]) + beta[1])))
    assert np.allclose([r["q"] for r in apply.on(probe, "p", "q").collect()], want, atol=1e-4)


def test_calibration_keeps_the_lowest_brier_on_cal(spark):
    rng = np.random.default_rng(6)
    p = np.round(rng.random(1500), 2)
    y = (rng.random(1500) < p**3).astype(int)
    split = np.array(["cal", "val", "test"])[np.arange(1500) % 3]
    df = spark.createDataFrame(
        [(str(s), float(a), int(b)) for s, a, b in zip(split, p, y)], f"split string, p double, {P.LABEL} int"
    )
    winner, apply, table = models.calibrate(df)
    cal = {r["method"]: r["brier"] for r in table.where("split = 'cal'").collect()}
    assert winner == min(cal, key=cal.get) == "isotonic" and apply is not None
    assert table.count() == 9


def test_saved_model_scores_alike(spark, matrix, tmp_path):
    model = models.refit("boosted", {"n_estimators": 3, "max_depth": 2}, matrix)
    writers.save_model(model, str(tmp_path / "m"))
    probe = part(matrix, "test")
    a = {r["sprint_id"]: r["p"] for r in scoring.predict(model, probe).collect()}
    b = {r["sprint_id"]: r["p"] for r in scoring.predict(readers.load_model(str(tmp_path / "m")), probe).collect()}
    assert a == b and all(0 <= v <= 1 for v in a.values())


def test_champion_report(matrix):
    train = part(matrix, "train")
    fitted = {"boosted": models.boosted({"maxIter": 3})(train), "forest": models.forest({"numTrees": 3})(train)}
    out = models.champion_report(fitted, {"boosted": 0.9, "forest": 0.95}, matrix).collect()
    assert {(r["model"], r["champion"]) for r in out} == {("boosted", False), ("forest", True)}
    assert len(out) == 4 and len({r["mcnemar_p"] for r in out}) == 1


def test_sampled_contributions_add_up(spark, matrix):
    model = models.boosted({"maxIter": 3, "maxDepth": 3})(part(matrix, "train"))
    probe = part(matrix, "test").limit(20)
    table = explain.sampled_contributions(model, probe, P.FEATURES, "sprint_id", rounds=4,
        background=probe.orderBy("sprint_id").limit(1))
    sums = {r["sprint_id"]: r["s"] for r in table.groupBy("sprint_id").agg(F.sum("contribution").alias("s")).collect()}
    p = {r["sprint_id"]: r["p"] for r in scoring.predict(model, probe).collect()}
    gaps = {round(p[i] - sums[i], 9) for i in p}
    assert len(gaps) == 1 and next(iter(gaps)) in {round(v, 9) for v in p.values()}
    assert table.count() == 20 * len(P.FEATURES)


def test_linear_contributions_and_drivers(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", 3.0, 2.0)], "i string, x double, z double")
    table = explain.linear_contributions(df, {"x": 2.0, "z": -1.0}, ["i"])
    got = {(r["i"], r["feature"]): r["contribution"] for r in table.collect()}
    assert got == {("a", "x"): -2.0, ("a", "z"): 1.0, ("b", "x"): 2.0, ("b", "z"): -1.0}
    drivers = {r["i"]: (r["driver_1"], r["driver_2"]) for r in explain.top_drivers(table, ["i"]).collect()}
    assert drivers == {"a": ("z", "x"), "b": ("x", "z")}
    assert [r["feature"] for r in explain.global_importance(table).collect()] == ["x", "z"]


def test_local_case_falls_back_to_any_project(spark):
    rows = [("1", "A", 0.9, 1), ("2", "B", 0.95, 1), ("3", "A", 0.2, 0), ("4", "B", 0.1, 0), ("5", "B", 0.1, 0)]
    df = spark.createDataFrame(rows, f"sprint_id string, project string, p double, {P.LABEL} int")
    cases = explain.local_cases(df, [("tp", "A"), ("tn", "Z"), ("fn", "A")]).collect()
    assert {(r["cell"], r["sprint_id"]) for r in cases} == {("tp", "1"), ("tn", "4")}


def test_partial_dependence_grid_and_mean(spark):
    rows = [(float(i), float(i % 2)) for i in range(101)]
    df = spark.createDataFrame(rows, "x double, k double")
    out = explain.partial_dependence(df, lambda d: d.withColumn("p", F.col("x") + 10 * F.col("k")), ["x", "k"], points=11)
    got = {(r["feature"], round(r["value"], 6)): r["mean_p"] for r in out.collect()}
    assert len(got) == 13
    assert got[("k", 1.0)] == pytest.approx(60.0)
    assert got[("x", 5.0)] == pytest.approx(5 + 10 * 50 / 101) and ("x", 95.0) in got


def test_risk_tables(spark):
    rows = [("s1", "A", 2020, 0.5, 3), ("s2", "A", 2021, 0.3, 1), ("s3", "B", 2021, 0.1, 0), ("s4", "B", 2021, 0.5, 0)]
    scored = spark.createDataFrame(rows, "sprint_id string, project string, sprint_year int, p double, num_bugs_sprint int")
    drivers = spark.createDataFrame([("s1", "cycle_missing", "unknown")], "sprint_id string, driver_1 string, driver_2 string")
    snapshot = risk.risk_snapshot(scored, drivers)
    assert {r["sprint_id"]: r["riesgo_categoria"] for r in snapshot.collect()} == {"s1": "alto", "s2": "medio", "s3": "bajo", "s4": "alto"}
    top = risk.riskiest(snapshot, limit=2).collect()
    assert [r["sprint_id"] for r in top] == ["s1", "s4"] and (top[0]["driver1"], top[0]["driver2"]) == ("No cycle time", "unknown")
    assert [r["sprint_id"] for r in risk.riskiest(snapshot, year=2021, level="medio").collect()] == ["s2"]
    assert risk.risk_by(snapshot, "project", 1).first()["project"] == "A"
    assert {r["riesgo_categoria"]: r["rows"] for r in risk.level_totals(snapshot).collect()} == {"alto": 2, "medio": 1, "bajo": 1}
    assert risk.score_histogram(snapshot).agg(F.sum("n")).first()[0] == 4


def test_baselines(spark):
    rows = [("train", y, x) for y, x in [(1, 2.0), (1, 1.5), (1, 1.0), (0, 0.0), (0, 0.2)]] + [("val", 1, None), ("val", 0, 0.1), ("test", 1, 9.0)]
    df = spark.createDataFrame(rows, f"split string, {P.LABEL} int, log_bug_story_ratio double")
    train = df.where("split = 'train'")
    majority = scoring.majority_class(train).first()
    assert (majority["majority_class"], majority["majority_rate"]) == (1, 0.6)
    x = np.array([2.0, 1.5, 1.0, 0.0, 0.2])
    cut = scoring.ratio_threshold(train).first()
    assert cut["f2"] == 1.0 and cut["threshold"] == pytest.approx(min(t for t in np.percentile(x, np.arange(10, 91, 5)) if 0.2 < t <= 1.0))
    out = {(r["baseline"], r["split"]): r for r in scoring.run_baselines(df).collect()}
    assert len(out) == 8 and out[("majority", "val")]["tp"] == 1
    # the missing ratio scores .5, so it counts as flagged
    assert out[("ratio_auto", "val")]["tp"] == 1 and out[("ratio_auto", "val")]["tn"] == 1


def test_closed_form_terms_sum_to_the_logit(spark):
    row = dict(num_bugs_sprint=4, num_stories_sprint=2, num_tasks_sprint=1, log_avg_cycle_time=2.0, cycle_missing=0,
               change_failure_rate=None, deploy_frequency_weekly=3.0)
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'double' if 'log' in k or 'rate' in k or 'deploy' in k else 'long'}" for k in row))
    total = scoring.contributions(df, []).agg(F.sum("contribution")).first()[0]
    p = scoring.closed_form_score(df, -1.9).first()["p"]
    assert p == pytest.approx(1 / (1 + np.exp(-(total - 1.9))))
    logit = -1.9 + 1.05 * (2 - 3) + 1.25 * (4 / 3 - 0.3) + 0.55 * (np.log1p(7) - 2.5) + 0.25 * 0.03 * np.log1p(3)
    assert p == pytest.approx(1 / (1 + np.exp(-logit)))


def test_contributions_of_a_pipeline_with_preparation(spark, matrix):
    _, fitted = models.logistic_trials(
        part(matrix, "train"), part(matrix, "val"), [{"C": 0.1, "penalty": "l2", "smote": False}]
    )
    model = next(iter(fitted.values()))
    probe = part(matrix, "test").orderBy("sprint_id").limit(10)
    base = probe.limit(1)
    table = explain.sampled_contributions(model, probe, P.FEATURES, "sprint_id", rounds=2, background=base)
    sums = {r["sprint_id"]: r["s"] for r in table.groupBy("sprint_id").agg(F.sum("contribution").alias("s")).collect()}
    p = {r["sprint_id"]: r["p"] for r in scoring.predict(model, probe).collect()}
    start = scoring.predict(model, base).first()["p"]
    assert all(abs(p[i] - start - sums[i]) < 1e-9 for i in p)
