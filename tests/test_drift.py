import numpy as np
import pytest
from pyspark.sql import functions as F

from sprintlens.operators import drift


def brute_psi(expected, actual):
    edges = np.percentile(expected, np.linspace(0, 100, 11))[1:-1]
    bins = lambda v: np.bincount(np.searchsorted(edges, v, side="right"), minlength=10) / len(v)
    e, a = bins(expected).clip(1e-6), bins(actual).clip(1e-6)
    return float(np.sum((a - e) * np.log(a / e)))


def brute_ks(a, b):
    axis = np.union1d(a, b)
    cdf = lambda v: np.searchsorted(np.sort(v), axis, side="right") / len(v)
    return float(np.max(np.abs(cdf(a) - cdf(b))))


def frame(spark, cohorts, name="x"):
    rows = [(c, float(v)) for c, values in cohorts.items() for v in values]
    return spark.createDataFrame(rows, f"c string, {name} double")


def is_(c):
    return F.col("c") == c


def test_against_brute_force_for_several_cohorts(spark, many_chunks):
    rng = np.random.default_rng(5)
    data = {
        "ref": np.round(rng.normal(size=500), 2),
        "near": np.round(rng.normal(0.1, 1, 300), 2),
        "far": np.round(rng.normal(2, 0.5, 200), 2),
        "zeros": np.where(rng.random(250) < 0.8, 0.0, rng.random(250)),
    }
    cohorts = {c: is_(c) for c in ("near", "far", "zeros")}
    got = {r["cohort"]: r for r in drift.drift_by_cohort(frame(spark, data), is_("ref"), cohorts, ["x"], None).collect()}
    for c in cohorts:
        assert got[c]["psi"] == pytest.approx(brute_psi(data["ref"], data[c]), abs=1e-9)
        assert got[c]["ks_stat"] == pytest.approx(brute_ks(data["ref"], data[c]), abs=1e-12)
    assert (got["near"]["drift_flag"], got["far"]["drift_flag"]) == (0, 1)


def test_a_sample_against_itself_and_a_constant(spark):
    df = spark.createDataFrame([(float(i % 3 == 0), 1.0) for i in range(60)], "x double, k double")
    for r in drift.drift_report(df, F.lit(True), F.lit(True), ["x", "k"]).collect():
        assert (r["psi"], r["ks_stat"], r["p_value"], r["drift_flag"]) == (0.0, 0.0, 1.0, 0)


def test_small_samples_are_left_out_and_nulls_ignored(spark):
    df = frame(spark, {"ref": range(50), "cur": range(9)}).unionByName(
        spark.createDataFrame([("cur", None)] * 20, "c string, x double")
    )
    assert drift.drift_report(df, is_("ref"), is_("cur"), ["x"]).count() == 0


def test_shift_changes_one_feature_only(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "log_avg_cycle_time double, log_cycle_x_bsr double")
    got = {(r["shift"], r["log_avg_cycle_time"], r["log_cycle_x_bsr"]) for r in drift.simulated_shift(df).collect()}
    assert got == {(0.0, 2.0, 3.0), (0.2, 2.4, 3.0), (0.5, 3.0, 3.0)}


def test_guards_and_lights(spark):
    df = spark.createDataFrame([("f2", 0.89), ("brier", 0.05), ("f2_drop", 0.03), ("other", 1.0)], "key string, value double")
    got = {r["guard"]: r["fired"] for r in drift.monitoring_guards(df).collect()}
    assert got == {"retrain_level": True, "calibration": False, "retrain_drop": True}
    lights = spark.range(1).select(*drift.health_lights(F.lit(0.86), F.lit(0.5), F.lit(0.05))).first()
    assert tuple(lights) == ("amber", "red", "green")


def test_years_with_few_rows_are_left_out(spark):
    from sprintlens import params as P

    rows = [(2000 + (i >= 40), i % 2, (i % 10) / 10, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "sprint_year long, defecto_escapado int, p double, v double")
    df = df.withColumns({f: F.col("v") for f in (*P.FEATURES[:5], "log_bug_story_ratio")})
    out = drift.yearly_drift(df, 2000).collect()
    assert [(r["sprint_year"], r["n_sprints"], r["psi_bsr"]) for r in out] == [(2000, 40, 0.0)]


def paths_apart(d, m, n):
    """Share of all orders of m and n values whose distribution functions are d apart or more."""
    from itertools import combinations

    far = total = 0
    for chosen in combinations(range(m + n), m):
        i = j = 0
        gap = 0.0
        for s in range(m + n):
            i, j = (i + 1, j) if s in chosen else (i, j + 1)
            gap = max(gap, abs(i / m - j / n))
        total += 1
        far += gap >= d - 1e-12
    return far / total


@pytest.mark.parametrize("m,n", [(3, 3), (4, 6), (5, 7), (2, 9), (6, 6), (1, 4)])
def test_exact_p_values_equal_enumeration(m, n):
    for d in sorted({abs(i / m - j / n) for i in range(m + 1) for j in range(n + 1)}):
        assert drift.lattice_tail(d, m, n) == pytest.approx(paths_apart(d, m, n), abs=1e-12)
        assert drift.lattice_tail(d, n, m) == pytest.approx(drift.lattice_tail(d, m, n), abs=1e-12)


def test_exact_p_values_come_near_the_limit_and_stop_at_the_bound(spark, monkeypatch):
    df = spark.createDataFrame([(0.03, 3000.0, 2500.0), (0.2, 300.0, 250.0), (0.0, 50.0, 60.0)], "d double, a double, b double")
    p = [r[0] for r in df.select(drift.two_sample_tail(F.col("d"), F.col("a"), F.col("b"))).collect()]
    series = [r[0] for r in df.select(drift.N.kolmogorov_tail(F.col("d"), F.col("a"), F.col("b"))).collect()]
    assert p[2] == 1.0 and p == pytest.approx(series, abs=0.02) and p[:2] != series[:2]
    monkeypatch.setattr(drift, "EXACT_ROWS", 10)
    assert [r[0] for r in df.select(drift.two_sample_tail(F.col("d"), F.col("a"), F.col("b"))).collect()] == series
