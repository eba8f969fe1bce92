"""Population stability, two-sample distance, cohort reports, monitoring rules."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.functions import numeric as N
from sprintlens.operators.metrics import metric_suite
from sprintlens.operators.ranking import collapse, percentiles_from_totals, running_totals
from sprintlens.operators.shaping import with_row

BINS = 10
#: Sample size up to which path counts give the p-value, as in the published library.
EXACT_ROWS = 10_000


def drift_by_cohort(
    df: DataFrame,
    reference: Column,
    cohorts: dict[str, Column],
    features: Sequence[str],
    digits: int | None = 4,
    exact: bool = True,
) -> DataFrame:
    """Distance, p-value, stability index and flag per cohort and feature.

    Reference and cohorts are conditions on the rows of one frame. Their counts per
    distinct value stand side by side, so one running total serves every cohort: the
    largest gap of two distribution functions, the reference deciles, and the bin counts.
    p-values of samples up to EXACT_ROWS are exact unless `exact` is off.
    """
    names = ["n_ref", *[f"n_{i}" for i in range(len(cohorts))]]
    member = [F.coalesce(c, F.lit(False)).cast("int").alias(n) for n, c in zip(names, [reference, *cohorts.values()])]
    long = (
        df.select(*member, *[F.col(f).cast("double").alias(f) for f in features])
        .where(" + ".join(names) + " > 0")
        .unpivot(names, list(features), "feature", "value")
        .where(F.col("value").isNotNull())
    )
    counts = collapse(long, "value", ["feature"], **{n: F.col(n) for n in names})
    totals = running_totals(counts, "value", names, ["feature"])

    # One row of nine numbers per listed feature, so the hint is safe by construction.
    edges = F.broadcast(
        percentiles_from_totals(totals, "value", "n_ref", [i / BINS for i in range(1, BINS)], ["feature"])
        .select("feature", F.col("percentiles").alias("edges"))
    )
    reach = lambda n: N.ratio_or_zero(F.col(f"{n}_upto"), F.col(f"{n}_total"))
    bin_no = F.size(F.filter("edges", lambda e: e <= F.col("value"))).alias("bin")
    bins = totals.join(edges, "feature").groupBy("feature", bin_no).agg(
        *[F.sum(n).alias(n) for n in names],
        *[F.max(f"{n}_total").alias(f"{n}_total") for n in names],
        *[F.max(F.abs(reach("n_ref") - reach(n))).alias(f"{n}_gap") for n in names[1:]],
    )
    # At most ten bins per feature from here on; a bin without rows has both shares at the floor.
    sides = F.array(
        *[
            F.struct(
                F.lit(cohort).alias("cohort"),
                F.col(n).alias("n"),
                F.col(f"{n}_total").alias("n_cur"),
                F.col(f"{n}_gap").alias("gap"),
            )
            for cohort, n in zip(cohorts, names[1:])
        ]
    )
    share = lambda part, whole: F.greatest(N.ratio_or_zero(F.col(part), F.col(whole)), F.lit(P.PSI_FLOOR))
    e, a = share("n_ref", "n_ref_total"), share("n", "n_cur")
    measured = (
        bins.select("feature", "n_ref", "n_ref_total", F.explode(sides).alias("s"))
        .select("feature", "n_ref", "n_ref_total", "s.*")
        .groupBy("cohort", "feature")
        .agg(
            F.max("n_ref_total").cast("double").alias("n_ref"),
            F.max("n_cur").cast("double").alias("n_cur"),
            F.max("gap").alias("ks"),
            F.sum((a - e) * F.ln(a / e)).alias("psi"),
        )
        .where((F.col("n_ref") >= P.MIN_SAMPLE) & (F.col("n_cur") >= P.MIN_SAMPLE))
        .withColumn("p", (two_sample_tail if exact else N.kolmogorov_tail)(F.col("ks"), F.col("n_ref"), F.col("n_cur")))
    )
    shaped = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    return measured.select(
        "cohort",
        "feature",
        shaped(F.col("ks")).alias("ks_stat"),
        shaped(F.col("p")).alias("p_value"),
        shaped(F.col("psi")).alias("psi"),
        N.flag((F.col("p") < P.DRIFT_P) & (F.col("psi") > P.DRIFT_PSI)).alias("drift_flag"),
    )


def drift_report(
    df: DataFrame, reference: Column, target: Column, features: Sequence[str] = P.FEATURES,
    digits: int | None = 4, exact: bool = True,
) -> DataFrame:
    """Per feature between two samples of the frame, largest stability index first."""
    report = drift_by_cohort(df, reference, {"target": target}, features, digits, exact)
    return report.drop("cohort").orderBy(F.col("psi").desc(), "feature")


def yearly_drift(
    df: DataFrame,
    reference_end: int = P.DRIFT_REFERENCE_END,
    features: Sequence[str] = P.FEATURES[:5],
    label: str = P.LABEL,
    score: str = "p",
    digits: int | None = 4,
    exact: bool = True,
) -> DataFrame:
    """Per year with enough rows: size, positive rate, suite at .5, ratio PSI, drifted features.

    The years are read first: a handful of calendar numbers.
    """
    year = "sprint_year"
    years = sorted(r[0] for r in df.select(year).where(F.col(year).isNotNull()).distinct().collect())
    ratio_feature = "log_bug_story_ratio"
    watched = list(dict.fromkeys([*features, ratio_feature]))
    shaped = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    suite = metric_suite(df, label, score, 0.5, [year], digits)
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    suite = suite.select(
        year,
        n.alias("n_sprints"),
        shaped(N.ratio(F.col("tp") + F.col("fn"), n)).alias("pos_rate"),
        "f2",
        "pr_auc",
        "brier",
    ).where(F.col("n_sprints") >= P.MIN_YEAR_ROWS)
    cohorts = {str(y): F.col(year) == y for y in years}
    per_feature = drift_by_cohort(df, F.col(year) <= reference_end, cohorts, watched, digits, exact)
    summary = per_feature.groupBy(F.col("cohort").cast("bigint").alias(year)).agg(
        F.max(F.when(F.col("feature") == ratio_feature, F.col("psi"))).alias("psi_bsr"),
        F.sum(F.when(F.col("feature").isin(*features), F.col("drift_flag")).otherwise(0)).alias("n_drift_feat"),
    )
    return suite.join(summary, year, "left")


def simulated_shift(
    df: DataFrame, feature: str = "log_avg_cycle_time", shifts: Sequence[float] = (0.0, 0.2, 0.5)
) -> DataFrame:
    """Every row once per shift, the feature scaled by (1 + shift), nothing else recomputed."""
    shift = F.explode(F.array(*[F.lit(float(s)) for s in shifts]))
    return df.withColumn("shift", shift).withColumn(feature, F.col(feature) * (1 + F.col("shift")))


def simulated_drift(scored: DataFrame, feature: str, label=P.LABEL, score="p", digits: int | None = 4) -> DataFrame:
    """Suite per shift of a scored `simulated_shift` frame."""
    return metric_suite(scored, label, score, 0.5, ["shift"], digits).select(
        F.round(F.col("shift") * 100).cast("int").alias("shift_pct"),
        F.lit(feature).alias("feature"),
        "f2",
        "pr_auc",
        "brier",
        "recall",
        "precision",
    )


def drift_headline(report: DataFrame, yearly: DataFrame, simulated: DataFrame) -> DataFrame:
    """Drifted features, highest PSI, worst year, F2 lost at the largest shift: one row."""
    features = report.agg(
        F.sum("drift_flag").alias("n_drifted"),
        F.max("psi").alias("psi_max"),
        F.count_if(F.col("psi") > 0.25).alias("n_psi_high"),
    )
    worst = yearly.agg(
        F.min_by("sprint_year", F.struct("f2", "sprint_year")).alias("year"), F.min("f2").alias("f2")
    )
    drop = simulated.agg(
        F.max(F.when(F.col("shift_pct") == 0, F.col("f2"))) - F.max(F.when(F.col("shift_pct") == 50, F.col("f2")))
    ).scalar()
    return with_row(features, "w", worst).select(
        "n_drifted",
        "psi_max",
        "n_psi_high",
        F.col("w.year").alias("worst_year"),
        F.col("w.f2").alias("worst_year_f2"),
        drop.alias("f2_drop_50pct"),
    )


# -- exact p-value ------------------------------------------------------------------


def lattice_tail(distance: float, a: int, b: int) -> float:
    """P(two-sample distance >= this one) under equal distributions, by counting lattice paths.

    u is the share of all paths to a point of the diagonal i + j = s that never were `distance`
    apart; a path comes to (i, j) from the left with chance i / s. Only points inside are kept."""
    m, n = (a, b) if a < b else (b, a)
    g = math.gcd(m, n)
    h = round(distance * (m // g) * n)
    if h <= 0:
        return 1.0
    u, low = np.ones(1), 0
    for s in range(1, m + n + 1):
        lo = max(0, s - n, (s * m - h * g) // (m + n) + 1)
        hi = min(m, s, -(-(s * m + h * g) // (m + n)) - 1)
        if lo > hi:
            return 1.0
        padded = np.zeros(hi - lo + 2)  # u at i = lo - 1 .. hi of the diagonal before
        first, last = max(low, lo - 1), min(low + len(u) - 1, hi)
        if first <= last:
            padded[first - lo + 1 : last - lo + 2] = u[first - low : last - low + 1]
        i = np.arange(lo, hi + 1)
        u, low = padded[:-1] * (i / s) + padded[1:] * ((s - i) / s), lo
    return float(min(1.0, max(0.0, 1.0 - u[0])))


def two_sample_tail(distance: Column, a: Column, b: Column) -> Column:
    """Exact while no sample has more than EXACT_ROWS rows, the limit series beyond. One row per
    feature and cohort comes here."""

    @F.pandas_udf("double")
    def tail(d: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([lattice_tail(*row) for row in zip(d, x.astype(int), y.astype(int))], dtype=float)

    small = F.greatest(a, b) <= EXACT_ROWS
    asked = [F.when(small, c).otherwise(other) for c, other in ((distance, 0.0), (a, 1.0), (b, 1.0))]
    return F.when(small, tail(*asked)).otherwise(N.kolmogorov_tail(distance, a, b))


# -- rules ------------------------------------------------------------------------

# Guard name, metric, direction in which it fires, limit.
GUARDS = (
    ("flagging_rate", "flagging_rate_test", "above", 0.85),
    ("calibration", "brier", "above", 0.10),
    ("fold_spread", "lopo_f2_std", "above", 0.05),
    ("retrain_level", "f2", "below", 0.90),
    ("retrain_drop", "f2_drop", "at_least", 0.03),
)


def monitoring_guards(metrics_long: DataFrame) -> DataFrame:
    """(key, value) metrics against the rule table; a rule without its metric is not listed."""
    rules = F.array(
        *[
            F.struct(F.lit(g).alias("guard"), F.lit(m).alias("key"), F.lit(d).alias("fires"), F.lit(v).alias("limit"))
            for g, m, d, v in GUARDS
        ]
    )
    value, limit = F.col("value"), F.col("rule.limit")
    fired = (
        F.when(F.col("rule.fires") == "above", value > limit)
        .when(F.col("rule.fires") == "below", value < limit)
        .otherwise(value >= limit)
    )
    return (
        metrics_long.select("key", "value", F.explode(rules).alias("rule"))
        .where(F.col("key") == F.col("rule.key"))
        .select(F.col("rule.guard").alias("guard"), "key", "value", F.col("rule.limit").alias("limit"), fired.alias("fired"))
    )


def health_lights(f2, psi_max, brier) -> list:
    """Three light columns: green / amber / red."""
    return [
        F.when(f2 > 0.90, "green").when(f2 > 0.85, "amber").otherwise("red").alias("performance_light"),
        F.when(psi_max < 0.25, "green").when(psi_max < 0.40, "amber").otherwise("red").alias("drift_light"),
        F.when(brier < 0.10, "green").otherwise("amber").alias("calibration_light"),
    ]


def psi_light(psi):
    return F.when(psi > 0.25, "red").when(psi > 0.10, "amber").otherwise("green")
