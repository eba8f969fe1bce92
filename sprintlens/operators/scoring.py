"""Closed-form score, baselines, and batch scoring of fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sprintlens import params as P
from sprintlens.functions import numeric as N
from sprintlens.operators.metrics import metric_suite
from sprintlens.operators.ranking import exact_percentiles


def score_terms() -> dict[str, Column]:
    """Additive logit contributions of the closed-form score over feature-frame columns."""
    bugs, stories, tasks = (F.col(f"num_{k}_sprint") for k in ("bugs", "stories", "tasks"))
    positive = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0))
    size = F.greatest(bugs + stories + tasks, F.lit(1))
    per_story = bugs / F.greatest(stories + tasks, F.lit(1))
    return {
        "log_avg_cycle_time": P.SCORE_CYCLE * (F.col("log_avg_cycle_time") - P.SCORE_CYCLE_CENTRE),
        "bugs_per_issue": P.SCORE_RATIO * (per_story - P.SCORE_RATIO_CENTRE),
        "log_total_issues": P.SCORE_SIZE * (F.log1p(size) - P.SCORE_SIZE_CENTRE),
        "cycle_missing": P.SCORE_MISSING * F.col("cycle_missing"),
        "change_failure_rate": P.SCORE_DELIVERY
        * (
            P.SCORE_CFR * positive("change_failure_rate")
            + P.SCORE_DEPLOY * F.log1p(positive("deploy_frequency_weekly"))
        ),
    }


def closed_form_score(df: DataFrame, intercept: float = P.SCORE_INTERCEPT, digits: int | None = None) -> DataFrame:
    """Adds `p`, the score used where no fitted model is at hand."""
    logit = sum(score_terms().values(), F.lit(float(intercept)))
    p = N.sigmoid(logit)
    return df.withColumn("p", p if digits is None else F.round(p, digits))


def contributions(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Long form (keep.., feature, contribution) of the closed-form score."""
    terms = score_terms()
    return df.select(*keep, *[c.cast("double").alias(f) for f, c in terms.items()]).unpivot(
        list(keep), list(terms), "feature", "contribution"
    )


def predict(model, df: DataFrame, name: str = "p") -> DataFrame:
    """Probability of the positive class; vector columns of the model are dropped."""
    before = df.columns
    return model.transform(df).select(*before, vector_to_array(F.col("probability"))[1].alias(name))


# -- baselines ------------------------------------------------------------------


def majority_class(train: DataFrame, label: str = P.LABEL) -> DataFrame:
    """One row: majority class (ties to 0), its share, and the probability it implies for class 1."""
    share = F.avg(F.col(label).cast("double"))
    stats = train.agg(share.alias("pos"))
    positive = F.col("pos") > 0.5
    return stats.select(
        positive.cast("int").alias("majority_class"),
        F.when(positive, F.col("pos")).otherwise(1 - F.col("pos")).alias("majority_rate"),
        F.col("pos").alias("p"),
    )


def majority_baseline(train: DataFrame, df: DataFrame, label: str = P.LABEL) -> DataFrame:
    return df.withColumn("p", majority_class(train, label).select("p").scalar())


def ratio_threshold(
    train: DataFrame, label: str = P.LABEL, feature: str = "log_bug_story_ratio"
) -> DataFrame:
    """One row (threshold, f2): best of the 10..90 % percentiles in steps of 5, first wins."""
    probs = [q / 100 for q in range(10, 91, 5)]
    candidates = exact_percentiles(train, feature, probs).select("percentiles").scalar()
    x, y = F.col(feature), F.col(label)
    cells = train.where(x.isNotNull()).withColumn("c", candidates)
    # 17 candidates: three conditional counts each, in one pass over the rows
    aggregates = []
    for i in range(len(probs)):
        hit = x >= F.col("c")[i]
        aggregates += [
            F.count_if(hit & (y == 1)).alias(f"tp{i}"),
            F.count_if(hit & (y == 0)).alias(f"fp{i}"),
            F.count_if(~hit & (y == 1)).alias(f"fn{i}"),
        ]
    wide = cells.agg(F.first("c").alias("c"), *aggregates)
    options = F.array(
        *[
            F.struct(
                N.f_beta(F.col(f"tp{i}"), F.col(f"fp{i}"), F.col(f"fn{i}")).alias("f2"),
                F.lit(-i).alias("order"),
                F.col("c")[i].alias("threshold"),
            )
            for i in range(len(probs))
        ]
    )
    best = F.array_max(options)
    return wide.select(best["threshold"].alias("threshold"), best["f2"].alias("f2"))


def ratio_score(threshold: Column, feature: str = "log_bug_story_ratio") -> Column:
    """sigmoid(x - threshold), 0.5 where the feature is missing."""
    return F.coalesce(N.sigmoid(F.col(feature) - threshold), F.lit(0.5))


def run_baselines(
    matrix: DataFrame, splits: Sequence[str] = ("val", "test"), label: str = P.LABEL, digits: int | None = 4
) -> DataFrame:
    """Majority class, tuned ratio cut and the two fixed cuts, evaluated per split at .5."""
    train = matrix.where(F.col("split") == "train")
    scored = matrix.where(F.col("split").isin(*splits))
    tuned = ratio_threshold(train, label).select("threshold").scalar()
    cuts = {"ratio_auto": tuned} | {f"ratio_{k}": F.lit(v) for k, v in P.BASELINE_CUTS.items()}
    options = [
        F.struct(F.lit("majority").alias("baseline"), majority_class(train, label).select("p").scalar().alias("p"))
    ] + [F.struct(F.lit(n).alias("baseline"), ratio_score(c).alias("p")) for n, c in cuts.items()]
    stacked = scored.select("split", label, F.explode(F.array(*options)).alias("s")).select(
        "split", label, "s.baseline", "s.p"
    )
    return metric_suite(stacked, label, "p", 0.5, ["baseline", "split"], digits)
