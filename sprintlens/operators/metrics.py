"""Classifier evaluation on scored rows (label 0/1, score in [0, 1]), for any grouping.

Everything starts from one collapse to distinct scores; cells, Brier, AUC and average
precision are then sums over that smaller frame, so a grouped evaluation (per project,
per year, per bootstrap replicate) is one job instead of a loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sprintlens import params as P
from sprintlens.functions import numeric as N
from sprintlens.operators.ranking import collapse, running_totals
from sprintlens.operators.shaping import keep_known, with_row


def score_counts(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), weight: Column | None = None
) -> DataFrame:
    """by, score, pos, neg: (weighted) rows of each class per distinct score."""
    w = F.lit(1) if weight is None else weight
    y = F.col(label)
    return collapse(
        df,
        score,
        by,
        pos=F.when(y == 1, w).otherwise(0).cast("bigint"),
        neg=F.when(y == 0, w).otherwise(0).cast("bigint"),
    )


def rate_columns(digits: int | None) -> list[Column]:
    """f2, precision, recall from tp, fp, fn."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    shaped = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    return [
        shaped(N.f_beta(tp, fp, fn)).alias("f2"),
        shaped(N.ratio_or_zero(tp, tp + fp)).alias("precision"),
        shaped(N.ratio_or_zero(tp, tp + fn)).alias("recall"),
    ]


def suite_from_counts(
    counts: DataFrame,
    score: str,
    threshold: float | Column = 0.5,
    by: Sequence[str] = (),
    digits: int | None = 4,
) -> DataFrame:
    """The metric suite from collapsed score counts; AUC is null when a class is missing."""
    by = list(by)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    s, pos, neg = F.col(score), F.col("pos"), F.col("neg")
    all_pos, all_neg = F.col("pos_total"), F.col("neg_total")
    neg_below = F.col("neg_upto") - neg
    pos_at_least = all_pos - F.col("pos_upto") + pos
    neg_at_least = all_neg - neg_below
    totals = running_totals(counts, score, ["pos", "neg"], by)
    cells = totals.groupBy(*by).agg(
        F.max(t).alias("threshold"),
        F.sum(F.when(s >= t, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(s >= t, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(s < t, pos).otherwise(0)).alias("fn"),
        F.sum(F.when(s < t, neg).otherwise(0)).alias("tn"),
        F.sum(pos * (neg_below + neg / 2.0)).alias("pairs_won"),
        F.sum(N.ratio(pos * pos_at_least, pos_at_least + neg_at_least)).alias("precision_sum"),
        F.sum(pos * (1.0 - s) * (1.0 - s) + neg * s * s).alias("squares"),
    )
    p, n = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    shaped = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    return cells.select(
        *by,
        "threshold",
        *rate_columns(digits),
        shaped(N.ratio_or_zero(F.col("precision_sum"), p)).alias("pr_auc"),
        shaped(N.ratio(F.col("pairs_won"), p * n)).alias("roc_auc"),
        shaped(N.ratio(F.col("squares"), p + n)).alias("brier"),
        *[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")],
    )


def metric_suite(
    df: DataFrame,
    label: str = P.LABEL,
    score: str = "p",
    threshold: float | Column = 0.5,
    by: Sequence[str] = (),
    digits: int | None = 4,
) -> DataFrame:
    """F2, precision, recall, average precision, ROC-AUC, Brier and cells at a threshold."""
    return suite_from_counts(score_counts(df, label, score, by), score, threshold, by, digits)


def confusion(df: DataFrame, label: str = P.LABEL, score: str = "p", threshold: float = 0.5, by=()) -> DataFrame:
    """Cells only; needs no ordering, so one aggregation."""
    hit, y = F.col(score) >= threshold, F.col(label)
    return df.groupBy(*by).agg(
        F.count_if((y == 1) & hit).alias("tp"),
        F.count_if((y == 0) & hit).alias("fp"),
        F.count_if((y == 1) & ~hit).alias("fn"),
        F.count_if((y == 0) & ~hit).alias("tn"),
    )


def with_cell(df: DataFrame, label: str = P.LABEL, score: str = "p", threshold: float = 0.5) -> DataFrame:
    """Adds `cell`: tp, fp, fn or tn."""
    hit, y = F.col(score) >= threshold, F.col(label)
    return df.withColumn(
        "cell",
        F.when((y == 1) & hit, "tp").when((y == 0) & hit, "fp").when(y == 1, "fn").otherwise("tn"),
    )


def pr_curve(df: DataFrame, label: str = P.LABEL, score: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score used as threshold."""
    totals = running_totals(score_counts(df, label, score, by), score, ["pos", "neg"], by)
    tp = F.col("pos_total") - F.col("pos_upto") + F.col("pos")
    fp = F.col("neg_total") - F.col("neg_upto") + F.col("neg")
    return totals.select(
        *by,
        F.col(score).alias("threshold"),
        N.ratio_or_zero(tp, tp + fp).alias("precision"),
        N.ratio_or_zero(tp, F.col("pos_total")).alias("recall"),
    )


# -- thresholds -----------------------------------------------------------------


def _grid_cell(score: Column, first: int, last: int) -> Column:
    """How many grid points k/100 (k = first..last) are <= score, exactly as compared in doubles."""
    k = F.floor(score * 100.0)
    k = (
        k
        + F.when((k + 1) / F.lit(100.0) <= score, 1).otherwise(0)
        - F.when(k / F.lit(100.0) > score, 1).otherwise(0)
    )
    return F.least(F.greatest(k - (first - 1), F.lit(0)), F.lit(last - first + 1)).cast("int")


def threshold_sweep(
    df: DataFrame,
    label: str = P.LABEL,
    score: str = "p",
    by: Sequence[str] = (),
    cost_fp: float = P.COST_FP,
    cost_fn: float = P.COST_FN,
    first: int = P.GRID_FIRST,
    last: int = P.GRID_LAST,
    digits: int | None = 4,
) -> DataFrame:
    """Cells, rates and business value at each grid threshold.

    A row is counted once, in the cell of the highest grid point it passes; running sums
    over the (at most 92) cells give every threshold. No rows x grid product is formed.
    """
    by = list(by)
    y = F.col(label)
    cells = df.groupBy(*by, _grid_cell(F.col(score), first, last).alias("cell")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    size = last - first + 1
    axis = cells.select(*by).distinct() if by else None
    grid = cells.sparkSession.range(1, size + 1).select(F.col("id").cast("int").alias("cell"))
    if axis is None:
        every = grid
    else:
        every = axis.select(*by, F.explode(F.sequence(F.lit(1), F.lit(size))).alias("cell"))
    below = cells.where(F.col("cell") == 0)
    merged = every.unionByName(below.select(*by, "cell")).join(cells, [*by, "cell"], "left")
    group = Window.partitionBy(*by)
    above = group.orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos, neg = F.coalesce(F.col("pos"), F.lit(0)), F.coalesce(F.col("neg"), F.lit(0))
    summed = merged.select(
        *by,
        "cell",
        F.sum(pos).over(above).alias("tp"),
        F.sum(neg).over(above).alias("fp"),
        F.sum(pos).over(group).alias("all_pos"),
        F.sum(neg).over(group).alias("all_neg"),
    ).where(F.col("cell") > 0)
    full = summed.withColumns(
        {"fn": F.col("all_pos") - F.col("tp"), "tn": F.col("all_neg") - F.col("fp")}
    )
    value = F.col("tp") - cost_fp * F.col("fp") - cost_fn * F.col("fn")
    return full.select(
        *by,
        ((F.col("cell") + (first - 1)) / F.lit(100.0)).alias("threshold"),
        *rate_columns(digits),
        value.cast("bigint").alias("business_value"),
        *[F.col(c).cast("bigint").alias(c) for c in ("tp", "fp", "fn", "tn")],
    )


def best_thresholds(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F2-best and value-best threshold; equal values go to the lowest threshold."""
    lowest = -F.col("threshold")
    return sweep.groupBy(*by).agg(
        F.max_by("threshold", F.struct("f2", lowest)).alias("threshold_f2"),
        F.max("f2").alias("f2_max"),
        F.max_by("threshold", F.struct("business_value", lowest)).alias("threshold_value"),
        F.max("business_value").alias("value_max"),
    )


def threshold_report(
    df: DataFrame, choose_on: str = "val", report_on: Sequence[str] = ("val", "test"), label=P.LABEL, score="p",
    digits: int | None = 4,
) -> DataFrame:
    """Both thresholds chosen on one split only, suite of each on the reported splits."""
    sweep = threshold_sweep(df.where(F.col("split") == choose_on), label, score, digits=None)
    best = best_thresholds(sweep).select(F.struct("threshold_f2", "threshold_value").alias("b")).scalar()
    reported = df.where(F.col("split").isin(*report_on))
    parts = [
        metric_suite(
            reported.withColumn("t", best[column]), label, score, F.col("t"), ["split", "t"], digits
        ).drop("t").withColumn("rule", F.lit(rule))
        for rule, column in (("f2", "threshold_f2"), ("value", "threshold_value"))
    ]
    return parts[0].unionByName(parts[1])


# -- calibration view -------------------------------------------------------------


def _exact_mean(score: Column, digits: int | None) -> Column:
    if digits is None:
        return F.avg(score)
    unit, n = 10**digits, F.count(F.lit(1))
    units = F.sum(F.round(score * unit).cast("bigint"))
    return F.floor((2 * units + n).cast("decimal(38,0)") / (2 * n)).cast("double") / unit


def reliability_curve(
    df: DataFrame, label: str = P.LABEL, score: str = "p", bins: int = 10, by: Sequence[str] = (),
    digits: int | None = None,
) -> DataFrame:
    """Mean score and observed rate per uniform bin, bins closed on the right, empty ones absent.

    digits: scores have so many decimals; their mean is rounded half up to as many in whole
    numbers, so that neither the order of rows nor binary fractions decide a tie.
    """
    edges = [i / bins for i in range(1, bins)]
    bin_no = sum((F.when(F.col(score) > e, 1).otherwise(0) for e in edges), F.lit(0))
    return df.groupBy(*by, bin_no.alias("bin")).agg(
        _exact_mean(F.col(score), digits).alias("prob_predicha_media"),
        F.avg(F.col(label).cast("double")).alias("frecuencia_real"),
        F.count(F.lit(1)).alias("n"),
    )


# -- significance and resampling ----------------------------------------------------


def mcnemar(df: DataFrame, label: str, pred_a: str, pred_b: str, by: Sequence[str] = ()) -> DataFrame:
    """Continuity-corrected statistic and p-value; no discordant rows gives 0 and 1."""
    y, a, b = F.col(label), F.col(pred_a), F.col(pred_b)
    cells = df.groupBy(*by).agg(
        F.count_if((a == y) & (b != y)).alias("a_right_b_wrong"),
        F.count_if((a != y) & (b == y)).alias("a_wrong_b_right"),
    )
    first, second = F.col("a_right_b_wrong"), F.col("a_wrong_b_right")
    gap = F.abs(first - second) - 1
    statistic = N.ratio_or_zero(gap * gap, first + second)
    return (
        cells.withColumn("statistic", statistic)
        .withColumn(
            "p_value",
            F.when(first + second == 0, 1.0).otherwise(N.chi2_one_df_tail(F.col("statistic"))),
        )
        .withColumn("significant", F.col("p_value") < 0.05)
    )


def bootstrap_replicates(
    df: DataFrame,
    row_id: str,
    label: str = P.LABEL,
    score: str = "p",
    threshold: float = 0.5,
    replicates: int = 1000,
    digits: int | None = 4,
) -> DataFrame:
    """Metric suite of each Poisson-bootstrap replicate.

    A row enters replicate r with a Poisson(1) weight taken from md5(row_id, r): no row is
    moved, no state is kept, a lost task redraws the same weights. The exploded rows are
    summed to (replicate, score) before the shuffle. Replicate sizes vary around n, unlike
    a multinomial bootstrap; the intervals agree asymptotically.
    """
    drawn = (
        df.select(F.col(row_id).cast("string").alias("__id"), F.col(label).alias("y"), F.col(score).alias("p"))
        .withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
        .withColumn(
            "w", N.poisson_one(N.hash_uniform(F.concat("__id", F.lit("#"), F.col("replicate").cast("string"))))
        )
        .where(F.col("w") > 0)
    )
    counts = score_counts(drawn, "y", "p", ["replicate"], F.col("w"))
    return suite_from_counts(counts, "p", threshold, ["replicate"], digits)


def bootstrap_ci(replicated: DataFrame, metrics=("f2", "recall", "precision", "pr_auc", "brier")) -> DataFrame:
    """Percentiles 2.5 and 97.5 over the replicates, long form (one row per metric).

    The exact percentile buffer holds one value per replicate.
    """
    return (
        replicated.select(*metrics)
        .unpivot([], list(metrics), "metric", "value")
        .groupBy("metric")
        .agg(F.percentile("value", F.array(F.lit(0.025), F.lit(0.975))).alias("ci"))
        .select("metric", F.col("ci")[0].alias("ci_lo"), F.col("ci")[1].alias("ci_hi"))
    )


# -- reports ----------------------------------------------------------------------


def leaderboard(*parts: DataFrame) -> DataFrame:
    """Rows of several suites in one table, best F2 first."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return keep_known(union, P.LEADERBOARD_ORDER).orderBy(F.col("f2").desc(), "label")


def final_evaluation(
    df: DataFrame, threshold: float, intervals: DataFrame | None = None, label=P.LABEL, score="p",
    digits: int | None = 4, per_fold: DataFrame | None = None,
) -> DataFrame:
    """One row: val and test suites, their F2 gap, flagging rate; where given, intervals and the
    mean and spread of F2 over the folds."""
    suites = metric_suite(df.where(F.col("split").isin("val", "test")), label, score, threshold, ["split"], None)
    names = ("f2", "recall", "precision", "pr_auc", "roc_auc", "brier")
    shaped = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    pick = lambda split, m: F.max(F.when(F.col("split") == split, F.col(m)))
    flagged = lambda: F.max(
        F.when(
            F.col("split") == "test",
            N.ratio(F.col("tp") + F.col("fp"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")),
        )
    )
    record = suites.agg(
        F.lit(float(threshold)).alias("threshold"),
        *[shaped(pick(s, m)).alias(f"{s}_{m}") for s in ("val", "test") for m in names],
        shaped(pick("val", "f2") - pick("test", "f2")).alias("f2_gap"),
        shaped(flagged()).alias("flagging_rate_test"),
    ).withColumn("flagging_warning", F.col("flagging_rate_test") > 0.85)
    if intervals is not None:
        of = lambda m, side: F.max(F.when(F.col("metric") == m, F.col(f"ci_{side}")))
        bounds = intervals.agg(
            *[of(m, side).alias(f"test_{m}_ci_{side}") for m in ("f2", "recall", "brier") for side in ("lo", "hi")]
        )
        record = with_row(record, "ci", bounds).select(*record.columns, "ci.*")
    if per_fold is not None:
        spread = per_fold.agg(
            shaped(F.avg("f2")).alias("lopo_f2_mean"), shaped(F.stddev_samp("f2")).alias("lopo_f2_std")
        )
        record = with_row(record, "folds", spread).select(*record.columns, "folds.*")
    return record
