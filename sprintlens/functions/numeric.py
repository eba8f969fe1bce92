"""Ratios, rounding, tail probabilities and hash-derived uniforms."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from sprintlens import params as P


def ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """numerator / denominator as double, null where the denominator is 0 or null."""
    value = F.try_divide(numerator.cast("double"), F.nullif(denominator.cast("double"), F.lit(0.0)))
    return value if digits is None else F.round(value, digits)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def at_least(value: Column, floor: float) -> Column:
    """Clip from below, null stays null (greatest() would hide it)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def f_beta(tp: Column, fp: Column, fn: Column, beta: float = P.BETA) -> Column:
    b2 = beta * beta
    return ratio_or_zero((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def chi2_one_df_tail(x: Column) -> Column:
    """P(chi-squared with 1 df > x) = erfc(sqrt(x/2)).

    Spark has no erfc. Below z = 3 the Maclaurin series of erf, above it the continued
    fraction of erfc; both converge to about 1e-14 with the numbers of terms used.
    """
    z = F.sqrt(x / 2.0)
    term = F.aggregate(
        F.sequence(F.lit(1), F.lit(80)),
        F.struct(z.alias("t"), z.alias("s")),
        lambda acc, n: F.struct(
            (-acc["t"] * z * z / n.cast("double")).alias("t"),
            (acc["s"] - acc["t"] * z * z / n.cast("double") / (2.0 * n + 1.0)).alias("s"),
        ),
    )
    series = 1.0 - 2.0 / math.sqrt(math.pi) * term["s"]
    fraction = F.aggregate(
        F.sequence(F.lit(60), F.lit(1), F.lit(-1)),
        z,
        lambda acc, n: z + n.cast("double") / 2.0 / acc,
    )
    tail = F.exp(-z * z) / math.sqrt(math.pi) / fraction
    return F.when(x <= 0, 1.0).when(z < 3, series).otherwise(tail)


def kolmogorov_tail(distance: Column, n_a: Column, n_b: Column) -> Column:
    """Asymptotic two-sample p-value 2 * sum (-1)^(k-1) exp(-2 k^2 lambda^2)."""
    lam2 = distance * distance * ratio(n_a * n_b, n_a + n_b)
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam2),
    )
    return F.when(lam2 < 0.02, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def hash_uniform(text: Column) -> Column:
    """Uniform in [0, 1) from the first 32 bits of md5: the same on every run and partitioning."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(2**32)


def poisson_one(u: Column, largest: int = 12) -> Column:
    """Poisson(1) draw by inverse distribution function (P(X > 12) < 2^-32)."""
    rule, cumulative = None, 0.0
    for k in range(largest):
        cumulative += math.exp(-1.0) / math.factorial(k)
        rule = F.when(u < cumulative, k) if rule is None else rule.when(u < cumulative, k)
    return rule.otherwise(largest)
