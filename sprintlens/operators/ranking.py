"""Running totals and exact percentiles over an ordered axis, without one big window.

AUC, average precision, Kolmogorov-Smirnov and percentiles all need running sums by
value. A window ordered over a whole group would put that group on one task. Here rows
are first collapsed to distinct values, then cut into chunks at splitter values, summed
inside each chunk, and shifted by the total of the chunks before. Splitters are the rows
with the lowest hash in each of `spark.sql.shuffle.partitions` hash slots, taken from a
hash-thinned part of the rows, so they follow the data (a hot group is cut into many
chunks), their number is bounded, and a recomputed task sees the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


# One row in THINNING may become a splitter: chunks below about this size are not worth cutting.
THINNING = 1024


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the right copies of the keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])


def collapse(df: DataFrame, value: str, by: Sequence[str] = (), **sums: Column) -> DataFrame:
    """One row per distinct value (and group) with summed columns; partial sums run map-side."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    )


def _splitters(counts: DataFrame, key: Column, slots: int) -> Column:
    hashed = counts.select(key.alias("k")).withColumn("h", F.xxhash64("k"))
    thinned = hashed.where(F.pmod("h", F.lit(THINNING)) == 0)
    lowest = thinned.groupBy(F.pmod(F.shiftright("h", 10), F.lit(slots)).alias("slot")).agg(
        F.min(F.struct("h", "k")).alias("pick")
    )
    return lowest.agg(F.sort_array(F.collect_list("pick.k")).alias("ks")).scalar()


def _chunk_of(key: Column, splitters: Column, slots: int) -> Column:
    """Number of splitters <= key, by binary search in the sorted array."""
    steps = [2**i for i in range(slots.bit_length() - 1, -1, -1)]

    def advance(found: Column, step: Column) -> Column:
        probe = F.get(splitters, found + step - 1)
        return F.when(probe <= key, found + step).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def running_totals(
    counts: DataFrame, value: str, sums: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Adds `<s>_upto` (sum over values <= this one) and `<s>_total` (whole group).

    `counts` must be collapsed: one row per group and value, no null values.
    """
    by = list(by)
    slots = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*by, value)
    chunked = counts.withColumn("__splitters", _splitters(counts, key, slots)).withColumn(
        "__chunk", _chunk_of(key, F.col("__splitters"), slots)
    ).drop("__splitters")

    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*by, "__chunk")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .select(
            *by,
            "__chunk",
            *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"__{s}_before") for s in sums],
            *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
        )
    )
    inside = (
        Window.partitionBy(*by, "__chunk")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = chunked.withColumns({f"{s}_upto": F.sum(s).over(inside) for s in sums})
    return (
        join_null_safe(local, offsets, [*by, "__chunk"])
        .withColumns({f"{s}_upto": F.col(f"{s}_upto") + F.col(f"__{s}_before") for s in sums})
        .drop("__chunk", *[f"__{s}_before" for s in sums])
    )


def percentiles_from_totals(
    totals: DataFrame, value: str, count: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolation percentiles from `running_totals` output, as an array column."""
    upto, total = F.col(f"{count}_upto"), F.col(f"{count}_total")
    aggregates = []
    for i, q in enumerate(probs):
        position = (total - 1) * F.lit(float(q))
        for name, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (upto - F.col(count) <= rank) & (rank < upto)
            aggregates.append(F.max(F.when(here, F.col(value))).cast("double").alias(f"{name}{i}"))
    found = totals.groupBy(*by).agg(F.max(total).alias("n"), *aggregates)
    values = []
    for i, q in enumerate(probs):
        position = (F.col("n") - 1) * F.lit(float(q))
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        values.append(lo + (hi - lo) * (position - F.floor(position)))
    return found.select(*by, "n", F.array(*values).alias("percentiles"))


def exact_percentiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact percentiles per group: columns `by`, `n`, `percentiles` (array in `probs` order)."""
    counts = collapse(df, value, by, n_rows=F.lit(1))
    totals = running_totals(counts, value, ["n_rows"], by)
    return percentiles_from_totals(totals, value, "n_rows", probs, by)
