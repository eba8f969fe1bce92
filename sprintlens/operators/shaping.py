"""Schema shaping: names, casts, probing, null-share drops, one-pass counters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalise_names(df: DataFrame) -> DataFrame:
    """Trim and lower every column name; two names that become equal are an error."""
    names = [c.strip().lower() for c in df.columns]
    twice = {n for n in names if names.count(n) > 1}
    if twice:
        raise ValueError(f"columns differ only in case or blanks: {sorted(twice)}")
    return df.toDF(*names)


def cast_present(df: DataFrame, names: Iterable[str], kind: str = "double") -> DataFrame:
    """Cast the listed columns that exist, in one projection; bad text becomes null."""
    wanted = set(names)
    return df.select(
        *[F.col(c).try_cast(kind).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def first_present(df: DataFrame, candidates: Sequence[str], default: str | None = None) -> str:
    for name in candidates:
        if name in df.columns:
            return name
    if default is None:
        raise ValueError(f"none of {list(candidates)} in {df.columns}")
    return default


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def drop_sparse(df: DataFrame, limit: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns whose null share exceeds the limit (one aggregation over the data)."""
    probe = [c for c in df.columns if c not in keep]
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in probe]).first()
    return df.drop(*[c for c in probe if shares[c] is not None and shares[c] > limit])


def null_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Long table (column, rows, nulls, null_share)."""
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return wide.unpivot("rows", columns, "column", "nulls").select(
        "column", "rows", "nulls", (F.col("nulls") / F.col("rows")).alias("null_share")
    )


def counted_filter(df: DataFrame, condition: Column, observation) -> DataFrame:
    """Filter that records rows before and after in the same pass (`Observation`)."""
    kept = F.coalesce(condition, F.lit(False))
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
    ).where(kept)


def with_row(df: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """Adds the single row of another frame as a struct column (a scalar subquery, run once)."""
    return df.withColumn(name, one_row.select(F.struct("*")).scalar())


def keep_known(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in order if c in df.columns])
