"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sprintlens.session import scratch_dir

#: Words of the contracts: runs of anything but space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Shuffle files of a query go when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession):
    """What runs inside leaves no shuffle files behind: operators of many rounds would else pile
    up those of all rounds on the executors' disks."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back: later stages start from
    files, so a lost executor never makes them run what came before."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with shuffles_released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def memory_returned() -> None:
    """Free pages go back to the system: a worker that is used again would else keep the most that
    any of its tasks took, next to what the executor itself has grown to."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The function over batches, with its memory returned when it has ended."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            memory_returned()

    return task


def tucked(docs: DataFrame, *needed: str):
    """The frame with all other columns renamed by position, so that none of them meets a name
    that an operator uses, and the function that gives them their names back."""
    names = [c if c in needed else f"_c{i}" for i, c in enumerate(docs.columns)]
    own = docs.columns
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(own, names)])
    return renamed, lambda df, *more: df.select(*[F.col(n).alias(c) for c, n in zip(own, names)], *more)


def attach(rows: DataFrame, per_key: DataFrame, key: str, salt_by: Column, salts: int = 32) -> DataFrame:
    """Rows with the columns of their key's single row (inner, nulls match nulls).

    A key may hold a third of all rows: the small side is repeated once per salt and rows
    are dealt by (key, salt), so a hot key is spread over `salts` partitions.
    """
    small = per_key.withColumnRenamed(key, "_key").withColumn(
        "_salt_key", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    return salted.join(
        small, (F.col("_salt") == F.col("_salt_key")) & F.col(key).eqNullSafe(F.col("_key"))
    ).drop("_salt", "_salt_key", "_key")


def in_fold(doc_id: Column) -> Column:
    """Whether a document's labels may be learned from: crc32 of its id as text, mod 3, is not 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))
