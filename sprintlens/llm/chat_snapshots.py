"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

Logs keep a conversation again and again as it grows. Turns get position-salted hashes, a
running XOR of which identifies every prefix of every conversation. A conversation is dropped
when its whole hash is a proper prefix of another one (anti join); of equal conversations the
smallest conv_id stays. What remains is rendered as ChatML.

The prefixes of all conversations are reduced to distinct (length, hash) rows before they are
shuffled, and equal conversations to one row before the join, so a first turn or a
conversation that a third of the logs share is one row, not a hot key.

Defined cases: rows with null conv_id belong to no conversation and are dropped; turns are
ordered by turn (null last), role, text; equal rows of a conversation count once; null text is
empty, null role is `unknown`; the markers' opening `<|` inside a text is written `< |`, so that
a text cannot open a turn; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rendered(role: Column, text: Column) -> Column:
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|im_start|>"), safe(role), F.lit("\n"), safe(text), F.lit("<|im_end|>\n"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, turn text columns, position _k and the running hashes _h1, _h2 of the first _k turns."""
    clean = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    this = F.struct(F.coalesce(F.col("turn").cast("string"), F.lit("")), "role", "text")
    return (
        clean.withColumn("_last", F.lag(this).over(order))
        .filter(F.col("_last").isNull() | (F.col("_last") != this))
        .drop("_last")
        .withColumn("_k", F.row_number().over(order))
        .withColumn("_h1", F.bit_xor(F.xxhash64("_k", "role", "text")).over(upto))
        .withColumn("_h2", F.bit_xor(F.xxhash64(F.lit("second"), "text", "role", "_k")).over(upto))
    )


def collapse(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal (conversations equal to it, itself included) of those that stay."""
    hashed = prefix_hashes(turns)
    ends = (
        hashed.groupBy("conv_id")
        .agg(F.max(F.struct("_k", "_h1", "_h2")).alias("_end"))
        .select("conv_id", "_end.*")
        .groupBy("_k", "_h1", "_h2")
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    )
    longest = Window.partitionBy("conv_id")
    inner = (
        hashed.withColumn("_n", F.max("_k").over(longest))
        .filter(F.col("_k") < F.col("_n"))
        .select("_k", "_h1", "_h2")
        .distinct()
    )
    return ends.join(inner, ["_k", "_h1", "_h2"], "left_anti").select(
        "conv_id", F.col("_k").cast("long").alias("n_turns"), "n_equal"
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_equal and the rendered text of every maximal conversation."""
    pieces = prefix_hashes(turns).select("conv_id", "_k", rendered(F.col("role"), F.col("text")).alias("_piece"))
    texts = (
        pieces.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("_k", "_piece"))).alias("_all"))
        .select("conv_id", F.array_join("_all._piece", "").alias("text"))
    )
    return collapse(turns).join(texts, "conv_id")
