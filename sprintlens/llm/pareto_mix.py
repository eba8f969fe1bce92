"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Each source gets a target number of words by weight; no target exceeds `cap` times what the
source has, and what a capped source cannot take is shared again by weight (water filling).
A document is wanted `target / source size` times on average (times its own relative weight,
if a weight column is given): the whole part are copies it certainly gets, the fraction is its
inclusion probability p. The fractions are drawn by Pareto order sampling: documents are ranked
by (U / (1 - U)) / (p / (1 - p)) with U hashed from seed and id, and the head of the ranking
whose words come nearest to the source's remaining target is taken. The sample's size is fixed
in words, so each source misses its target by at most half a document.

The ranking of a source is never sorted in one task: ranks are cut into `bins` classes, words
are summed per class, and only the class in which the target falls is ordered row by row.

Defined cases: null text has no words; a null source is a source of its own (last in order);
documents without words take nothing; rows with equal id and size rank together, and repeated
rows are separate documents; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sprintlens.llm.common import WORD, attach, tucked, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BINS = 4096
#: Inclusion probabilities stay this far from 0 and 1, so that odds are finite.
EDGE = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str, key: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(
    per_source: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """(source, source_size) with targets. One row per source, so its windows are small."""
    whole = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    filling = Window.orderBy("_fill", "_n")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") - 1) % len(weights) + 1)
    capped = F.col("_capped")
    return (
        per_source.withColumn("_n", F.row_number().over(by_name))
        .withColumn("_w", weight)
        .withColumn("_cap", F.lit(float(cap)) * F.col("source_size"))
        .withColumn("_total", F.lit(float(share)) * F.sum("source_size").over(whole))
        .withColumn("_fill", F.col("_cap") / F.col("_w"))
        .withColumn("_before", F.coalesce(F.sum("_cap").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_rest", F.sum("_w").over(filling.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_capped", F.col("_fill") * F.col("_rest") <= F.col("_total") - F.col("_before"))
        .withColumn("_kept", F.coalesce(F.sum(F.when(capped, F.col("_cap"))).over(whole), F.lit(0.0)))
        .withColumn("_open", F.sum(F.when(~capped, F.col("_w"))).over(whole))
        .withColumn(
            "target",
            F.when(capped, F.col("_cap")).otherwise(F.col("_w") * (F.col("_total") - F.col("_kept")) / F.col("_open")),
        )
        .select("source", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    weight: str | None = None,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    cap: int = CAP,
    bins: int = BINS,
    seed: str = "mix",
) -> DataFrame:
    """doc_id, size, source_size, target and copies (0 to cap) of every document.

    weight: a numeric column by which documents of a source are preferred (null: 1).
    """
    own = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    sized = written(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), own.alias("_own")), "mix-sizes"
    )
    per_source = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("_own") * F.col("size")).alias("_weighed")
    )
    targets = source_targets(per_source.select("source", "source_size"), weights, share, cap)
    rate = written(
        attach(per_source.drop("source_size"), targets, "source", F.lit(0), 1).withColumn(
            "_rate", F.when(F.col("_weighed") > 0, F.col("target") / F.col("_weighed")).otherwise(0.0)
        ),
        "mix-targets",
    )
    wanted = F.col("_rate") * F.col("_own")
    chance = F.least(F.greatest(wanted - F.col("_base"), F.lit(EDGE)), F.lit(1 - EDGE))
    u = uniform(seed, F.col("doc_id"))
    odds = (u / (1 - u)) / (F.col("_p") / (1 - F.col("_p")))
    ranked = written(
        attach(sized, rate, "source", F.col("doc_id"))
        .withColumn("_base", F.least(F.floor(wanted), F.lit(cap)).cast("long"))
        .withColumn("_p", chance)
        .withColumn("_odds", odds)
        .withColumn("_rank", F.when(F.col("_base") < cap, F.col("_odds") / (1 + F.col("_odds"))))
        .withColumn("_bin", F.least(F.floor(F.col("_rank") * bins), F.lit(bins - 1)))
        .select("doc_id", "source", "size", "source_size", "target", "_base", "_rank", "_bin"),
        "mix-ranks",
    )
    in_order = Window.partitionBy("source").orderBy("_bin")
    classes = ranked.groupBy("source", "_bin").agg(
        F.sum(F.when(F.col("_bin").isNotNull(), F.col("size")).otherwise(0)).alias("_words"),
        F.sum(F.col("_base") * F.col("size")).alias("_certain"),
        F.first("target").alias("_target"),
    )
    cut = (
        classes.withColumn("_upto", F.sum("_words").over(in_order))
        .withColumn("_left", F.col("_target") - F.sum("_certain").over(Window.partitionBy("source")))
        .groupBy("source")
        .agg(
            F.min(F.when(F.col("_upto") > F.col("_left"), F.struct("_bin", (F.col("_upto") - F.col("_words")).alias("_before")))).alias("_cut"),
            F.first("_left").alias("_left"),
        )
        .select("source", F.coalesce("_cut._bin", F.lit(bins)).alias("_cut_bin"), F.coalesce("_cut._before", F.lit(0)).alias("_before"), "_left")
    )
    placed = attach(ranked, cut, "source", F.col("doc_id"))
    order = Window.partitionBy("source").orderBy("_rank", "doc_id", "size")
    at_cut = (
        placed.filter(F.col("_bin") == F.col("_cut_bin"))
        .withColumn("_ahead", F.col("_before") + F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_extra", (2 * F.col("_ahead") + F.col("size") <= 2 * F.col("_left")).cast("long"))
    )
    others = placed.filter(F.col("_bin").isNull() | (F.col("_bin") != F.col("_cut_bin"))).withColumn(
        "_extra", F.coalesce(F.col("_bin") < F.col("_cut_bin"), F.lit(False)).cast("long")
    )
    columns = ["doc_id", "size", "source_size", "target", (F.col("_base") + F.col("_extra")).alias("copies")]
    return at_cut.select(*columns).unionByName(others.select(*columns))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken. Rows are told apart by id and number
    of words; of rows equal in both, each is taken as often as the one taken most."""
    rows, restored = tucked(docs, "doc_id", "text", "source")
    rows = rows.withColumn("_size", word_count(F.col("text")))
    taken = mix(rows.select("doc_id", "text", "source"), **options).filter(F.col("copies") > 0)
    copies = taken.groupBy(F.col("doc_id").alias("_id"), F.col("size").alias("_words")).agg(F.max("copies").alias("_copies"))
    joined = rows.join(copies, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_size") == F.col("_words")))
    return restored(joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))))
