"""Removal of cross-site boilerplate lines by distinct-site spread, in DataFrame functions only.

Lines (trimmed of blanks) are hashed to 128 bits. Per line hash one HyperLogLog sketch of the
sites it occurs on is merged by aggregation. Lines whose estimate is clear of the threshold
are decided by it; lines near the threshold get an exact distinct count of sites. A line of
WORDS words or more on WORDY_SITES sites or more, or a shorter one on `min_sites`, is
boilerplate (short lines occur on several sites by chance): it stays in the first document that has it (smallest
id) and goes from all others, so a text that was copied widely survives once.

Sketches are merged before the shuffle, so a line that a third of the documents carry sends a
row per task. Only positions of lines to be cut are gathered per document; a document's text
is joined with them once.

Defined cases: null text stays null and has no lines; empty lines are kept; a null site counts
for nothing; repeated rows are treated alike; an empty table gives no rows; other columns are
passed through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sprintlens.llm.common import tucked, written

MIN_SITES = 10
WORDS, WORDY_SITES = 5, 5
LG_K = 12
BLANKS = " \t\r"


def _lines(docs: DataFrame, site: str, min_sites: int) -> DataFrame:
    """One row per non-empty line: document key, site, position, hashes, sites that it may not reach."""
    exploded = docs.select(
        F.col("doc_id").alias("_id"),
        F.xxhash64("text").alias("_text_hash"),
        F.col(site).alias("_site"),
        F.posexplode(F.split("text", "\n")).alias("_pos", "_raw"),
    )
    line = F.btrim("_raw", F.lit(BLANKS))
    wordy = F.size(F.split(line, " ")) >= WORDS
    least = F.when(wordy, min(min_sites, WORDY_SITES)).otherwise(min_sites)
    return exploded.filter(line != "").select(
        "_id", "_text_hash", "_site", "_pos", F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit("line"), line).alias("_h2"), least.alias("_least")
    )


def spread_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """Hashes of boilerplate lines with the first document that has each."""
    lines = _lines(docs, site, min_sites)
    keys = ["_h1", "_h2"]
    margin = F.greatest(F.lit(1.0), F.lit(3 * 1.04 / 2 ** (lg_k / 2)) * F.col("_least"))
    spread = written(
        lines.groupBy(*keys)
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(lg_k))).alias("_sites"),
            F.min(F.struct("_id", "_text_hash")).alias("_first"),
            F.max("_least").alias("_least"),
        )
        .filter(F.col("_sites") >= F.col("_least") - margin),
        "line-spread",
    )
    sure = spread.filter(F.col("_sites") > F.col("_least") + margin)
    near = spread.filter(F.col("_sites") <= F.col("_least") + margin)
    counted = (
        lines.join(near.select(*keys), keys, "left_semi")
        .select(*keys, "_site", "_least")
        .distinct()
        .groupBy(*keys)
        .agg(F.count("_site").alias("_exact"), F.max("_least").alias("_at_least"))
        .filter(F.col("_exact") >= F.col("_at_least"))
        .select(*keys)
    )
    return sure.select(*keys, "_first").unionByName(near.join(counted, keys).select(*keys, "_first"))


def dedup_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """The documents, lines cut from text, with n_lines (non-empty) and n_removed."""
    rows, restored = tucked(docs.drop("n_lines", "n_removed"), "doc_id", "text")
    rows = rows.withColumn("_site", F.col(rows.columns[docs.drop("n_lines", "n_removed").columns.index(site)]))
    cut = (
        _lines(rows, "_site", min_sites)
        .join(spread_lines(rows, "_site", min_sites, lg_k), ["_h1", "_h2"])
        .filter(~F.struct("_id", "_text_hash").eqNullSafe(F.col("_first")))
        .groupBy("_id", "_text_hash")
        .agg(F.collect_set("_pos").alias("_cut"))
        .withColumnRenamed("_text_hash", "_hash")
    )
    parts = F.split("text", "\n")
    kept = F.filter(parts, lambda line, i: ~F.array_contains(F.col("_cut"), i))
    joined = rows.withColumn("_text_hash", F.xxhash64("text")).join(
        cut, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left"
    )
    counted = joined.withColumns(
        {
            "_n_lines": F.coalesce(F.size(F.filter(parts, lambda x: F.btrim(x, F.lit(BLANKS)) != "")), F.lit(0)).cast("long"),
            "_n_removed": F.coalesce(F.size("_cut"), F.lit(0)).cast("long"),
            "text": F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
        }
    )
    return restored(counted, F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"))


def cleaned_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents with their own columns; n_chars, where there is one, counts what is left."""
    rows, restored = tucked(docs, "doc_id", "text", options.get("site", "source"))
    clean = restored(dedup_lines(rows, **options))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean
