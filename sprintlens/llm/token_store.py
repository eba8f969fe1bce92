"""Token ids in ORC files, written in document order and read back by stripe.

Texts are range-partitioned and sorted by doc_id, encoded inside tasks, and written as ORC with
integer run-length encoded id lists, row indexes and Bloom filters on doc_id. File part-n holds
the n-th range, so files in name order are documents in order. Readers split files by stripe
and skip stripes and row groups whose statistics or Bloom filter rule a doc_id out.

A chunk between ASCII blanks is encoded apart from its neighbours: the tokenizer's normalizer
works by character, lower-cases A-Z like any reader would, and no match of its split pattern
contains a blank or goes from a letter to a mark. So texts are cut there, each distinct chunk of
a worker is encoded once by the library, and ids are put together with array operations. Texts
that may contain an added token's string or a combining mark go to the library whole, and so do
all texts of a tokenizer whose file does not state these properties (`odd_texts`).

Each row stores `seq` = file number * 2^33 + row number, given in ascending doc_id order.
Document starts need no global sort: rows are summed per file, the file totals (one row per
file) are added up, and a window runs inside each file.

Defined cases: null text is empty and gets the end id only; rows with equal doc_id are ordered
by text (null first) and keep an entry each; null doc_id comes first; an empty table gives no
rows; other columns are not read. A very long text is one list; it is never cut.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sprintlens.llm.word_pieces import ChunkEncoder, interleave, lists, pieces_of

END_ID = 2
STRIPE_BYTES = 64 << 20
INDEX_STRIDE = 10_000


#: Lower-case Latin letters; the split pattern ends a match between one of them and a mark.
LETTERS = "a-zß-öø-ÿ"
LATIN_WORD = re.compile(f"[{LETTERS}]+")
BEFORE_MARK = f"([{LETTERS}])([.,!?;:*#$%&|])"
#: What a tokenizer's file must say for texts to be cut at blanks.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@functools.lru_cache(maxsize=2)
def odd_texts(tokenizer_path: str) -> str | None:
    """Pattern of the texts that must go to the library whole: those that may hold an added
    token's string, or a combining mark (composed before letters are lower-cased). None where
    the tokenizer's file doesn't state the properties that cutting at blanks relies on."""
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = json.load(file)
    normal = (spec.get("normalizer") or {}).get("normalizers", [])
    before = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    starts = {t["content"][:2] for t in spec.get("added_tokens") or []}
    if (
        [n["type"] for n in normal] != NORMALIZERS
        or (normal[1]["pattern"], normal[1]["content"]) != ({"Regex": r"\s+"}, " ")
        or [b.get("type") for b in before] != ["Split", "ByteLevel"]
        or (before[0]["pattern"], before[0]["behavior"], before[0]["invert"]) != ({"Regex": SPLIT}, "Removed", True)
        or before[1]["add_prefix_space"]
        or before[1]["use_regex"]
        or spec["model"]["type"] != "BPE"
        or any(len(x) < 2 or any(c.isalnum() or c.isspace() for c in x) for x in starts)
    ):
        return None
    return "|".join([*map(re.escape, sorted(starts)), r"\p{M}"])


def byte_letters() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable Latin-1 as it is, the rest from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {b: 256 + n for n, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def library_encoder(tokenizer_path: str):
    """(chunk encoder, whole-text encoder); one per Python worker, so that its tasks share it."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    letters = byte_letters()
    whole = lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    merge = tokenizer.model.tokenize

    def encode(chunks: list[str]) -> list[list[int]]:
        word = LATIN_WORD.fullmatch
        ids = [
            [t.id for t in merge(c if c.isascii() else c.encode().decode("latin-1").translate(letters))] if word(c) else None
            for c in chunks
        ]
        others = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(others, whole([chunks[i] for i in others])):
            ids[i] = x
        return ids

    return ChunkEncoder(encode), whole


def encode_texts(tokenizer_path: str, texts: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """ids of all texts one after another and their numbers, the end id included."""
    by_chunk, whole = library_encoder(tokenizer_path)
    texts, pattern = pc.fill_null(texts, ""), odd_texts(tokenizer_path)
    special = np.ones(len(texts), bool) if pattern is None else np.asarray(pc.match_substring_regex(texts, pattern))
    plain = pc.replace_substring_regex(pc.ascii_lower(texts.filter(pa.array(~special))), BEFORE_MARK, r"\1 \2")
    ids, counts = by_chunk(pc.ascii_split_whitespace(plain))
    if special.any():
        ids, counts = interleave(special, (ids, counts), whole(texts.filter(pa.array(special)).to_pylist()))
    if end_id is not None:
        ids = np.insert(ids, np.cumsum(counts), end_id)
        counts = counts + 1
    return ids, counts


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """One ORC row per document: doc_id, seq, ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, 8 << 20, column=1):
                ids, counts = encode_texts(tokenizer_path, part.column(1), end_id)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), lists(ids, counts)], ["doc_id", "seq", "ids"])

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select("doc_id", F.col("text").cast("string"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("seq", F.monotonically_increasing_id())
        .mapInArrow(encode, "doc_id long, seq long, ids array<int>")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", INDEX_STRIDE)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("compression", "zstd")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, seq long, ids array<int>").orc(path)


def document_table(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, from the files."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            bounds = np.asarray(column.offsets)
            words = np.asarray(column.values).astype("<u4", copy=False)
            crc = [zlib.crc32(words[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(bounds).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "seq", "n_tokens", "ids_crc32"],
            )

    rows = read_tokens(spark, path).mapInArrow(digest, "doc_id long, seq long, n_tokens long, ids_crc32 long")
    rows = rows.withColumn("_file", F.shiftright("seq", 33))
    inside = Window.partitionBy("_file").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("_upto", F.sum("n_tokens").over(inside))
    totals = rows.groupBy("_file").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # one row per file of the store: as many as spark.sql.shuffle.partitions, never more
    return placed.join(F.broadcast(bases), "_file").select(
        "doc_id", (F.col("_base") + F.col("_upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32"
    )
