"""Token counts of whole texts through a digest cache.

The cache is a Parquet table, one folder per tokenizer version: `content` (SHA-256 of the
normalised text), `n_tokens`. A version is the SHA-256 of the tokenizer's file, its library's
version and the normalisation, so that a count is never read for another tokenizer.

Normalisation may only join texts with equal counts. Where the tokenizer's file says that it
lower-cases and splits at blanks (`token_store.odd_texts`), A-Z become lower case and runs of
ASCII blanks one blank, except in texts that may hold an added token's string or a combining
mark; in all other cases the text stays as it is.

1. Digests that the cache lacks (`misses`); few of them are broadcast (checked by count), so that
   only their texts move, and where there are more, texts are joined by digest.
2. One text per missing digest: partial sums in each task keep one text of a digest, so copies,
   a third of all rows included, never meet in one task.
3. These texts are encoded in tasks and their counts appended to the cache.
4. Documents are joined to the cache by digest.

A run that is lost before step 3 commits appends nothing; two runs at the same time may append
a digest twice, with the same count, and readers take one.

Defined cases: null text is empty (0 bytes, 0 tokens); rows with repeated or null doc_id keep a
row each; an empty table gives no rows and leaves the cache as it is; very long texts are
encoded whole; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sprintlens.llm.common import written
from sprintlens.llm.token_store import encode_texts, odd_texts
from sprintlens.llm.word_pieces import pieces_of

CACHE = "content binary, n_tokens long"
#: Misses up to this many (32 bytes each) are broadcast.
FEW_MISSES = 250_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = r"[ \t\n\r\f\x0B]+"


def tokenizer_version(tokenizer_path: str) -> str:
    """Hex digest of everything that decides a count."""
    import sentencepiece
    import tokenizers

    library = sentencepiece if tokenizer_path.endswith(".model") else tokenizers
    version = f"{library.__name__} {library.__version__} {_pattern(tokenizer_path)}"
    with open(tokenizer_path, "rb") as file:
        return hashlib.sha256(file.read() + version.encode()).hexdigest()


def _pattern(tokenizer_path: str) -> str | None:
    return None if tokenizer_path.endswith(".model") else odd_texts(tokenizer_path)


def normalised(text: Column, tokenizer_path: str) -> Column:
    """The text, or one with the same number of tokens."""
    text, odd = F.coalesce(text.cast("string"), F.lit("")), _pattern(tokenizer_path)
    if odd is None:
        return text
    return F.when(text.rlike(odd), text).otherwise(F.regexp_replace(F.translate(text, UPPER, LOWER), BLANKS, " "))


@functools.lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def counts_of(texts: pa.Array, tokenizer_path: str) -> np.ndarray:
    """Numbers of tokens by the library, without begin, end or added special tokens."""
    if not tokenizer_path.endswith(".model"):
        return encode_texts(tokenizer_path, texts, None)[1]
    ids = _pieces(tokenizer_path).encode(pc.fill_null(texts, "").to_pylist(), num_threads=1)
    return np.fromiter(map(len, ids), np.int64, len(ids))


def read_cache(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """content, n_tokens of one tokenizer version; no rows where nothing was stored yet."""
    try:
        return spark.read.schema(CACHE).parquet(f"{cache_path}/tokenizer={version}")
    except AnalysisException:  # no such folder
        return spark.createDataFrame([], CACHE)


def _keyed(docs: DataFrame, tokenizer_path: str, *columns: Column) -> DataFrame:
    text = normalised(F.col("text"), tokenizer_path)
    return docs.select(*columns, text.alias("_text")).withColumn("content", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)))


def count_misses(docs: DataFrame, cache_path: str, tokenizer_path: str, few: int = FEW_MISSES) -> DataFrame:
    """content, n_tokens of the distinct texts that the cache lacks, each encoded once."""
    spark = docs.sparkSession
    known = read_cache(spark, cache_path, tokenizer_version(tokenizer_path))
    texts = _keyed(docs, tokenizer_path)
    if not known.isEmpty():
        misses = written(texts.select("content").distinct().join(known.select("content"), "content", "left_anti"), "misses")
        if misses.count() <= few:
            misses = F.broadcast(misses)
        texts = texts.join(misses, "content", "left_semi")
    texts = texts.groupBy("content").agg(F.first("_text").alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces_of(batch, 8 << 20, column=1):
                counts = pa.array(counts_of(part.column(1), tokenizer_path), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), counts], ["content", "n_tokens"])

    return texts.mapInArrow(encode, CACHE)


def count_tokens(
    docs: DataFrame, cache_path: str, tokenizer_path: str, limit: int = 2048, few: int = FEW_MISSES
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; the cache holds all their counts afterwards."""
    spark, version = docs.sparkSession, tokenizer_version(tokenizer_path)
    count_misses(docs, cache_path, tokenizer_path, few).write.mode("append").parquet(f"{cache_path}/tokenizer={version}")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = _keyed(docs, tokenizer_path, F.col("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"))
    counts = read_cache(spark, cache_path, version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    return rows.drop("_text").join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
