"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its
result is written as Parquet and read back before the next. All stages but the last return the
columns of `documents`; the last returns ids, byte spans and the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sprintlens.llm import line_spread, ngram_join, pareto_mix, pu_quality, sp_codec
from sprintlens.llm.common import table, written
from sprintlens.llm.queries import tokenizer_file


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return pu_quality.accepted(docs, table(spark, sf_dir, "labels"))


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sites share go from all documents but the first; n_chars follows."""
    return line_spread.cleaned_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return pareto_mix.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, byte spans and decoded text."""
    coded = sp_codec.encode_decode(docs, tokenizer_file("piece_bpe_32k.model"), keep=("doc_id", "source"))
    return coded.select("doc_id", "source", "ids", "begins", "ends", "decoded")


STAGES = [
    ("quality", keep_quality),
    ("lines", cut_boilerplate),
    ("near_copies", drop_near_copies),
    ("mix", mix_sources),
    ("tokens", tokenize),
]

#: A fitted classifier and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
