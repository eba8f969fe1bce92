"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sprintlens.llm import (
    chat_snapshots,
    cover_tree,
    divergence_audit,
    flat_graph,
    lexical_search,
    line_spread,
    ngram_join,
    pareto_mix,
    pu_quality,
    sp_codec,
    subword_langid,
    token_counts,
    token_store,
)
from sprintlens.llm.common import table
from sprintlens.session import scratch_dir


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, folder, "documents"))


def op2_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op3_flat_graph(spark: SparkSession, folder: str) -> DataFrame:
    return flat_graph.near_duplicates(table(spark, folder, "embeddings"), threshold=0.95)


def op4_token_store(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_store.write_tokens(table(spark, folder, "documents"), path, tokenizer_file("word_bpe_49k.json"))
    return token_store.document_table(spark, path)


def op5_pu_quality(spark: SparkSession, folder: str) -> DataFrame:
    return pu_quality.train_and_score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    coded = sp_codec.encode_decode(docs, tokenizer_file("piece_bpe_32k.model"), keep=("doc_id",))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.element_at("ends", -1).cast("long").alias("n_bytes"),
    )


def op7_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = pareto_mix.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_subword_langid(spark: SparkSession, folder: str) -> DataFrame:
    return subword_langid.train_and_identify(table(spark, folder, "documents"))


def op9_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return chat_snapshots.format_chats(table(spark, folder, "conversations"))


def op10_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return line_spread.dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


def op12_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return divergence_audit.audit(table(spark, folder, "documents"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The cache starts empty; one given by path would spare what it holds."""
    cache = scratch_dir(spark, "token-counts")
    return token_counts.count_tokens(table(spark, folder, "documents"), cache, tokenizer_file("word_bpe_49k.json"), limit=2048)


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_cover_tree": op2_cover_tree,
    "op3_flat_graph": op3_flat_graph,
    "op4_token_store": op4_token_store,
    "op5_pu_quality": op5_pu_quality,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_pareto_mix": op7_pareto_mix,
    "op8_subword_langid": op8_subword_langid,
    "op9_chat_snapshots": op9_chat_snapshots,
    "op10_line_spread": op10_line_spread,
    "op11_lexical_search": op11_lexical_search,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_token_counts": op13_token_counts,
}
