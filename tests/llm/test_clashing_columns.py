"""Callers' columns whose names the operators use inside come back untouched, and change nothing."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sprintlens.llm import line_spread, ngram_join, pareto_mix
from sprintlens.llm.common import tucked

NAMES = ("_id", "_cut", "_hash", "_text_hash", "_row", "_copies", "_copy", "_site", "_c0", "_c1", "n_lines", "_key", "_own", "_least", "_n", "_group")


@pytest.fixture(scope="module")
def docs(spark):
    line = "this boilerplate line has six words"
    texts = [None, "", "a b c d e f g", "a b c d e f g", line, line + "\nown words of this document " * 3, "x " * 40_000]
    rows = [(i if i != 6 else None, t, "en", f"s{i % 6}", len(t or "")) for i, t in enumerate(texts * 3)]
    rows += [rows[9], rows[9], (5, "another text under a known id", "en", "s1", 29)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2)


def widened(docs):
    for i, name in enumerate(NAMES):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    return docs


OPERATORS = {
    "lines": line_spread.cleaned_documents,
    "near copies": ngram_join.one_of_each,
    "mix": pareto_mix.mixed_documents,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_come_back(docs, name):
    run = OPERATORS[name]
    wide = run(widened(docs))
    assert wide.columns == [*docs.columns, *NAMES]
    rows = [r.asDict() for r in wide.collect()]
    for r in rows:
        assert [r[n] for n in NAMES] == [f"{i}-{'none' if r['doc_id'] is None else r['doc_id']}" for i in range(len(NAMES))]
    key = lambda r: tuple((v is None, str(v)) for v in (r["doc_id"], r["text"], r["source"]))
    assert sorted(map(key, rows)) == sorted(key(r.asDict()) for r in run(docs).collect())


def test_lines_counts_replace_columns_of_their_name(docs):
    out = line_spread.dedup_lines(widened(docs))
    assert out.columns == [*docs.columns, *[n for n in NAMES if n != "n_lines"], "n_lines", "n_removed"]
    assert out.filter("n_lines IS NULL OR n_removed IS NULL").count() == 0


def test_wordy_lines_go_from_five_sites_short_ones_from_ten(spark):
    short, wordy = "all rights reserved", "released under the terms of it"
    for sites in (4, 5, 9, 10):
        rows = [(i, f"{short}\n{wordy}\nkeep {i}", f"s{i}") for i in range(sites)]
        out = line_spread.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
        gone = {r.doc_id: r.n_removed for r in out}
        assert gone == {i: 0 if i == 0 else (sites >= 5) + (sites >= 10) for i in range(sites)}


def test_repeated_ids_of_different_texts_are_mixed_apart(spark):
    rows = [(7, "w " * n, "a") for n in range(1, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = pareto_mix.mixed_documents(df).groupBy("text").count().collect()
    assert len({r["count"] for r in taken}) > 1 or len(taken) < len(rows)


def test_tucked_gives_names_back(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, text int, `C d` int")
    renamed, restored = tucked(df, "text")
    assert renamed.columns == ["_c0", "text", "_c2"] and restored(renamed).columns == df.columns


def test_pipeline_stages_take_nulls_empty_tables_and_extra_columns(spark, docs):
    folder = "/root/testdata/sf0.001"
    for frame in (widened(docs), widened(docs).limit(0)):
        columns = frame.columns
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, folder)
            assert name == corpus_pipeline.STAGES[-1][0] or frame.columns == columns
            frame = spark.createDataFrame(frame.collect(), frame.schema)
