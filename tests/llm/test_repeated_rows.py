"""Repeated rows and null ids among near copies."""

from sprintlens.llm import ngram_join


def test_one_row_of_each_component_stays(spark):
    near = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [
        (5, near, "s"), (5, near, "s"),  # repeated rows
        (7, near + " more", "s"),  # near copy
        (5, "quite another text of seven words", "s"),  # same id, other text
        (3, "other text under the id three here", "s"), (8, "other text under the id three here", "s"),
        (8, near.upper(), "t"),  # near copy under an id that another row has
        (None, "only null ids have this text", "s"), (None, "only null ids have this text", "s"),
        (9, None, "s"), (10, "", "s"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    want = [rows[0], rows[3], rows[4], rows[7], rows[9], rows[10]]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))


def test_rows_of_a_kept_id_go_when_they_copy_a_smaller_id(spark):
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (2, "seven eight nine ten eleven twelve")]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
