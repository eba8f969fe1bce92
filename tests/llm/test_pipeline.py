"""The pipeline's stages hand over what they should (sf0.001)."""

import corpus_pipeline
from sprintlens.llm.common import table, written

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, FOLDER, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), f"test-{name}")
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert sizes[1] <= sizes[0] and sizes[3] <= sizes[2] == sizes[1] and sizes[5] == sizes[4]
    first = docs.first()
    assert len(first.ids) == len(first.begins) == len(first.ends) and first.ids[-1] == 2
