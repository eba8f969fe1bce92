"""Large components in the vector search."""

from pyspark.sql import functions as F

from sprintlens.llm import cover_tree


def test_components_beyond_32_bits_score_exactly(spark):
    rows = [(0, [float(2**26), 1.0]), (1, [3.0, 1.0]), (2, [-3.0, 1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {(r["rank"], r.vec_id, r.score) for r in cover_tree.top_k(docs, F.col("vec_id") == 0, k=2).collect()}
    score = lambda v: int(64 * 64 * (2**26 * v[0] + v[1]))
    assert found == {(1, 1, score(rows[1][1])), (2, 2, score(rows[2][1]))}
