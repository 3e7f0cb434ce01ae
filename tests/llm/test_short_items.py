"""Benchmark items too short for edits are found as whole words."""

from foliospark.llm import decontam


def test_short_items(spark):
    bench = spark.createDataFrame([(1, "What is  7 x 6?"), (2, "Paris"), (3, "is"), (4, ""), (5, None)], "item_id long, text string")
    rows = [(10, "So what is\n7 X 6? Tell"), (11, "what is 7 x 67?"), (12, "parisian this"), (13, "comparis (PARIS)!"), (14, None), (None, "paris")]
    got = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(10, 1), (10, 3), (11, 3), (13, 2), (None, 2)} and all(r["distance"] == 0 for r in got)
    assert {(r["start"], r["end"], r["item_chars"]) for r in got if r["doc_id"] == 13} == {(10, 15, 5)}
