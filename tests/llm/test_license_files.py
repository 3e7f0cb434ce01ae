"""The licence scan's result, far smaller than the texts, takes few files."""

from pathlib import Path

from foliospark.llm import licenses

CONF = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def test_result_takes_few_files(spark, tmp_path):
    had = {k: spark.conf.get(k) for k in CONF}
    notices = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License."]
    docs = spark.createDataFrame([(i, f"some prose of {i}\n{notices[i % 2]}\nmore prose of {i}") for i in range(300)], "doc_id long, text string")
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        licenses.scan_licenses(docs).write.parquet(f"{tmp_path}/out")
    finally:
        for k, v in had.items():
            spark.conf.set(k, v)
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((r["doc_id"], r["paragraph"], r["family"]) for r in got) == [(i, 1, ("apache", "mit")[i % 2]) for i in range(300)]
    assert 1 < len(list(Path(tmp_path, "out").glob("part-*"))) <= 8
