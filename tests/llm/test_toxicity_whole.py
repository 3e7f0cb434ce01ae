"""Toxicity learns from every labelled row that isn't held out, in shards, and sets its thresholds by all of the rest."""

import random

import numpy as np
from pyspark.sql import functions as F

from foliospark.llm import toxicity

SCHEMA = "doc_id long, text string, lang string"


def corpus(spark, n, bad):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randint(0, 300)}" for _ in range(8)) + bad(i), "en" if i % 3 else "fr") for i in range(n)]
    labels = [(i, 1, int(bool(bad(i)))) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_words_beyond_the_first_4000_rows_of_a_label_are_learnt(spark):
    """One toxic word is in the rows of the least id hashes, another only in those after the 4,000th."""
    n = 13000
    toxic = spark.range(n).where("id % 2 = 0 AND crc32(cast(cast(id AS string) AS binary)) % 5 != 0").orderBy(F.xxhash64("id"))
    late = {r["id"] for r in toxic.collect()[4000:]}
    held = {i for i in range(0, n, 2)} - {r["id"] for r in toxic.collect()}
    docs, labels = corpus(spark, n, lambda i: "" if i % 2 else " filth" if i in late or i in held else " scum")
    got = [r["predicted"] for r in toxicity.table(docs, labels).where("held_out").collect() if r["doc_id"] in held]
    assert len(late) > 500 and len(got) == len(held) and np.mean(got) > 0.95


def test_shards(spark):
    """Several shards learn what one does, whatever the partitions."""
    docs, labels = corpus(spark, 1500, lambda i: " scum" if i % 4 == 0 else "")
    models = [toxicity.train(docs.repartition(n), labels.repartition(n), shard_rows=300)[0] for n in (2, 5)]
    assert np.array_equal(models[0].table, models[1].table) and np.array_equal(models[0].conv, models[1].conv)
    score = toxicity.score(docs, models[0], {"": 0.5}).select("doc_id", "flagged").collect()
    assert np.mean([r["flagged"] == (r["doc_id"] % 4 == 0) for r in score]) > 0.97


def test_thresholds_by_all_rows(spark):
    docs, labels = corpus(spark, 1500, lambda i: " scum" if i % 4 == 0 else "")
    noisy = labels.withColumn("toxic", F.when(F.col("doc_id") % 11 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    model, cuts = toxicity.train(docs, noisy)
    rest = docs.join(noisy, "doc_id").where(~toxicity.held_out() & ~toxicity.used())
    rows = toxicity.score(rest.select("doc_id", "lang", "text", "toxic"), model, {"": 0.5}).collect()
    for lang in ("", "en", "fr"):
        own = [r for r in rows if lang in ("", r["lang"])]
        s = np.rint(np.array([r["score"] for r in own]) * toxicity.STEPS) / toxicity.STEPS
        assert cuts[lang] == max(0.5, toxicity.threshold(s, np.array([r["toxic"] for r in own])))
