"""A corpus pipeline of five stages, each over all that its predecessor kept.

Every stage takes rows as they are: ids may be null or repeat, texts may be null, empty or very long, and other
columns may have any name. A row is judged by its own text; only near duplicates compare rows. An
empty table goes through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import decontam, mixing, nearcopies, secrets, toxicity
from foliospark.llm.base import drop, durable, free, row_key, small_batches
from foliospark.session import ship


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score reaches the threshold of their language go; null and empty texts have the score of an empty text."""
    small_batches(spark)
    model, cuts = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score, flag = free(docs, "toxicity"), free(docs, "toxic")
    kept = toxicity.score(docs, model, cuts, score, flag)
    return kept.where(~F.col(flag)).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (5-word shingles, similarity 0.8 or more) exactly one row stays, the least by id (null last)
    and row key; null and empty texts are copies of each other, and of rows of one id and one text one stays."""
    small_batches(spark)
    key, kept_id, kept_key = free(docs, "row_key"), free(docs, "kept_id"), free(docs, "kept_key")
    first = durable(nearcopies.firsts(docs).select(F.col("doc_id").alias(kept_id), F.col("key").alias(kept_key)))
    keyed = docs.withColumn(key, row_key())
    kept = keyed.join(first.hint("shuffle_hash"), (F.col(key) == F.col(kept_key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id)), "left_semi")
    if nearcopies.repeats(keyed.select("doc_id", F.col(key).alias("key"))):
        kept = kept.dropDuplicates(["doc_id", key])  # rows of one id and one text
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, whatever their id; null and empty texts hold none."""
    small_batches(spark)
    return decontam.without(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows. Null and empty texts stay as they are."""
    small_batches(spark)
    count = free(docs, "secrets")
    clean = secrets.redact(docs, count=count)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col(count) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows sampled to the target mix, with topic, tokens, probability and weight; rows of one id are sampled alike."""
    return mixing.sample(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
]

#: The trained classifier and the groups can't be expressed in SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = durable(docs)
            if last:
                drop(last)  # what a stage has read isn't needed once it is written
            last = docs
    return docs
