"""The operators over whole tables, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontam, licenses, mixing, quality, secrets, simhash, substring, suffix, tiff, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.table(_documents(spark, sf_dir))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.table(_documents(spark, sf_dir))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.table(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_documents(spark, sf_dir))


def op8_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.digests(tiff.text_media(_documents(spark, sf_dir)))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(substring.dedup_substrings(_documents(spark, sf_dir)))


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(suffix.dedup_bytes(_documents(spark, sf_dir)))


def queries() -> dict:
    own = (op1_decontamination, op2_mixing, op3_secrets, op4_licenses, op5_simhash, op6_toxicity, op7_quality, op8_tiff, op9_substrings, op10_suffixes)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": mixing.oracle()}
