"""The corpus pipeline: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsemill.llm import decontaminate, mixing, near_dups, quality, secret_scan
from pulsemill.llm.frames import read_table, staged


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines read as content; the line field is fitted on labelled rows of the stage's own input."""
    return quality.keep_quality(docs, quality.fit_field(docs, read_table(spark, sf_dir, "labels")))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep_one(spark, docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(spark, docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.mask_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with the number of words it takes of each (repeats counted)."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("near-duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]

# The stages align, decode and compare in Python, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
