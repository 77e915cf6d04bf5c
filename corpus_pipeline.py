"""The corpus pipeline: toxic text, copies, near copies and benchmark leaks go; sources mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``docs``;
it is written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from newsledger.llm import decontaminate, exact_dedup, mixing, simhash, toxicity
from newsledger.llm.common import prepare, read
from newsledger.session import shared_folder


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity model, fitted on all labels, scores 0.5 or more."""
    prepare(spark)
    return toxicity.reject(docs, read(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the largest id, of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that with the smallest id, of each near-duplicate group
    (five-word shingles, similarity of 0.8 or more)."""
    prepare(spark)
    return simhash.deduplicate(docs, words=5, similarity=0.8)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that repeat a passage of the benchmark."""
    prepare(spark)
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin out documents until their sources have the target weights."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxic_texts),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("mixing", mixed_sources),
]

#: Fitted models, fingerprints and seeds of hashes have no SQL form; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs
