"""Cleaning pipeline over documents: STAGES in order, each written and read again before the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import decontaminate, mixing, secrets, simhash, toxicity
from tripmart.llm.graph import shared_folder
from tripmart.llm.queries import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a model learned from the labelled ones outside the held-out fold."""
    ship(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group."""
    ship(spark)
    return simhash.keep_first(docs, words_per_shingle=3, max_bits=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    ship(spark)
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), threshold=0.8, width=5)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts; n_chars follows the text."""
    ship(spark)
    return secrets.mask_secrets(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to target weights of their sources (square roots of their sizes), globally shuffled."""
    ship(spark)
    return mixing.mix(docs, power=0.5, seed=17)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("source_mixing", mix_sources),
]

#: Fingerprints and learned scores have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what passes between them is in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = f"{folder}/{i}-{name}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
