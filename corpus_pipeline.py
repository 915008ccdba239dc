"""The training-data pipeline over ``documents``: quality rules, SimHash
near-duplicates, benchmark decontamination, secret scans, best-fit packing.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and
read back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverbed.llm import decontaminate, packing, quality, secrets, simhash
from riverbed.llm.common import shared_path, table, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the isolation forest reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id."""
    return simhash.keep_one(docs, shingle=3, bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of the benchmark go."""
    return decontaminate.drop_documents(docs, table(spark, sf_dir, "benchmark"), n=10)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text becomes a mark; all documents stay."""
    return secrets.redact(docs, secrets.train(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=2, most=1024)


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", simhash_dedup),
          ("benchmark decontamination", decontamination), ("secret scans", secret_scan),
          ("best-fit packing", best_fit_packing)]

#: The isolation forest, XXH64 and the tokenizer are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = shared_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
