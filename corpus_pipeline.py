"""From raw documents to packed training sequences, one written stage after the other.

Each stage takes (spark, docs, folder of given tables) and returns a DataFrame. All but the last return the columns of
``documents``; the next stage reads what the stage before has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duewatch.llm.minhash import deduplicated
from duewatch.llm.packing import pack_documents
from duewatch.llm.quality_rules import good_documents
from duewatch.llm.queries import TOKENIZER, vocabulary
from duewatch.llm.scratch import Scratch
from duewatch.llm.substrings import passages_cut
from duewatch.llm.toxicity import clean_documents
from duewatch.session import ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    ship_package(spark)
    return good_documents(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier trained on the labelled ones among them does not call toxic."""
    ship_package(spark)
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship_package(spark)
    return deduplicated(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur more than once; n_chars follows the new text."""
    ship_package(spark)
    cut = passages_cut(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of 1024 tokens."""
    ship_package(spark)
    return pack_documents(docs, vocabulary(TOKENIZER), keep_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Trained scores and tokenizers cannot be stated in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        kept = scratch.put(stage(spark, docs, sf_dir), f"pipeline-{name}")
        scratch.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
