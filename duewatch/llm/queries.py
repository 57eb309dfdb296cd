"""The operators as named queries over the given tables, and SQL for those that SQL can express on whole tables.

Importance resampling and the secret scan have SQL (``checks``). The others have none: models, tokenizers, sketches and
packings have no SQL form, and the exact parts of the rest (windows of 35 words, shingle sets) are too slow in SQL on whole
tables. They are tested against brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duewatch.llm.checks import CHECKS
from duewatch.session import ship_package

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

__all__ = ["CHECKS", "QUERIES", "query"]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return build


@query
def op1_ordinal_quality(spark, folder):
    """Grades of the ratings: 0 low quality, 1 fair (of quality, but toxic), 2 good."""
    from pyspark.sql import functions as F

    from duewatch.llm.ordinal import grade_report, train_grades
    from duewatch.llm.toxicity import held_out_rows

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    grade = F.col("quality") * (F.lit(2) - F.coalesce("toxic", F.lit(0)))
    held_out = held_out_rows("doc_id", 4, 2)
    model = train_grades(docs, labels.withColumn("grade", grade), held_out=held_out)
    return grade_report(docs, model).select(
        "doc_id", held_out.alias("held_out"), "expected_grade", F.col("tail_probabilities")[0].alias("p_fair"),
        F.element_at("tail_probabilities", -1).alias("p_good"), "kept",
    )


@query
def op2_best_fit_packing(spark, folder):
    from duewatch.llm.packing import pack_documents

    return pack_documents(table(spark, folder, "documents"), vocabulary(TOKENIZER), keep_ids=False)


@query
def op3_embedding_near_dedup(spark, folder):
    from duewatch.llm.vectors import similar_vectors

    return similar_vectors(table(spark, folder, "embeddings"))


@query
def op4_quality_rules(spark, folder):
    from duewatch.llm.quality_rules import quality_report

    return quality_report(table(spark, folder, "documents"))


@query
def op5_toxicity(spark, folder):
    from duewatch.llm.toxicity import toxicity_report

    return toxicity_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op6_sentencepiece(spark, folder):
    from duewatch.llm.pieces import encode_documents

    return encode_documents(table(spark, folder, "documents"), vocabulary(PIECES), keep=False)


@query
def op7_minhash_near_dedup(spark, folder):
    from duewatch.llm.minhash import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


@query
def op8_substring_dedup(spark, folder):
    from duewatch.llm.substrings import without_repeats

    return without_repeats(table(spark, folder, "documents"), keep_text=False)


@query
def op9_html_extraction(spark, folder):
    from duewatch.llm.pages import main_texts

    return main_texts(table(spark, folder, "pages"))


@query
def op10_lm_scoring(spark, folder):
    from duewatch.llm.lm import language_model_scores

    return language_model_scores(table(spark, folder, "documents"))


@query
def op11_cross_tokenizer_alignment(spark, folder):
    from duewatch.llm.alignment import align_documents

    return align_documents(table(spark, folder, "documents"), vocabulary(TOKENIZER), vocabulary(PIECES), keep=False)


@query
def op12_importance_resampling(spark, folder):
    from duewatch.llm.resampling import importance_resample

    return importance_resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op13_secret_scan(spark, folder):
    from duewatch.llm.secret_scan import scan_secrets

    return scan_secrets(table(spark, folder, "documents"))


@query
def pipeline(spark, folder):
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
