"""Documents whose word and line statistics are far from those of their language and source.

Base rules reject texts of under 20 words and texts with over 30 % of their words
in repeated 8-word windows. The others are judged by Mahalanobis distance from
the minimum-covariance-determinant estimate (see ``robust``) of their language
and source, over four transformed statistics. A group of under ``LEAST_GROUP``
documents is judged by its language, and a language of under that by all.

Null texts have no words and fail the base rules. Null languages and sources are
groups of their own. Repeated rows and ids are judged each by itself.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duewatch.llm.robust import chi_square_quantile, mcd_estimates, squared_distance
from duewatch.llm.scratch import Scratch
from duewatch.llm.word_statistics import FIELDS, statistics

LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
LEAST_GROUP = 50
CONFIDENCE = 0.9999
# Transformed statistics, and the least standard deviation of each that matters.
FEATURES = {"symbol_rate": 0.05, "word_length": 0.08, "dup_line_rate": 0.15, "repeat_rate": 0.1}


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in FIELDS]))
def text_statistics(text: pa.Array) -> pa.Array:
    rows = [statistics(t) for t in text.cast(pa.large_binary()).to_pylist()]
    columns = list(zip(*rows)) or [()] * len(FIELDS)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(FIELDS))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT
    )


def transformed(lines: Column) -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "symbol_rate": F.log1p(F.col("n_symbols") / words),
        "word_length": F.log(F.greatest(F.col("word_chars") / words, F.lit(1.0))),
        "dup_line_rate": F.col("n_dup_lines") / lines,
        "repeat_rate": F.col("n_repeat_words") / words,
    }


def judged(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
    carry: list[str] | None = None, confidence: float = CONFIDENCE,
) -> DataFrame:
    """The columns ``carry`` (all if None) with the statistics, base_failed, distance (null if base_failed) and kept.

    Carried columns come back under their own names inside the struct column ``row``, so none can clash.
    """
    carry = docs.columns if carry is None else carry
    scratch = Scratch(docs.sparkSession)
    text = F.col(f"`{text_column}`")
    measured = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("\x00")).alias("lang"),
        F.coalesce(F.col(f"`{source_column}`").cast("string"), F.lit("\x00")).alias("source"),
        F.coalesce(F.length(text) - F.length(F.translate(text, "\n", "")) + 1, F.lit(1)).cast("double").alias("lines"),
        text_statistics(text.cast("string")).alias("counts"),
    ).select("row", "lang", "source", "lines", "counts.*")
    measured = measured.withColumn("base_failed", base_failed())
    measured = scratch.put(measured.withColumns(transformed(F.col("lines"))).drop("lines"), "quality")

    levels = {
        "by_source": F.concat_ws("\x01", "lang", "source"), "by_lang": F.concat_ws("\x01", "lang"), "by_none": F.lit("\x02"),
    }
    passed = measured.filter(~F.col("base_failed")).select(
        F.explode(F.array(*levels.values())).alias("key"), *FEATURES
    )
    estimates = mcd_estimates(passed, list(FEATURES), list(FEATURES.values()))
    enough = estimates.filter((F.col("members") >= LEAST_GROUP) | (F.col("key") == "\x02"))
    found = measured
    for level, key in levels.items():
        own = enough.select(F.col("key").alias(level), F.struct("centre", "inverse").alias(f"{level}_estimate"))
        found = found.withColumn(level, key).join(own, level, "left")
    chosen = F.coalesce(*[F.col(f"{level}_estimate") for level in levels])
    far = squared_distance(list(FEATURES), "estimate.centre", "estimate.inverse")
    found = found.withColumn("estimate", chosen).withColumn(
        "distance", F.when(~F.col("base_failed"), F.sqrt(F.greatest(far, F.lit(0.0))))
    )
    limit = chi_square_quantile(confidence, len(FEATURES)) ** 0.5
    return found.select(
        "row", *FIELDS, "base_failed", "distance",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))).alias("kept"),
    )


def quality_report(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, statistics, base_failed, distance and kept."""
    found = judged(docs, carry=[id_column], **options)
    return found.select(F.col(f"row.`{id_column}`").alias(id_column), *FIELDS, "base_failed", "distance", "kept")


def good_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with their columns."""
    return judged(docs, **options).filter("kept").select("row.*")
