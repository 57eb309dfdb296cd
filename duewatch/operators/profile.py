"""Profiles of raw and cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.functions.numeric import month_start


def rows_per_month(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    return df.groupBy(date_col).agg(F.count(F.lit(1)).alias("rows"))


def distinct_months(training: DataFrame, date_cols: list[str]) -> DataFrame:
    """Number of distinct months in each column the table has."""
    present = [name for name in date_cols if name in training.columns]
    return training.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_distinct(name).alias(f"{name}_count") for name in present],
    )


def score_summary(scored: DataFrame, score: str = "default_probability") -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.avg(score).alias("mean_probability"))


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per category."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select(column, "rows", (F.col("rows") / total).alias("share"))


def months_with_rows(df: DataFrame, date_col: str, value_col: str) -> DataFrame:
    """Calendar-month buckets of a date column; months without rows do not appear."""
    return df.groupBy(month_start(F.col(date_col)).alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(value_col).alias("smallest"), F.max(value_col).alias("largest")
    )


def null_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values, smallest and largest value per column, from one pass over the table."""
    stats = []
    for place, name in enumerate(columns):
        value = F.col(f"`{name}`")
        stats += [
            F.count_if(value.isNull()).alias(f"nulls_{place}"),
            F.min(value).cast("double").alias(f"low_{place}"),
            F.max(value).cast("double").alias(f"high_{place}"),
        ]
    records = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"nulls_{place}").alias("nulls"),
            F.col(f"low_{place}").alias("smallest"),
            F.col(f"high_{place}").alias("largest"),
        )
        for place, name in enumerate(columns)
    ]
    return df.agg(*stats).select(F.inline(F.array(*records)))


def unreadable_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct texts per column that are not a number, with their frequency."""
    texts = df.select(*[F.col(f"`{name}`").cast("string").alias(name) for name in columns])
    long = texts.unpivot([], [F.col(f"`{name}`") for name in columns], "column_name", "value")
    bad = F.col("value").isNotNull() & F.col("value").try_cast("double").isNull()
    return long.where(bad).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))


def outside(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def histogram_by_group(df: DataFrame, value_col: str, group_col: str, bins: int = 100) -> DataFrame:
    """Equal-width bins over the whole value range, counted per group and for all groups together."""
    known = df.where(F.col(value_col).isNotNull())
    value = F.col(value_col).cast("double")
    bounds = known.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    placed = known.select(F.col(group_col).alias("group"), value.alias("_value"), bounds.alias("_range"))
    width = (F.col("_range.high") - F.col("_range.low")) / bins
    number = F.least(F.lit(bins - 1), F.floor(F.try_divide(F.col("_value") - F.col("_range.low"), width))).cast("int")
    counted = placed.groupBy("group", F.coalesce(number, F.lit(0)).alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    overall = counted.groupBy("bin").agg(F.sum("rows").alias("rows")).select(F.lit("(all)").alias("group"), "bin", "rows")
    return counted.unionByName(overall)
