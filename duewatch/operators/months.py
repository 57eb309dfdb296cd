"""Snapshot months: selecting, carrying rows forward, listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from duewatch.functions.numeric import month_start, next_month_start, one_month


def as_date(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def at_month(df: DataFrame, month, date_col: str = "snapshot_date") -> DataFrame:
    """Rows of exactly one snapshot."""
    return df.where(F.col(date_col) == as_date(month))


def months_until(start: Column, end: Column) -> Column:
    """Array of first-of-month dates from ``start`` to ``end``, null when there is none."""
    return F.when(start <= end, F.sequence(start, end, one_month()))


def restamped(df: DataFrame, first, last, date_col: str = "snapshot_date") -> DataFrame:
    """For every month from ``first`` to ``last``, all rows known by then, dated to that month.

    Each row lists the months it belongs to, so there is no join and no shuffle.
    A customer with several rows keeps all of them in every later month.
    """
    known = df.where(F.col(date_col) <= as_date(last))
    start = F.greatest(next_month_start(F.col(date_col)), as_date(first))
    others = [name for name in df.columns if name != date_col]
    return known.select(*others, F.explode(months_until(start, as_date(last))).alias(date_col)).select(*df.columns)


def latest_known(df: DataFrame, key: str, first, last, date_col: str = "snapshot_date") -> DataFrame:
    """Per customer and month the newest row known by then, dated to that month.

    Rows shrink first to one per customer and month of arrival, on the map side
    too, so a customer with very many rows never lands in one task. The newest
    row then covers the months up to the next arrival.
    """
    values = [name for name in df.columns if name not in (key, date_col)]
    arrivals = (
        df.where(F.col(date_col) <= as_date(last))
        .withColumn("_from", F.greatest(next_month_start(F.col(date_col)), as_date(first)))
        .groupBy(key, "_from")
        .agg(F.max(F.struct(F.col(date_col).alias("_seen"), *values)).alias("_row"))
    )
    following = F.lead("_from").over(Window.partitionBy(key).orderBy("_from"))
    until = F.coalesce(F.add_months(following, -1), as_date(last))
    spread = arrivals.withColumn("_until", until).where(F.col("_from") <= F.col("_until"))
    return spread.select(
        key,
        *[F.col(f"_row.{name}").alias(name) for name in values],
        F.explode(months_until(F.col("_from"), F.col("_until"))).alias(date_col),
    ).select(*df.columns)


def month_list(df: DataFrame, date_col: str, lookback: int = 0) -> DataFrame:
    """Every first of month between the oldest and newest date, starting ``lookback`` months earlier."""
    bounds = df.agg(
        F.add_months(month_start(F.min(date_col)), -lookback).alias("start"),
        F.max(date_col).cast("date").alias("end"),
    )
    return bounds.select(F.explode(months_until(F.col("start"), F.col("end"))).alias("snapshot_date"))


def run_months(runs: DataFrame, backfill_start, target_col: str = "target_date", manual_col: str = "is_manual") -> DataFrame:
    """Months each run has to process.

    A manual run with a target after ``backfill_start`` covers every month from
    there to the target; any other run covers its own target only.
    """
    start, target = as_date(backfill_start), F.col(target_col).cast("date")
    backfill = F.coalesce(F.col(manual_col) & (target > start), F.lit(False))
    months = F.when(backfill, months_until(next_month_start(start), target)).otherwise(F.array(target))
    return runs.withColumn("run_month", F.explode(months))
