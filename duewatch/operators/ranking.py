"""Exact order statistics over data of any size: ROC AUC and quantiles.

Ranks need a running sum over sorted values, and one group may hold most of the
rows. The values are therefore counted first (equal values meet on the map side),
range-partitioned into slices, summed inside each slice, and the few slice totals
are put together at the end. No task ever sees more than one slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from duewatch.session import staged

SLICE = "_slice"


def in_slices(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Range-partitioned by keys and value, with the number of the slice."""
    return counts.repartitionByRange(*keys, value).withColumn(SLICE, F.spark_partition_id())


def inside_slice(keys: list[str], value: str):
    return Window.partitionBy(*keys, SLICE).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def slices_before(keys: list[str]):
    """Frame over the slice totals of a key, which are at most one per partition."""
    return Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)


def roc_auc(scored: DataFrame, keys: list[str], label: str = "label", score: str = "default_probability") -> DataFrame:
    """Per group: rows and area under the ROC curve, ties counted half; null with one class only."""
    counts = (
        scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*keys, F.col(score).alias("_value"))
        .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count(F.lit(1)).alias("_all"))
    )
    below = F.sum("_all").over(inside_slice(keys, "_value")) - F.col("_all")
    ranks = F.col("_pos") * (below + (F.col("_all") + 1) / 2)
    slices = (
        in_slices(counts, keys, "_value")
        .withColumn("_ranks", ranks)
        .groupBy(*keys, SLICE)
        .agg(F.sum("_ranks").alias("_ranks"), F.sum("_pos").alias("_pos"), F.sum("_all").alias("_all"))
    )
    before = F.coalesce(F.sum("_all").over(slices_before(keys)), F.lit(0))
    positives = F.sum("_pos").cast("double")
    negatives = F.sum(F.col("_all") - F.col("_pos")).cast("double")
    rank_sum = F.sum(F.col("_ranks") + F.col("_before").cast("double") * F.col("_pos"))
    auc = F.try_divide(rank_sum - positives * (positives + 1) / 2, positives * negatives)
    return (
        slices.withColumn("_before", before).groupBy(*keys).agg(F.sum("_all").alias("records"), auc.alias("auc"))
    )


def staged_counts(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counted values in slices, written once so that every later reading sees the same slices."""
    return staged(in_slices(counts, keys, value), "value-slices")


def sliced_quantiles(
    sliced: DataFrame, keys: list[str], value: str, rows: str, probabilities: list[float]
) -> DataFrame:
    """Quantiles of counted values: ``rows`` holds how often each value occurs.

    The slice totals tell which slice holds a wanted rank; only those slices are
    sorted. One result row per group and probability, interpolated between the
    two neighbouring values.
    """
    totals = sliced.groupBy(*keys, SLICE).agg(F.sum(rows).alias("_size"))
    whole = Window.partitionBy(*keys)
    positions = F.array(*[F.lit(float(p)) for p in probabilities])
    wanted = (
        totals.withColumn("_before", F.coalesce(F.sum("_size").over(slices_before(keys)), F.lit(0)))
        .withColumn("_rows", F.sum("_size").over(whole))
        .withColumn("probability", F.explode(positions))
        .withColumn("_position", F.col("probability") * (F.col("_rows") - 1))
        .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_position"), F.ceil("_position")))))
        .where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_size")))
        .select(*keys, SLICE, "_before", "probability", "_position", "_rank")
    )
    # One row per group and rank, at most two ranks per probability. Written, so that Spark
    # knows its size and broadcasts it only when it is small.
    targets = staged(wanted, "wanted-ranks")
    hits = sliced.select(*keys, SLICE, value, rows).join(targets, [*keys, SLICE])
    running = Window.partitionBy(*keys, SLICE, "probability", "_rank").orderBy(value)
    upto = F.col("_before") + F.sum(rows).over(running.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    picked = hits.withColumn("_upto", upto).where(
        (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col(rows))
    )
    low, high = F.min(value), F.max(value)
    share = F.max(F.col("_position") - F.floor("_position"))
    return picked.groupBy(*keys, "probability").agg((low + (high - low) * share).alias("quantile"))


def exact_quantiles(values: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """Quantiles of a column per group."""
    known = values.where(F.col(value).isNotNull())
    counts = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_all"))
    return sliced_quantiles(staged_counts(counts, keys, value), keys, value, "_all", probabilities)
