"""All pairs within groups as pairs of bounded blocks, so that no pair is a row and no group is a task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def blocked(rows: DataFrame, group: str, row_id: str, columns: Sequence[str], size: int, counts: DataFrame) -> DataFrame:
    """(group, block, blocks, rows): the rows of each group dealt by a hash of their id to lists of about ``size``.

    ``counts`` has (group, blocks), the number of blocks of each group.
    """
    return (
        rows.join(counts, group)
        .withColumn("block", F.pmod(F.xxhash64(row_id), F.col("blocks")).cast("int"))
        .groupBy(group, "block")
        .agg(F.first("blocks").alias("blocks"), F.collect_list(F.struct(*columns)).alias("rows"))
    )


def block_counts(rows: DataFrame, group: str, size: int) -> DataFrame:
    return rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("blocks"))


def paired(left: DataFrame, right: DataFrame, group: str, same: bool) -> DataFrame:
    """Each pair of blocks of a group once, as lists ``left`` and ``right``.

    The blocks are copied to their partners before the join, so the join key is the pair and a large group spreads over
    all tasks. With ``same``, both sides are the same blocks: the pair of a block with itself is included, and of two
    mirrored pairs one.
    """
    totals = right.select(group, F.col("blocks").alias("others")).distinct()
    mine = left.select(group, F.col("block").alias("i"), F.col("blocks").alias("own"), F.col("rows").alias("left"))
    theirs = right.select(group, F.col("block").alias("j"), F.col("rows").alias("right"))
    if same:
        mine = mine.withColumn("j", F.explode(F.sequence(F.col("i"), F.col("own") - 1)))
        theirs = theirs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("j"))))
    else:
        mine = mine.join(totals, group).withColumn("j", F.explode(_up_to("others")))
        others = left.select(group, F.col("blocks").alias("own")).distinct()
        theirs = theirs.join(others, group).withColumn("i", F.explode(_up_to("own")))
    return mine.join(theirs, [group, "i", "j"]).select(group, "i", "j", "left", "right")


def _up_to(count: str) -> Column:
    return F.sequence(F.lit(0), F.col(count) - 1)
