"""Joining rows with a summary of their group."""

from __future__ import annotations

from pyspark.sql import DataFrame

from duewatch.session import staged


def with_summary(rows: DataFrame, summary: DataFrame, on: list[str], name: str) -> DataFrame:
    """Left-join a one-row-per-group summary.

    The summary is written first, so its size is known when the join is planned:
    Spark broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and the
    rows are not shuffled at all. Above, both sides shuffle on the group and
    adaptive execution splits the groups that hold too many rows.
    """
    return rows.join(staged(summary, name), on, "left")
