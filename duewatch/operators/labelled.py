"""Joins between labels, features and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER_SPLIT = "Other"


def training_set(labels: DataFrame, features: DataFrame, lag_months: int = 6, months: list | None = None) -> DataFrame:
    """Each label with the customer's features ``lag_months`` earlier, all months in one join.

    A label without features, or with a gap in any feature, is left out: that is
    the inner join followed by a row filter. Both sides shuffle once, on customer
    and month; a customer with very many rows is split by adaptive execution.
    """
    if months is not None:
        labels = labels.where(F.col("snapshot_date").isin([F.lit(m).cast("date") for m in months]))
    left = labels.select(
        "Customer_ID", "label", F.add_months("snapshot_date", -lag_months).alias("feature_snapshot_date")
    )
    right = features.withColumnRenamed("snapshot_date", "feature_snapshot_date")
    names = [name for name in features.columns if name not in ("Customer_ID", "snapshot_date")]
    joined = left.join(right, ["Customer_ID", "feature_snapshot_date"]).na.drop("any", subset=names)
    return joined.select(
        "Customer_ID",
        "label",
        *[F.col(f"`{name}`") for name in names],
        F.date_format("feature_snapshot_date", "yyyy-MM-dd").alias("feature_snapshot_date"),
    )


def complete_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a gap in the given columns."""
    return df.na.drop("any", subset=columns)


def dropped_counts(df: DataFrame, columns: list[str], by: str | Column) -> DataFrame:
    """Per group: rows, rows kept and rows with a gap, from one pass."""
    gap = F.lit(False)
    for name in columns:
        gap = gap | F.col(f"`{name}`").isNull()
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~gap).alias("kept"),
        F.count_if(gap).alias("dropped"),
    )


def scored_with_labels(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """Scored rows that have a label of the same month."""
    keys = ["Customer_ID", "snapshot_date"]
    return scored.join(labels.select(*keys, "label"), keys)


def unmatched_labels(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels per month without a scored row."""
    keys = ["Customer_ID", "snapshot_date"]
    missing = labels.join(scored.select(*keys), keys, "left_anti")
    return missing.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("unmatched"))


def newest_label_month(labels: DataFrame) -> DataFrame:
    """Per customer the newest month with a label."""
    known = labels.where(F.col("Customer_ID").isNotNull())
    return known.groupBy("Customer_ID").agg(
        F.date_format(F.max("snapshot_date"), "yyyy-MM-dd").alias("label_snapshot_month")
    )


def with_label_membership(scored: DataFrame, labels: DataFrame) -> DataFrame:
    return scored.join(newest_label_month(labels), "Customer_ID", "left")


def customers_in_both(labels: DataFrame, first, second) -> DataFrame:
    """Distinct customers with a label in both months."""
    in_month = [F.max(F.col("snapshot_date") == F.lit(m).cast("date")) for m in (first, second)]
    wanted = labels.where(F.col("snapshot_date").isin([F.lit(m).cast("date") for m in (first, second)]))
    return wanted.groupBy("Customer_ID").agg(
        in_month[0].alias("_first"), in_month[1].alias("_second")
    ).where("_first and _second").select("Customer_ID")


def customer_months(labels: DataFrame) -> DataFrame:
    """Each customer once per label month."""
    return labels.select("Customer_ID", "snapshot_date").distinct()


def consecutive_overlap(labels: DataFrame, step_months: int = 1) -> DataFrame:
    """For every month the number of its customers that also have a label ``step_months`` later."""
    present = customer_months(labels)
    later = present.select("Customer_ID", F.add_months("snapshot_date", -step_months).alias("snapshot_date"))
    both = present.join(later, ["Customer_ID", "snapshot_date"], "left_semi")
    return both.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("customers"))


def split_name(month: Column, splits: list[tuple[str, str, str]]) -> Column:
    """Name of the split whose months cover ``month``."""
    named = [
        F.when(month.between(F.lit(first).cast("date"), F.lit(last).cast("date")), F.lit(name))
        for name, first, last in splits
    ]
    return F.coalesce(*named, F.lit(OTHER_SPLIT))
