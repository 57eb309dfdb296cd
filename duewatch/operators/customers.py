"""Cleaning of customer attributes and clickstream counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.functions import parsing
from duewatch.operators.loans import typed
from duewatch.operators.lookups import with_summary
from duewatch.sources.schemas import CLICK_FEATURES, CLICK_TYPES

# Ages outside are replaced.
OLDEST, YOUNGEST = 100, 0


def attributes_typed(raw: DataFrame, repair_age: bool = False) -> DataFrame:
    return raw.select(
        F.col("Customer_ID").cast("string").alias("Customer_ID"),
        F.col("Name").cast("string").alias("Name"),
        parsing.parsed_age(F.col("Age"), repair_age).alias("Age"),
        parsing.masked_ssn(F.col("SSN")).alias("SSN"),
        parsing.clean_occupation(F.col("Occupation")).alias("Occupation"),
        parsing.calendar_date(F.col("snapshot_date")).alias("snapshot_date"),
    )


def age_sums(customers: DataFrame) -> DataFrame:
    """Sum and number of the plausible ages per snapshot and occupation."""
    plausible = customers.where(F.col("Age").between(YOUNGEST, OLDEST))
    return plausible.groupBy("snapshot_date", "Occupation").agg(
        F.sum("Age").alias("_sum"), F.count(F.lit(1)).alias("_rows")
    )


def age_means(sums: DataFrame) -> DataFrame:
    return sums.groupBy("snapshot_date", "Occupation").agg((F.sum("_sum") / F.sum("_rows")).alias("_mean_age"))


def ages_imputed(customers: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """An implausible or unknown age becomes the mean plausible age of the occupation in that snapshot.

    ``sums`` may hold several rows per snapshot and occupation, such as the sums
    of raw snapshots carried forward, which spares carrying the rows themselves.
    """
    group = ["snapshot_date", "Occupation"]
    means = age_means(age_sums(customers) if sums is None else sums)
    plausible = F.col("Age").between(YOUNGEST, OLDEST)
    age = F.round(F.when(plausible, F.col("Age")).otherwise(F.col("_mean_age"))).cast("int")
    joined = with_summary(customers, means, group, "age-means").withColumn("Age", age)
    return joined.select(*customers.columns)


def clean_attributes(raw: DataFrame, repair_age: bool = False) -> DataFrame:
    return ages_imputed(attributes_typed(raw, repair_age))


def click_means(clicks: DataFrame) -> DataFrame:
    """Mean of every click column per snapshot, in one pass."""
    return clicks.groupBy("snapshot_date").agg(*[F.avg(name).alias(f"_mean_{name}") for name in CLICK_FEATURES])


def clean_clicks(raw: DataFrame, truncate: bool = True) -> DataFrame:
    """A missing count becomes the mean of its column in that snapshot, cut to a whole number."""
    clicks = typed(raw, CLICK_TYPES)
    joined = with_summary(clicks, click_means(clicks), ["snapshot_date"], "click-means")
    kind = "int" if truncate else "double"
    filled = [
        F.coalesce(F.col(name).cast(kind), F.col(f"_mean_{name}").cast(kind)).alias(name) for name in CLICK_FEATURES
    ]
    return joined.select("Customer_ID", "snapshot_date", *filled)
