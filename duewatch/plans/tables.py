"""Raw tables to bronze, silver and gold, for all months at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duewatch.functions.parsing import calendar_date, dash_separated, flexible_date
from duewatch.operators.customers import age_sums, ages_imputed, attributes_typed, clean_clicks
from duewatch.operators.features import (
    FULL_FEATURES,
    LINEAR_FEATURES,
    feature_store,
    joined_as_known,
    model_table,
)
from duewatch.operators.financials import clean_financials
from duewatch.operators.loans import default_labels, loan_status
from duewatch.operators.months import restamped
from duewatch.session import staged
from duewatch.sources import schemas
from duewatch.sources.snapshots import calendar_months, read_raw_csv, read_snapshots, write_snapshots

# Label definition, feature lag and model tables.
DPD, MOB, LAG_MONTHS = 30, 6, 6
MODEL_TABLES = {"feature_store_full": FULL_FEATURES, "feature_store_linear": LINEAR_FEATURES}


@dataclass(frozen=True)
class RawTables:
    """The four raw inputs as text columns."""

    loans: DataFrame
    attributes: DataFrame
    clicks: DataFrame
    financials: DataFrame

    @staticmethod
    def from_csv(spark: SparkSession, folder: str) -> RawTables:
        return RawTables(
            loans=read_raw_csv(spark, f"{folder}/lms_loan_daily.csv", schemas.LOAN_COLUMNS),
            attributes=read_raw_csv(spark, f"{folder}/features_attributes.csv", schemas.ATTRIBUTE_COLUMNS),
            clicks=read_raw_csv(spark, f"{folder}/feature_clickstream.csv", schemas.CLICK_COLUMNS),
            financials=read_raw_csv(spark, f"{folder}/features_financials.csv", schemas.FINANCIAL_COLUMNS),
        )


def month_rows(df: DataFrame, first, last) -> DataFrame:
    """Raw rows whose snapshot lies between two months, with the snapshot as a date."""
    dated = df.withColumn("snapshot_date", calendar_date(F.col("snapshot_date")))
    bounds = [F.lit(day).cast("date") for day in (first, last)]
    return dated.where(F.col("snapshot_date").between(*bounds))


def carried_attributes(typed: DataFrame, first, last) -> DataFrame:
    """Typed rows carried forward; so are the age sums behind the means."""
    return ages_imputed(restamped(typed, first, last), restamped(age_sums(typed), first, last))


def carried_financials(cleaned: DataFrame, first, last) -> DataFrame:
    carried = restamped(cleaned, first, last)
    return carried.withColumn("snapshot_date_str", F.date_format("snapshot_date", "yyyy-MM-dd"))


def silver_attributes(raw: DataFrame, first, last) -> DataFrame:
    """Text is cleaned once per raw row and then carried forward."""
    return carried_attributes(attributes_typed(raw), first, last)


def silver_financials(raw: DataFrame, first, last) -> DataFrame:
    """Cleaned once per raw row, then carried forward."""
    return carried_financials(clean_financials(raw), first, last)


def known_by_click_month(typed: DataFrame, cleaned: DataFrame, clicks: DataFrame, first, last) -> DataFrame:
    """Customer-months of the click table with everything known by then, ages filled."""
    joined = joined_as_known(typed, cleaned.drop("snapshot_date_str"), clicks)
    return ages_imputed(joined, restamped(age_sums(typed), first, last))


def known_customers(raw: RawTables, first, last) -> DataFrame:
    """The same from raw tables."""
    clicks = clean_clicks(month_rows(raw.clicks, first, last))
    return known_by_click_month(attributes_typed(raw.attributes), clean_financials(raw.financials), clicks, first, last)


def gold_features(raw: RawTables, first, last) -> DataFrame:
    """Raw tables to the gold table without the silver tables in between."""
    return feature_store(known_customers(raw, first, last))


def bronze_tables(raw: RawTables, first, last) -> dict[str, DataFrame]:
    """What was known at each month, still as text: loans and clicks of the month, the other two carried forward."""
    attributes = raw.attributes.withColumn("snapshot_date", calendar_date(F.col("snapshot_date")))
    financials = raw.financials.withColumn("snapshot_date", flexible_date(dash_separated(F.col("snapshot_date"))))
    return {
        "loan_daily": month_rows(raw.loans, first, last),
        "clickstream": month_rows(raw.clicks, first, last),
        "attributes": restamped(attributes, first, last),
        "financials": restamped(financials, first, last),
    }


def backfill(raw: RawTables, root: str, first, last, dpd: int = DPD, mob: int = MOB) -> None:
    """Write all layers for the months from ``first`` to ``last``; other months of the tables stay.

    The raw text is read once: typed and cleaned rows are written, and the silver tables, which carry them to every later
    month, and the gold table, which compares their dates with the click month, both read these.
    """
    spark = raw.loans.sparkSession
    months = calendar_months(first, last)
    raw = RawTables(*[staged(table, "raw") for table in (raw.loans, raw.attributes, raw.clicks, raw.financials)])
    for name, table in bronze_tables(raw, first, last).items():
        write_snapshots(table, f"{root}/bronze/{name}", "csv", months=months)

    typed, cleaned = staged(attributes_typed(raw.attributes), "typed"), staged(clean_financials(raw.financials), "cleaned")
    loans = loan_status(month_rows(raw.loans, first, last))
    write_snapshots(loans, f"{root}/silver/loan_daily", months=months)
    write_snapshots(carried_attributes(typed, first, last), f"{root}/silver/attributes", months=months)
    write_snapshots(carried_financials(cleaned, first, last), f"{root}/silver/financials", months=months)
    write_snapshots(clean_clicks(month_rows(raw.clicks, first, last)), f"{root}/silver/clickstream", months=months)

    def silver(name: str) -> DataFrame:
        return read_snapshots(spark, f"{root}/silver/{name}", first, last)

    write_snapshots(default_labels(silver("loan_daily"), dpd, mob), f"{root}/gold/label_store", months=months)
    store = feature_store(known_by_click_month(typed, cleaned, silver("clickstream"), first, last))
    write_snapshots(store, f"{root}/gold/feature_store", months=months)
    written = read_snapshots(spark, f"{root}/gold/feature_store", first, last)
    for name, features in MODEL_TABLES.items():
        write_snapshots(model_table(written, features), f"{root}/gold/{name}", months=months)
