"""The pipeline's inputs as Spark DataFrames over a folder of given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duewatch.catalog.views import FIRST_MONTH, GIVEN_TABLES, LAST_MONTH, RAW_VIEWS
from duewatch.operators.customers import clean_clicks
from duewatch.operators.features import FULL_FEATURES, model_table
from duewatch.operators.loans import default_labels, loan_status
from duewatch.plans.tables import RawTables, gold_features, known_customers, silver_attributes, silver_financials


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def raw(self, view: str) -> DataFrame:
        text = RAW_VIEWS[view]
        tables = {name: self.table(name) for name in GIVEN_TABLES if f"{{{name}}}" in text}
        return self.spark.sql(text, **tables)

    def loans(self) -> DataFrame:
        return loan_status(self.raw("raw_loans"))

    def labels(self) -> DataFrame:
        return default_labels(self.loans())

    def silver_attributes(self) -> DataFrame:
        return silver_attributes(self.raw("raw_attributes"), FIRST_MONTH, LAST_MONTH)

    def silver_financials(self) -> DataFrame:
        return silver_financials(self.raw("raw_financials"), FIRST_MONTH, LAST_MONTH)

    def silver_clicks(self) -> DataFrame:
        return clean_clicks(self.raw("raw_clicks"))

    def raw_tables(self) -> RawTables:
        return RawTables(*[self.raw(f"raw_{name}") for name in ("loans", "attributes", "clicks", "financials")])

    def joined(self) -> DataFrame:
        return known_customers(self.raw_tables(), FIRST_MONTH, LAST_MONTH)

    def store(self) -> DataFrame:
        return gold_features(self.raw_tables(), FIRST_MONTH, LAST_MONTH)

    def features(self) -> DataFrame:
        return model_table(self.store(), FULL_FEATURES)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for the comparison with another engine, which adds up in another order."""
    return df.select(
        *[
            F.round(F.col(f"`{field.name}`"), digits).alias(field.name)
            if isinstance(field.dataType, T.DoubleType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )
