"""Loan status per snapshot and the default label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.functions import parsing
from duewatch.functions.numeric import flag, ratio
from duewatch.sources.schemas import LOAN_TYPES

READERS = {
    "string": lambda value: value.cast("string"),
    "int": parsing.whole_number,
    "double": parsing.decimal_number,
    "date": parsing.calendar_date,
}


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns with the given types in one select; a value that does not fit becomes null.

    A column that has its type already passes as it is, so filters on it reach the scan.
    """
    present = dict(df.dtypes)
    return df.select(
        *[
            F.col(name) if present[name] == kind else READERS[kind](F.col(name)).alias(name)
            for name, kind in types.items()
        ]
    )


def with_months_on_book(loans: DataFrame) -> DataFrame:
    return loans.withColumn("mob", F.col("installment_num").cast("int"))


def with_installments_missed(loans: DataFrame) -> DataFrame:
    """Overdue amount in whole installments; 0 when nothing is due."""
    missed = F.ceil(ratio(F.col("overdue_amt"), F.col("due_amt"))).try_cast("int")
    return loans.withColumn("installments_missed", F.coalesce(missed, F.lit(0)))


def with_numbers_filled(df: DataFrame) -> DataFrame:
    """Null and NaN as 0 in every numeric column."""
    return df.na.fill(0)


def with_first_missed_date(loans: DataFrame) -> DataFrame:
    back = F.add_months("snapshot_date", -F.col("installments_missed"))
    return loans.withColumn("first_missed_date", F.when(F.col("installments_missed") > 0, back))


def with_days_past_due(loans: DataFrame) -> DataFrame:
    """Days since the first missed date; null when money is overdue without a missed date."""
    days = F.datediff("snapshot_date", "first_missed_date")
    return loans.withColumn("dpd", F.when(F.col("overdue_amt") > 0, days).otherwise(F.lit(0)))


def loan_status(raw: DataFrame) -> DataFrame:
    """Raw loan rows of any number of snapshots to the cleaned loan table."""
    loans = with_months_on_book(typed(raw, LOAN_TYPES))
    loans = with_numbers_filled(with_installments_missed(loans))
    return with_days_past_due(with_first_missed_date(loans))


def default_labels(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Loans at the given month on book, labelled 1 from ``dpd`` days past due."""
    return loans.where(F.col("mob") == mob).select(
        "loan_id",
        "Customer_ID",
        flag(F.col("dpd") >= dpd).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        "snapshot_date",
    )


def bad_rate_by_month_on_book(loans: DataFrame, started_before, dpd: int = 30) -> DataFrame:
    """Share of loans past due per month on book, for loans started before a date."""
    started = loans.where(F.col("loan_start_date") < F.lit(started_before).cast("date"))
    late = flag(F.col("dpd") >= dpd)
    return (
        started.groupBy("mob")
        .agg(F.count(F.lit(1)).alias("loans"), F.sum(late).alias("bads"), F.avg(late).alias("bad_rate"))
        .orderBy("mob")
    )


def bads_at_installment(loans: DataFrame, started_before, installment: int = 10, dpd: int = 30) -> DataFrame:
    """Loans and past-due loans at one installment, by month, for loans started before a date."""
    reached = loans.where(
        (F.col("loan_start_date") < F.lit(started_before).cast("date")) & (F.col("installment_num") == installment)
    )
    late = flag(F.col("dpd") >= dpd)
    return reached.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("loans"), F.sum(late).alias("bads"))
