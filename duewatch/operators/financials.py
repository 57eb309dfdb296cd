"""Cleaning of the financial table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.functions import parsing
from duewatch.functions.numeric import flag, total

# Numeric columns with their type and upper limit.
NUMERIC_RULES = {
    "Annual_Income": ("double", None),
    "Monthly_Inhand_Salary": ("double", None),
    "Num_Bank_Accounts": ("int", 10),
    "Num_Credit_Card": ("int", 10),
    "Num_Credit_Inquiries": ("int", 200),
    "Interest_Rate": ("double", 33),
    "Num_of_Loan": ("int", 9),
    "Delay_from_due_date": ("int", 57),
    "Num_of_Delayed_Payment": ("int", 25),
    "Changed_Credit_Limit": ("double", None),
    "Outstanding_Debt": ("double", None),
    "Credit_Utilization_Ratio": ("double", None),
    "Total_EMI_per_month": ("double", None),
    "Amount_invested_monthly": ("double", None),
    "Monthly_Balance": ("double", None),
}
SPEND_WORDS = ["low_spent", "medium_spent", "high_spent"]
VALUE_WORDS = ["small_value", "medium_value", "large_value"]
KNOWN_LOANS = [
    "Auto Loan", "Credit-Builder Loan", "Debt Consolidation Loan", "Home Equity Loan",
    "Mortgage Loan", "Payday Loan", "Personal Loan", "Student Loan",
]


def numbers_cleaned() -> dict:
    return {name: parsing.stripped_number(F.col(name), kind, cap) for name, (kind, cap) in NUMERIC_RULES.items()}


def with_loan_indicators(df: DataFrame, items_col: str) -> DataFrame:
    """One 0/1 column per known loan type, and ``unseen`` when none of them is listed."""
    indicators = {loan: flag(F.array_contains(items_col, loan)) for loan in KNOWN_LOANS}
    marked = df.withColumns(indicators)
    none_known = total([F.col(f"`{loan}`") for loan in KNOWN_LOANS]) == 0
    return marked.withColumn("unseen", flag(none_known))


def loan_vocabulary(df: DataFrame, loan_col: str = "Type_of_Loan") -> DataFrame:
    """Sorted distinct loan types over the table."""
    items = F.explode(parsing.loan_item_words(F.col(loan_col)))
    return df.select(items.alias("loan_type")).distinct().orderBy("loan_type")


def clean_financials(raw: DataFrame) -> DataFrame:
    """Raw financial rows of any number of snapshots to the cleaned table."""
    behaviour = F.col("Payment_Behaviour")
    cleaned = raw.withColumns(
        {
            **numbers_cleaned(),
            "Credit_History_Months": parsing.history_months(F.col("Credit_History_Age")),
            "Spend_Level": parsing.keyword_level(behaviour, SPEND_WORDS),
            "Value_Level": parsing.keyword_level(behaviour, VALUE_WORDS),
            "Credit_Mix": parsing.clean_credit_mix(F.col("Credit_Mix")),
            "Payment_of_Min_Amount": parsing.yes_no(F.col("Payment_of_Min_Amount")),
            "_items": parsing.loan_items(F.col("Type_of_Loan")),
            "snapshot_date_str": parsing.dash_separated(F.col("snapshot_date")),
            "snapshot_date": parsing.flexible_date(F.col("snapshot_date")),
        }
    )
    return with_loan_indicators(cleaned, "_items").drop("_items")
