"""The gold feature table and the two model projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duewatch.functions.numeric import flag, ratio, row_variance, step_bucket, total
from duewatch.operators.financials import KNOWN_LOANS
from duewatch.operators.loans import with_numbers_filled
from duewatch.sources.schemas import CLICK_FEATURES

KEYS = ["Customer_ID", "snapshot_date"]

# Thresholds, job list and the columns the models use.
AGE_EDGES = [25, 40, 55]
DEBT_RATIO_EDGES = [0.3, 0.7, 1.0]
HIGH_DEBT_RATIO = 0.8
HIGH_INTEREST = 25
MANY_LOANS = 2
PROFESSIONAL_JOBS = [
    "Engineer", "Manager", "Analyst", "Lawyer", "Scientist", "Doctor", "Accountant", "Developer", "Architect",
]
BASE_FEATURES = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Interest_Rate", "Changed_Credit_Limit",
    "Num_Credit_Inquiries", "Outstanding_Debt", "Credit_Utilization_Ratio", "Monthly_Inhand_Salary", "Age",
    "Credit_History_Months", "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
    "Spend_Level", "Value_Level",
]
DERIVED_FEATURES = [
    "Debt_to_Income_Ratio", "Delayed_Payment_Rate", "EMI_to_Income_Ratio", "Investment_Rate",
    "Loan_Diversity_Score", "Click_Total", "Click_Mean", "Click_Variance", "Debt_to_Click_Ratio",
    "Income_to_Utilization", "Investment_to_Clicks", "Age_to_Credit_Age_Ratio", "EMI_to_Debt_Ratio",
    "Debt_to_Salary_Interaction", "Debt_Interest_Product", "Log_Debt", "Log_Income", "Credit_Utilization_Sq",
    "Credit_Utilization_Cube", "High_Risk_Flag", "High_Interest_Flag", "Has_Multiple_Loans", "Age_Bucket",
    "Debt_to_Income_Bin", "Min_Payment_Flag", "PMET_Job_Indicator", "Is_Year_End",
]
LINEAR_FEATURES = [*BASE_FEATURES, *KNOWN_LOANS, "unseen", *DERIVED_FEATURES]
FULL_FEATURES = [*BASE_FEATURES, *KNOWN_LOANS, "unseen", *CLICK_FEATURES, *DERIVED_FEATURES]

Expressions = dict[str, Column]


def joined_sources(attributes: DataFrame, financials: DataFrame, clicks: DataFrame) -> DataFrame:
    """Customer-months present in all three tables. One shuffle per table serves both joins."""
    return attributes.join(financials, KEYS).join(clicks, KEYS)


def joined_as_known(attributes: DataFrame, financials: DataFrame, clicks: DataFrame) -> DataFrame:
    """Click rows with the attribute and financial rows known by their month.

    The same rows as carrying both tables forward month by month and joining on
    customer and month, but neither table is multiplied: each shuffles once, on
    the customer, and the dates are compared inside the join.
    """
    known = attributes.withColumnRenamed("snapshot_date", "_attributes_from").join(
        financials.withColumnRenamed("snapshot_date", "_financials_from"), "Customer_ID"
    )
    since = F.greatest("_attributes_from", "_financials_from")
    both = known.where(F.col("_attributes_from").isNotNull() & F.col("_financials_from").isNotNull())
    return (
        both.withColumn("_since", since)
        .join(clicks, "Customer_ID")
        .where(F.col("_since") <= F.col("snapshot_date"))
        .drop("_attributes_from", "_financials_from", "_since")
    )


def ratio_features() -> Expressions:
    pairs = {
        "Debt_to_Income_Ratio": ("Outstanding_Debt", "Annual_Income"),
        "Delayed_Payment_Rate": ("Num_of_Delayed_Payment", "Num_of_Loan"),
        "EMI_to_Income_Ratio": ("Total_EMI_per_month", "Monthly_Inhand_Salary"),
        "Investment_Rate": ("Amount_invested_monthly", "Monthly_Inhand_Salary"),
    }
    return {name: ratio(F.col(top), F.col(bottom)) for name, (top, bottom) in pairs.items()}


def loan_diversity() -> Expressions:
    return {"Loan_Diversity_Score": total([F.col(f"`{name}`") for name in [*KNOWN_LOANS, "unseen"]])}


def click_total() -> Expressions:
    return {"Click_Total": total([F.col(name) for name in CLICK_FEATURES])}


def click_mean() -> Expressions:
    """Needs ``Click_Total``."""
    return {"Click_Mean": F.col("Click_Total") * F.lit(1.0 / len(CLICK_FEATURES))}


def click_variance() -> Expressions:
    """Population variance across the click columns. Needs ``Click_Mean``."""
    return {"Click_Variance": row_variance([F.col(name) for name in CLICK_FEATURES], F.col("Click_Mean"))}


def cross_features() -> Expressions:
    """Needs ``Click_Total``."""
    debt, salary = F.col("Outstanding_Debt"), F.col("Monthly_Inhand_Salary")
    clicks, emi = F.col("Click_Total"), F.col("Total_EMI_per_month")
    return {
        "Debt_to_Click_Ratio": ratio(debt, clicks + 1),
        "Income_to_Utilization": ratio(F.col("Annual_Income"), F.col("Credit_Utilization_Ratio") + 1),
        "Investment_to_Clicks": ratio(F.col("Amount_invested_monthly"), clicks + 1),
        "Age_to_Credit_Age_Ratio": ratio(F.col("Credit_History_Months"), F.col("Age") * 12),
        "EMI_to_Debt_Ratio": ratio(emi, debt + 1),
        "Debt_to_Salary_Interaction": ratio(debt, salary + 1),
        "Debt_Interest_Product": debt * F.col("Interest_Rate"),
    }


def curved_features() -> Expressions:
    used = F.col("Credit_Utilization_Ratio")
    return {
        "Log_Debt": F.log1p("Outstanding_Debt"),
        "Log_Income": F.log1p("Annual_Income"),
        "Credit_Utilization_Sq": used * used,
        "Credit_Utilization_Cube": used * used * used,
    }


def threshold_flags() -> Expressions:
    """Needs ``Debt_to_Income_Ratio``."""
    return {
        "High_Risk_Flag": flag(F.col("Debt_to_Income_Ratio") > HIGH_DEBT_RATIO),
        "High_Interest_Flag": flag(F.col("Interest_Rate") > HIGH_INTEREST),
        "Has_Multiple_Loans": flag(F.col("Num_of_Loan") > MANY_LOANS),
    }


def age_bucket() -> Expressions:
    return {"Age_Bucket": step_bucket(F.col("Age"), AGE_EDGES)}


def debt_ratio_bin() -> Expressions:
    """Needs ``Debt_to_Income_Ratio``."""
    return {"Debt_to_Income_Bin": step_bucket(F.col("Debt_to_Income_Ratio"), DEBT_RATIO_EDGES)}


def minimum_payment_flag() -> Expressions:
    codes = F.create_map(F.lit("Yes"), F.lit(1), F.lit("No"), F.lit(0))
    return {"Min_Payment_Flag": F.coalesce(F.try_element_at(codes, F.col("Payment_of_Min_Amount")), F.lit(-1))}


def job_indicator() -> Expressions:
    return {"PMET_Job_Indicator": flag(F.col("Occupation").isin(PROFESSIONAL_JOBS))}


def year_end_flag() -> Expressions:
    return {"Is_Year_End": flag(F.month("snapshot_date") == 12)}


def with_features(joined: DataFrame) -> DataFrame:
    """All derived features, in projections ordered by what they need.

    A value read many times gets a projection of its own: Spark keeps such
    projections apart instead of repeating the expression at each place.
    """
    first = {
        **ratio_features(), **loan_diversity(), **click_total(), **curved_features(), **age_bucket(),
        **minimum_payment_flag(), **job_indicator(), **year_end_flag(),
    }
    second = {**click_mean(), **cross_features(), **threshold_flags(), **debt_ratio_bin()}
    return joined.withColumns(first).withColumns(second).withColumns(click_variance())


def feature_store(joined: DataFrame) -> DataFrame:
    """The gold table from the joined sources. Gaps are filled last, so flags and bins see the gaps."""
    return with_numbers_filled(with_features(joined))


def model_table(store: DataFrame, features: list[str]) -> DataFrame:
    return store.select(*KEYS, *[F.col(f"`{name}`") for name in features])
