"""Labels and features of the gold layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.catalog.inputs import Inputs, rounded
from duewatch.catalog.registry import query
from duewatch.catalog.views import WHOLE_FEATURES, feature_sql
from duewatch.operators import features
from duewatch.operators.features import KEYS
from duewatch.operators.loans import with_numbers_filled


@query("SELECT loan_id, Customer_ID, label, label_def, snapshot_date FROM gold_labels")
def gold_label(inputs: Inputs) -> DataFrame:
    return inputs.labels()


@query("SELECT * FROM gold_joined")
def gold_join(inputs: Inputs) -> DataFrame:
    """All cleaned columns of the three sources as known by each click month; no row is carried to months before the join."""
    return inputs.joined().drop("Credit_History_Age", "Payment_Behaviour", "Type_of_Loan")


def derived(inputs: Inputs, *steps: dict) -> DataFrame:
    """The joined sources with some features; later steps may use earlier ones."""
    table = inputs.joined()
    for step in steps:
        table = table.withColumns(step)
    names = list(steps[-1])
    kinds = [F.col(name).cast("int") if name in WHOLE_FEATURES else F.col(name) for name in names]
    return rounded(table.select(*KEYS, *[kind.alias(name) for kind, name in zip(kinds, names)]))


def feature_check(*names: str) -> str:
    return f"SELECT Customer_ID, snapshot_date, {feature_sql(list(names))} FROM gold_joined"


@query(feature_check("Debt_to_Income_Ratio", "Delayed_Payment_Rate", "EMI_to_Income_Ratio", "Investment_Rate"))
def feat_ratios(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.ratio_features())


@query(feature_check("Loan_Diversity_Score"))
def feat_loan_diversity(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.loan_diversity())


@query(feature_check("Click_Total"))
def feat_click_total(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.click_total())


@query(feature_check("Click_Mean"))
def feat_click_mean(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.click_total(), features.click_mean())


@query(feature_check("Click_Variance"))
def feat_click_variance(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.click_total(), features.click_mean(), features.click_variance())


@query(feature_check("Debt_to_Click_Ratio", "Income_to_Utilization", "Investment_to_Clicks", "Age_to_Credit_Age_Ratio",
                     "EMI_to_Debt_Ratio", "Debt_to_Salary_Interaction", "Debt_Interest_Product"))
def feat_cross(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.click_total(), features.cross_features())


@query(feature_check("Log_Debt", "Log_Income", "Credit_Utilization_Sq", "Credit_Utilization_Cube"))
def feat_nonlinear(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.curved_features())


@query(feature_check("High_Risk_Flag", "High_Interest_Flag", "Has_Multiple_Loans"))
def feat_flags(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.ratio_features(), features.threshold_flags())


@query(feature_check("Age_Bucket"))
def feat_age_bucket(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.age_bucket())


@query(feature_check("Debt_to_Income_Bin"))
def feat_dti_bin(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.ratio_features(), features.debt_ratio_bin())


@query(feature_check("Min_Payment_Flag"))
def feat_min_payment_flag(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.minimum_payment_flag())


@query(feature_check("PMET_Job_Indicator"))
def feat_job_indicator(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.job_indicator())


@query(feature_check("Is_Year_End"))
def feat_year_end(inputs: Inputs) -> DataFrame:
    return derived(inputs, features.year_end_flag())


NUMERIC_JOINED = ["Age", "Changed_Credit_Limit", "Credit_History_Months", "Debt_to_Income_Ratio", "Delayed_Payment_Rate",
                  "Age_to_Credit_Age_Ratio", "Investment_Rate", "Click_Total"]


@query(f"SELECT Customer_ID, snapshot_date, Occupation, {feature_sql(NUMERIC_JOINED, filled=True)} FROM gold_joined")
def gold_numeric_fill(inputs: Inputs) -> DataFrame:
    filled = with_numbers_filled(features.with_features(inputs.joined()))
    return rounded(filled.select(*KEYS, "Occupation", *NUMERIC_JOINED))
