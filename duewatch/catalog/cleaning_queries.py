"""Cleaning steps of the four raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duewatch.catalog import views
from duewatch.catalog.inputs import Inputs, rounded
from duewatch.catalog.registry import query
from duewatch.functions import parsing
from duewatch.operators.customers import age_means, age_sums, ages_imputed, attributes_typed, click_means
from duewatch.operators.financials import (
    KNOWN_LOANS,
    NUMERIC_RULES,
    SPEND_WORDS,
    VALUE_WORDS,
    clean_financials,
    loan_vocabulary,
    numbers_cleaned,
)
from duewatch.operators.loans import (
    typed,
    with_installments_missed,
    with_months_on_book,
    with_numbers_filled,
)
from duewatch.operators.lookups import with_summary
from duewatch.sources.schemas import CLICK_FEATURES, LOAN_TYPES


@query("SELECT loan_id, installment_num, installment_num AS mob FROM raw_loans")
def loan_mob(inputs: Inputs) -> DataFrame:
    return with_months_on_book(inputs.raw("raw_loans")).select("loan_id", "installment_num", "mob")


@query("SELECT loan_id, installments_missed FROM silver_loans")
def loan_installments_missed(inputs: Inputs) -> DataFrame:
    return with_installments_missed(inputs.raw("raw_loans")).select("loan_id", "installments_missed")


@query("SELECT loan_id, tenure, installment_num, mob, installments_missed, round(loan_amt, 4) AS loan_amt, "
       "round(due_amt, 4) AS due_amt, round(paid_amt, 4) AS paid_amt, round(overdue_amt, 4) AS overdue_amt, "
       "round(balance, 4) AS balance FROM silver_loans")
def loan_fill_zero(inputs: Inputs) -> DataFrame:
    loans = with_installments_missed(with_months_on_book(typed(inputs.raw("raw_loans"), LOAN_TYPES)))
    return rounded(with_numbers_filled(loans), 4).drop("Customer_ID", "loan_start_date", "snapshot_date")


@query("SELECT loan_id, snapshot_date, installments_missed, first_missed_date FROM silver_loans")
def loan_first_missed_date(inputs: Inputs) -> DataFrame:
    return inputs.loans().select("loan_id", "snapshot_date", "installments_missed", "first_missed_date")


@query("SELECT loan_id, snapshot_date, mob, first_missed_date, dpd FROM silver_loans")
def loan_dpd(inputs: Inputs) -> DataFrame:
    return inputs.loans().select("loan_id", "snapshot_date", "mob", "first_missed_date", "dpd")


@query("SELECT Customer_ID, SSN FROM typed_attributes")
def attr_ssn_mask(inputs: Inputs) -> DataFrame:
    return inputs.raw("raw_attributes").select("Customer_ID", parsing.masked_ssn(F.col("SSN")).alias("SSN"))


@query("SELECT Customer_ID, Occupation FROM typed_attributes")
def attr_occupation(inputs: Inputs) -> DataFrame:
    return inputs.raw("raw_attributes").select(
        "Customer_ID", parsing.clean_occupation(F.col("Occupation")).alias("Occupation")
    )


@query("SELECT Customer_ID, CAST(trunc(TRY_CAST(Age AS DOUBLE)) AS DOUBLE) AS as_read, "
       "TRY_CAST(trim(Age, '_') AS DOUBLE) AS repaired FROM raw_attributes")
def attr_age_parse(inputs: Inputs) -> DataFrame:
    age = F.col("Age")
    return inputs.raw("raw_attributes").select(
        "Customer_ID", parsing.parsed_age(age).alias("as_read"), parsing.parsed_age(age, repair=True).alias("repaired")
    )


@query("SELECT Customer_ID, Age, Occupation, snapshot_date FROM raw_attributes_filled")
def attr_age_impute(inputs: Inputs) -> DataFrame:
    return ages_imputed(attributes_typed(inputs.raw("raw_attributes"))).select(
        "Customer_ID", "Age", "Occupation", "snapshot_date"
    )


@query("SELECT snapshot_date, Occupation, round(avg(Age), 6) AS mean_age FROM typed_attributes WHERE Age BETWEEN 0 AND 100 GROUP BY 1, 2")
def agg_group_mean_filtered(inputs: Inputs) -> DataFrame:
    means = age_means(age_sums(attributes_typed(inputs.raw("raw_attributes"))))
    return rounded(means.withColumnRenamed("_mean_age", "mean_age"))


@query("SELECT Customer_ID, Occupation, Age, mean_age FROM typed_attributes t LEFT JOIN means m USING (snapshot_date, Occupation)",
       means="SELECT snapshot_date, Occupation, round(avg(Age), 6) AS mean_age FROM typed_attributes WHERE Age BETWEEN 0 AND 100 GROUP BY 1, 2")
def join_left_groupstat(inputs: Inputs) -> DataFrame:
    """Every customer with the mean age of the group."""
    customers = attributes_typed(inputs.raw("raw_attributes"))
    means = age_means(age_sums(customers)).withColumnRenamed("_mean_age", "mean_age")
    joined = with_summary(customers, means, ["snapshot_date", "Occupation"], "age-means")
    return rounded(joined.select("Customer_ID", "Occupation", "Age", "mean_age"))


@query(f"SELECT snapshot_date, {', '.join(f'round(avg({name}), 6) AS _mean_{name}' for name in CLICK_FEATURES)} FROM raw_clicks GROUP BY snapshot_date")
def agg_multi_col_mean(inputs: Inputs) -> DataFrame:
    return rounded(click_means(inputs.raw("raw_clicks")))


@query(f"SELECT Customer_ID, snapshot_date, {', '.join(CLICK_FEATURES)} FROM silver_clicks")
def click_mean_impute(inputs: Inputs) -> DataFrame:
    return inputs.silver_clicks()


@query(f"SELECT Customer_ID, {views.NUMBER_SQL} FROM raw_financials")
def fin_numeric_clean(inputs: Inputs) -> DataFrame:
    return inputs.raw("raw_financials").withColumns(numbers_cleaned()).select("Customer_ID", *NUMERIC_RULES)


@query(f"SELECT Customer_ID, {views.HISTORY_SQL} FROM raw_financials")
def fin_credit_history_months(inputs: Inputs) -> DataFrame:
    months = parsing.history_months(F.col("Credit_History_Age"))
    return inputs.raw("raw_financials").select("Customer_ID", months.alias("Credit_History_Months"))


@query(f"SELECT Customer_ID, {views.SPEND_SQL} FROM raw_financials")
def fin_spend_level(inputs: Inputs) -> DataFrame:
    level = parsing.keyword_level(F.col("Payment_Behaviour"), SPEND_WORDS)
    return inputs.raw("raw_financials").select("Customer_ID", level.alias("Spend_Level"))


@query(f"SELECT Customer_ID, {views.VALUE_SQL} FROM raw_financials")
def fin_value_level(inputs: Inputs) -> DataFrame:
    level = parsing.keyword_level(F.col("Payment_Behaviour"), VALUE_WORDS)
    return inputs.raw("raw_financials").select("Customer_ID", level.alias("Value_Level"))


@query(f"SELECT Customer_ID, {views.CREDIT_MIX_SQL} FROM raw_financials")
def fin_credit_mix(inputs: Inputs) -> DataFrame:
    return inputs.raw("raw_financials").select(
        "Customer_ID", parsing.clean_credit_mix(F.col("Credit_Mix")).alias("Credit_Mix")
    )


@query(f"SELECT Customer_ID, {views.MIN_AMOUNT_SQL} FROM raw_financials")
def fin_min_amount(inputs: Inputs) -> DataFrame:
    answer = parsing.yes_no(F.col("Payment_of_Min_Amount"))
    return inputs.raw("raw_financials").select("Customer_ID", answer.alias("Payment_of_Min_Amount"))


@query("SELECT Customer_ID, CAST(row_number() OVER (PARTITION BY Customer_ID ORDER BY place) - 1 AS INT) AS position, item AS loan_type FROM loan_items")
def fin_loan_list(inputs: Inputs) -> DataFrame:
    items = parsing.loan_items(F.col("Type_of_Loan"))
    return inputs.raw("raw_financials").select("Customer_ID", F.posexplode(items).alias("position", "loan_type"))


WORD_ITEMS_SQL = r"""
SELECT DISTINCT Customer_ID, trim(item) AS loan_type
FROM (SELECT Customer_ID, unnest(string_split(regexp_replace(Type_of_Loan, '\band\b', ',', 'g'), ',')) AS item
      FROM raw_financials) s
WHERE trim(item) <> '' AND lower(trim(item)) <> 'not specified'
"""


@query("SELECT Customer_ID, loan_type FROM word_items", word_items=WORD_ITEMS_SQL)
def fin_loan_list_words(inputs: Inputs) -> DataFrame:
    items = parsing.loan_item_words(F.col("Type_of_Loan"))
    return inputs.raw("raw_financials").select("Customer_ID", F.explode(items).alias("loan_type"))


@query("SELECT DISTINCT loan_type FROM word_items ORDER BY loan_type", word_items=WORD_ITEMS_SQL)
def fin_loan_vocabulary(inputs: Inputs) -> DataFrame:
    return loan_vocabulary(inputs.raw("raw_financials"))


@query("SELECT Customer_ID, {} FROM loan_flags".format(", ".join(f'"{name}"' for name in KNOWN_LOANS)))
def fin_loan_onehot(inputs: Inputs) -> DataFrame:
    return clean_financials(inputs.raw("raw_financials")).select("Customer_ID", *KNOWN_LOANS)


@query("SELECT Customer_ID, unseen FROM loan_flags")
def fin_unseen(inputs: Inputs) -> DataFrame:
    return clean_financials(inputs.raw("raw_financials")).select("Customer_ID", "unseen")


@query(f"SELECT Customer_ID, {views.DATE_TEXT_SQL} AS snapshot_date_str, {views.DATE_SQL} FROM raw_financials")
def fin_date_parse(inputs: Inputs) -> DataFrame:
    text = F.col("snapshot_date")
    return inputs.raw("raw_financials").select(
        "Customer_ID",
        parsing.dash_separated(text).alias("snapshot_date_str"),
        parsing.flexible_date(text).alias("snapshot_date"),
    )
