"""Rules for dirty values, on rows made for them."""

import datetime

import pytest
from pyspark.sql import functions as F

from duewatch.functions import parsing
from duewatch.operators.customers import ages_imputed, attributes_typed, clean_attributes, clean_clicks
from duewatch.operators.features import feature_store, joined_as_known, joined_sources, model_table, FULL_FEATURES, LINEAR_FEATURES
from duewatch.operators.financials import KNOWN_LOANS, clean_financials
from duewatch.operators.loans import default_labels, loan_status
from duewatch.operators.months import latest_known, restamped, run_months
from duewatch.sources import schemas

DAY = datetime.date


def single(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [("28", 28.0), (" 28 ", 28.0), ("28_", None), ("-500", -500.0), ("x", None), (None, None), ("3.9", 3.0)],
)
def test_age_as_read(spark, value, expected):
    assert single(spark, value, parsing.parsed_age) == expected


@pytest.mark.parametrize("value, expected", [("28_", 28.0), ("__28_", 28.0), (" 31 ", 31.0), ("a", None)])
def test_age_repaired(spark, value, expected):
    assert single(spark, value, lambda v: parsing.parsed_age(v, repair=True)) == expected


@pytest.mark.parametrize(
    "value, kind, cap, expected",
    [
        ("-3.5", "double", None, 3.5), ("1.0E7", "double", None, 1.07), ("12_", "int", 9, 9), ("4.0", "int", 9, 4),
        ("_", "double", None, None), ("1.2.3", "double", None, None), (None, "int", 5, None), ("99", "double", 33, 33.0),
    ],
)
def test_stripped_number(spark, value, kind, cap, expected):
    assert single(spark, value, lambda v: parsing.stripped_number(v, kind, cap)) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2023-01-31", DAY(2023, 1, 31)), ("31/01/2023", DAY(2023, 1, 31)), ("01.02.2023", DAY(2023, 2, 1)),
        ("01-31-2023", DAY(2023, 1, 31)), ("2023/02/03", DAY(2023, 2, 3)), ("unknown", None), (None, None),
    ],
)
def test_flexible_date(spark, value, expected):
    assert single(spark, value, parsing.flexible_date) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("3 Years and 2 Months", 38), ("5 Years", 60), ("NA", 0), ("", 0), (None, None), ("0 Years and 11 Months", 11)],
)
def test_history_months(spark, value, expected):
    assert single(spark, value, parsing.history_months) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Auto Loan, and Student Loan", ["Auto Loan", "Student Loan"]),
        ("Standard Loan", ["St", "ard Loan"]),
        ("Not Specified, Payday Loan", ["Payday Loan"]),
        (None, None),
    ],
)
def test_loan_items(spark, value, expected):
    assert single(spark, value, parsing.loan_items) == expected


def test_loan_item_words(spark):
    text = "Standard Loan, not specified, Auto Loan and Auto Loan"
    assert single(spark, text, parsing.loan_item_words) == ["Auto Loan", "Standard Loan"]
    assert single(spark, None, parsing.loan_item_words) == []


@pytest.mark.parametrize("value, expected", [("___a b__", "a b"), ("____", "___"), (None, "___"), ("", "___")])
def test_occupation(spark, value, expected):
    assert single(spark, value, parsing.clean_occupation) == expected


@pytest.mark.parametrize("value, expected", [("123-45-6789", "123-45-6789"), ("#F%$", "___"), (None, "___")])
def test_ssn(spark, value, expected):
    assert single(spark, value, parsing.masked_ssn) == expected


def loan(**values):
    row = {
        "loan_id": "L1", "Customer_ID": "C1", "loan_start_date": "2023-01-01", "tenure": "10", "installment_num": "6",
        "loan_amt": "1000", "due_amt": "100", "paid_amt": "0", "overdue_amt": "0", "balance": "400",
        "snapshot_date": "2023-07-01",
    }
    row.update(values)
    return tuple(row[name] for name in schemas.LOAN_COLUMNS)


def loans(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.text_schema(schemas.LOAN_COLUMNS))


def test_overdue_loan(spark):
    row = loan_status(loans(spark, loan(overdue_amt="150"))).first()
    assert (row.mob, row.installments_missed, row.first_missed_date, row.dpd) == (6, 2, DAY(2023, 5, 1), 61)


def test_overdue_without_due_amount_has_no_label(spark):
    status = loan_status(loans(spark, loan(overdue_amt="150", due_amt="0")))
    assert status.first().dpd is None
    assert default_labels(status).first().label == 0


def test_gaps_in_loans_become_zero(spark):
    row = loan_status(loans(spark, loan(due_amt=None, overdue_amt=None, balance="?", tenure=None, installment_num="x"))).first()
    assert (row.due_amt, row.overdue_amt, row.balance, row.tenure, row.mob, row.dpd) == (0.0, 0.0, 0.0, 0, 0, 0)


def test_month_end_is_clamped(spark):
    row = loan_status(loans(spark, loan(overdue_amt="100", snapshot_date="2023-03-31"))).first()
    assert row.first_missed_date == DAY(2023, 2, 28)


def test_label_definition(spark):
    labels = default_labels(loan_status(loans(spark, loan(overdue_amt="100"), loan(installment_num="5"))), dpd=31, mob=6)
    assert [tuple(row) for row in labels.collect()] == [("L1", "C1", 0, "31dpd_6mob", DAY(2023, 7, 1))]


def test_ages(spark):
    rows = [("A", "n", age, "s", "Job", "2023-01-01") for age in ("20", "41", "28_", "300", None)]
    rows.append(("B", "n", "-1", "s", "Other", "2023-01-01"))
    raw = spark.createDataFrame(rows, schemas.text_schema(schemas.ATTRIBUTE_COLUMNS))
    ages = [row.Age for row in clean_attributes(raw).collect() if row.Customer_ID == "A"]
    assert sorted(ages) == [20, 31, 31, 31, 41]  # the mean 30.5 is rounded up
    assert clean_attributes(raw).where("Customer_ID = 'B'").first().Age is None


def clicks(spark, *rows):
    filler = [None] * (len(schemas.CLICK_FEATURES) - 1)
    data = [(customer, month, value, *filler) for customer, month, value in rows]
    return spark.createDataFrame(data, schemas.text_schema(schemas.CLICK_COLUMNS))


def test_click_means_are_cut_per_month(spark):
    raw = clicks(spark, ("A", "2023-01-01", "2"), ("B", "2023-01-01", "3"), ("C", "2023-01-01", None), ("D", "2023-02-01", None))
    found = {row.Customer_ID: (row.fe_1, row.fe_2) for row in clean_clicks(raw).collect()}
    assert found == {"A": (2, None), "B": (3, None), "C": (2, None), "D": (None, None)}
    exact = {row.Customer_ID: row.fe_1 for row in clean_clicks(raw, truncate=False).collect()}
    assert exact["C"] == 2.5


def test_restamped_carries_every_known_row(spark):
    raw = spark.createDataFrame([("A", 1, DAY(2023, 1, 15)), ("A", 2, DAY(2023, 3, 1)), ("B", 3, None)], "id string, v int, snapshot_date date")
    rows = sorted((r.id, r.v, r.snapshot_date.month) for r in restamped(raw, "2023-01-01", "2023-04-01").collect())
    assert rows == [("A", 1, 2), ("A", 1, 3), ("A", 1, 4), ("A", 2, 3), ("A", 2, 4)]


def test_latest_known_keeps_one_row(spark):
    data = [("A", 1, DAY(2022, 6, 1)), ("A", 2, DAY(2022, 7, 1)), ("A", 9, DAY(2023, 3, 2)), ("A", 7, DAY(2023, 3, 2)), ("B", 3, DAY(2024, 1, 1))]
    raw = spark.createDataFrame(data, "id string, v int, snapshot_date date")
    rows = sorted((r.id, r.v, r.snapshot_date.month) for r in latest_known(raw, "id", "2023-02-01", "2023-05-01").collect())
    assert rows == [("A", 2, 2), ("A", 2, 3), ("A", 9, 4), ("A", 9, 5)]


def test_run_months(spark):
    runs = spark.createDataFrame([(1, True, DAY(2024, 12, 1)), (2, False, DAY(2024, 12, 1)), (3, True, DAY(2024, 10, 1))], "id int, is_manual boolean, target_date date")
    found = {}
    for row in run_months(runs, "2024-10-01").collect():
        found.setdefault(row.id, []).append(row.run_month.month)
    assert {key: sorted(value) for key, value in found.items()} == {1: [10, 11, 12], 2: [12], 3: [10]}


def financial(**values):
    row = dict.fromkeys(schemas.FINANCIAL_COLUMNS)
    row.update({"Customer_ID": "A", "snapshot_date": "2023-01-01", "Payment_Behaviour": "High_spent_Small_value_payments"}, **values)
    return tuple(row[name] for name in schemas.FINANCIAL_COLUMNS)


def test_financial_gaps_and_features(spark):
    text = schemas.text_schema(schemas.FINANCIAL_COLUMNS)
    money = clean_financials(spark.createDataFrame([financial(Annual_Income="0", Outstanding_Debt="50", Num_of_Loan="0", Num_of_Delayed_Payment="3")], text))
    row = money.first()
    assert (row.Spend_Level, row.Value_Level, row.Credit_Mix, row.Payment_of_Min_Amount, row.unseen) == (3, 1, "Unknown", "Unknown", 1)
    assert [row[name] for name in KNOWN_LOANS] == [0] * 8
    people = clean_attributes(spark.createDataFrame([("A", "n", "x", "s", "Engineer", "2023-01-01")], schemas.text_schema(schemas.ATTRIBUTE_COLUMNS)))
    store = feature_store(joined_sources(people, money, clean_clicks(clicks(spark, ("A", "2023-01-01", "4")))))
    gold = store.first()
    # Ratios without a divisor are 0 in the end, while the bins and buckets saw the gap.
    assert (gold.Debt_to_Income_Ratio, gold.Delayed_Payment_Rate, gold.Debt_to_Income_Bin, gold.High_Risk_Flag) == (0.0, 0.0, 3, 0)
    assert (gold.Age, gold.Age_Bucket, gold.PMET_Job_Indicator, gold.Min_Payment_Flag, gold.Is_Year_End) == (0, 3, 1, -1, 0)
    assert gold.Click_Total == 0 and gold.fe_1 == 4  # the other nineteen counts are unknown
    assert len(model_table(store, FULL_FEATURES).columns) == 74
    assert len(model_table(store, LINEAR_FEATURES).columns) == 54


def test_both_gold_joins_agree_with_several_rows_per_customer(spark):
    first, last = "2023-01-01", "2023-04-01"
    people = spark.createDataFrame(
        [("A", 1, DAY(2023, 1, 1)), ("A", 2, DAY(2023, 2, 10)), ("B", 3, DAY(2023, 3, 1)), ("C", 4, None)], "Customer_ID string, p int, snapshot_date date")
    money = spark.createDataFrame(
        [("A", 10, DAY(2022, 1, 1)), ("A", 20, DAY(2023, 4, 1)), ("B", 30, DAY(2023, 1, 1)), ("C", 40, DAY(2023, 1, 1))], "Customer_ID string, m int, snapshot_date date")
    months = [DAY(2023, n, 1) for n in range(1, 5)]
    clicked = spark.createDataFrame([(c, 5, m) for c in "ABC" for m in months], "Customer_ID string, c int, snapshot_date date")
    columns = ["Customer_ID", "p", "m", "c", "snapshot_date"]
    carried = joined_sources(restamped(people, first, last), restamped(money, first, last), clicked).select(columns)
    direct = joined_as_known(people, money, clicked).select(columns)
    assert sorted(map(tuple, carried.collect())) == sorted(map(tuple, direct.collect()))
    assert direct.count() == 10


def test_carried_age_sums_give_the_same_ages(spark):
    from duewatch.operators.customers import age_sums

    rows = [(f"C{n}", "n", str(age), "s", "Job", f"2023-0{1 + n % 3}-01") for n, age in enumerate([20, 30, 41, -5, 200, 50, 61])]
    typed = attributes_typed(spark.createDataFrame(rows, schemas.text_schema(schemas.ATTRIBUTE_COLUMNS)))
    carried = restamped(typed, "2023-01-01", "2023-03-01")
    direct = ages_imputed(carried)
    from_sums = ages_imputed(carried, restamped(age_sums(typed), "2023-01-01", "2023-03-01"))
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, from_sums.collect()))
