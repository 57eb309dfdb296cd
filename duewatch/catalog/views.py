"""The pipeline's inputs derived from the given tables, and the SQL the results are checked with.

``RAW_VIEWS`` run unchanged in Spark and in DuckDB; ``{name}`` stands for a given
table. ``CHECK_VIEWS`` restate the cleaning and feature steps for DuckDB only.
"""

from __future__ import annotations

import re

from duewatch.sources.schemas import CLICK_FEATURES

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
FIRST_MONTH, LAST_MONTH = "1995-01-01", "2001-08-01"

RAW_LOANS = """
SELECT concat('LN_', CAST(o.o_orderkey AS STRING), '_', CAST(li.l_linenumber AS STRING)) AS loan_id,
       concat('CUS_', CAST(o.o_custkey AS STRING)) AS Customer_ID,
       CAST(o.o_orderdate AS DATE) AS loan_start_date,
       10 AS tenure,
       li.l_linenumber AS installment_num,
       o.o_totalprice AS loan_amt,
       CASE WHEN o.o_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE o.o_totalprice / CAST(10 AS DOUBLE) END AS due_amt,
       CASE WHEN li.late_qty = 0 THEN o.o_totalprice / CAST(10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS paid_amt,
       CASE WHEN o.o_orderkey % 61 = 0 THEN CAST(NULL AS DOUBLE)
            ELSE o.o_totalprice / CAST(10 AS DOUBLE) * (li.late_qty / CAST(25 AS DOUBLE)) END AS overdue_amt,
       CASE WHEN o.o_orderkey % 53 = 0 THEN CAST(NULL AS DOUBLE)
            ELSE o.o_totalprice - o.o_totalprice / CAST(10 AS DOUBLE) * li.l_linenumber END AS balance,
       make_date(CAST(floor((year(o.o_orderdate) * 12 + month(o.o_orderdate) - 1 + li.l_linenumber) / CAST(12 AS DOUBLE)) AS INT),
                 CAST((year(o.o_orderdate) * 12 + month(o.o_orderdate) - 1 + li.l_linenumber) % 12 + 1 AS INT), 1) AS snapshot_date
FROM (SELECT l_orderkey, l_linenumber,
             SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE CAST(0 AS DOUBLE) END) AS late_qty
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber) li
JOIN {orders} o ON o.o_orderkey = li.l_orderkey
"""

RAW_ATTRIBUTES = """
SELECT concat('CUS_', CAST(c_custkey AS STRING)) AS Customer_ID,
       c_name AS Name,
       CASE WHEN c_custkey % 17 = 0 THEN concat(CAST(18 + c_custkey % 60 AS STRING), '_')
            WHEN c_custkey % 23 = 0 THEN '-500'
            WHEN c_custkey % 29 = 0 THEN '3452'
            WHEN c_custkey % 31 = 0 THEN concat(CAST(18 + c_custkey % 60 AS STRING), '.7')
            ELSE CAST(18 + c_custkey % 60 AS STRING) END AS Age,
       CASE WHEN c_custkey % 13 = 0 THEN '#F%$D@*&8'
            ELSE concat(lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), '-',
                        lpad(CAST(c_custkey % 100 AS STRING), 2, '0'), '-',
                        lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) END AS SSN,
       CASE WHEN c_custkey % 11 = 0 THEN '_______'
            WHEN c_custkey % 7 = 0 THEN concat('__', c_mktsegment, '_')
            WHEN c_custkey % 9 = 0 THEN 'Engineer'
            ELSE c_mktsegment END AS Occupation,
       make_date(CAST(1995 + c_custkey % 3 AS INT), CAST(1 + c_custkey % 12 AS INT), 1) AS snapshot_date
FROM {customer}
"""

ATTRIBUTE_HISTORY = """
SELECT concat('CUS_', CAST(o_custkey AS STRING)) AS Customer_ID,
       o_orderpriority AS Occupation,
       CAST(18 + max(o_orderkey) % 60 AS INT) AS Age,
       CAST(min(o_orderdate) AS DATE) AS snapshot_date
FROM {orders} GROUP BY o_custkey, o_orderpriority
"""


def _click_column(place: int) -> str:
    week, kind = divmod(place, len(EVENT_TYPES))
    return (
        f"CAST(SUM(CASE WHEN event_type = '{EVENT_TYPES[kind]}' AND week_number = {week} "
        f"THEN CAST(round(value) AS BIGINT) END) AS INT) AS {CLICK_FEATURES[place]}"
    )


# Events carry one month only, so their number spreads them over the 80 loan months.
RAW_CLICKS = f"""
SELECT concat('CUS_', CAST(user_id AS STRING)) AS Customer_ID, snapshot_date,
       {", ".join(_click_column(place) for place in range(len(CLICK_FEATURES)))}
FROM (SELECT user_id, event_type, value,
             CASE WHEN day(ts) > 28 THEN 3 ELSE CAST(floor((day(ts) - 1) / CAST(7 AS DOUBLE)) AS INT) END AS week_number,
             make_date(CAST(1995 + floor((event_id % 80) / CAST(12 AS DOUBLE)) AS INT),
                       CAST(1 + (event_id % 80) % 12 AS INT), 1) AS snapshot_date
      FROM {{events}}) e
GROUP BY user_id, snapshot_date
"""

RAW_FINANCIALS = """
SELECT concat('CUS_', CAST(c.c_custkey AS STRING)) AS Customer_ID,
       concat(CAST(CAST(floor(c.c_acctbal) AS BIGINT) * 12 AS STRING), CASE WHEN c.c_custkey % 9 = 0 THEN '_' ELSE '' END) AS Annual_Income,
       CASE WHEN c.c_custkey % 37 = 0 THEN '1.0E7' ELSE CAST(CAST(floor(c.c_acctbal) AS BIGINT) AS STRING) END AS Monthly_Inhand_Salary,
       CAST(c.c_custkey % 14 AS STRING) AS Num_Bank_Accounts,
       CAST(c.c_custkey % 12 AS STRING) AS Num_Credit_Card,
       CAST(c.c_custkey % 40 AS STRING) AS Interest_Rate,
       concat(CAST(o.n_orders AS STRING), CASE WHEN c.c_custkey % 6 = 0 THEN '_' ELSE '' END) AS Num_of_Loan,
       NULLIF(concat_ws(', ', CASE WHEN c.c_custkey % 2 = 0 THEN 'Auto Loan' END,
                       CASE WHEN c.c_custkey % 3 = 0 THEN 'Payday Loan' END,
                       CASE WHEN c.c_custkey % 7 = 0 THEN 'Not Specified' END,
                       CASE WHEN c.c_custkey % 19 = 0 THEN 'Standby Loan' END,
                       CASE WHEN c.c_custkey % 11 = 0 THEN 'Auto Loan' END,
                       CASE WHEN c.c_custkey % 13 = 0 THEN 'Credit-Builder Loan' END,
                       CASE WHEN c.c_custkey % 5 = 0 THEN 'and Student Loan' END), '') AS Type_of_Loan,
       CAST(c.c_custkey % 70 - 5 AS STRING) AS Delay_from_due_date,
       concat(CAST(o.n_late AS STRING), CASE WHEN c.c_custkey % 8 = 0 THEN '_' ELSE '' END) AS Num_of_Delayed_Payment,
       CASE WHEN c.c_custkey % 10 = 0 THEN '_' ELSE concat('-', CAST(c.c_custkey % 25 AS STRING), '.5') END AS Changed_Credit_Limit,
       CAST(c.c_custkey % 250 AS STRING) AS Num_Credit_Inquiries,
       CASE c.c_custkey % 5 WHEN 0 THEN '_' WHEN 1 THEN 'GOOD' WHEN 2 THEN 'standard' WHEN 3 THEN 'NaN' ELSE NULL END AS Credit_Mix,
       CAST(o.debt AS STRING) AS Outstanding_Debt,
       CAST(20 + c.c_custkey % 30 AS STRING) AS Credit_Utilization_Ratio,
       CASE WHEN c.c_custkey % 16 = 0 THEN 'NA' WHEN c.c_custkey % 41 = 0 THEN NULL
            ELSE concat(CAST(c.c_custkey % 30 AS STRING), ' Years and ', CAST(c.c_custkey % 12 AS STRING), ' Months') END AS Credit_History_Age,
       CASE c.c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END AS Payment_of_Min_Amount,
       CAST(c.c_custkey % 500 AS STRING) AS Total_EMI_per_month,
       concat(CASE WHEN c.c_custkey % 20 = 0 THEN '__' ELSE '' END, CAST(c.c_custkey % 1000 AS STRING)) AS Amount_invested_monthly,
       CASE c.c_custkey % 4 WHEN 0 THEN 'Low_spent_Small_value_payments' WHEN 1 THEN 'High_spent_Large_value_payments'
                            WHEN 2 THEN 'High_spent_Medium_value_payments' ELSE '!@9#%8' END AS Payment_Behaviour,
       CAST(c.c_custkey % 700 AS STRING) AS Monthly_Balance,
       CASE c.c_custkey % 5
            WHEN 0 THEN concat(CAST(1995 + c.c_custkey % 3 AS STRING), '-', lpad(CAST(1 + c.c_custkey % 12 AS STRING), 2, '0'), '-01')
            WHEN 1 THEN concat('01/', lpad(CAST(1 + c.c_custkey % 12 AS STRING), 2, '0'), '/', CAST(1995 + c.c_custkey % 3 AS STRING))
            WHEN 2 THEN concat(lpad(CAST(1 + c.c_custkey % 12 AS STRING), 2, '0'), '-', CAST(13 + c.c_custkey % 15 AS STRING), '-', CAST(1995 + c.c_custkey % 3 AS STRING))
            WHEN 3 THEN concat(CAST(1995 + c.c_custkey % 3 AS STRING), '.', lpad(CAST(1 + c.c_custkey % 12 AS STRING), 2, '0'), '.01')
            ELSE CASE WHEN c.c_custkey % 43 = 0 THEN 'unknown'
                      ELSE concat(CAST(13 + c.c_custkey % 15 AS STRING), '.', lpad(CAST(1 + c.c_custkey % 12 AS STRING), 2, '0'), '.', CAST(1995 + c.c_custkey % 3 AS STRING)) END
       END AS snapshot_date
FROM {customer} c
JOIN (SELECT o_custkey, count(*) AS n_orders,
             count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_late,
             CAST(floor(max(o_totalprice)) AS BIGINT) AS debt
      FROM {orders} GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
"""

# Scored rows: an order's price as its score, finished orders as bad ones.
SCORED_ORDERS = """
SELECT concat('CUS_', CAST(o_custkey AS STRING)) AS Customer_ID,
       make_date(year(o_orderdate), month(o_orderdate), 1) AS snapshot_date,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
       o_totalprice / CAST(1000000 AS DOUBLE) AS default_probability
FROM {orders}
"""

RAW_VIEWS = {
    "raw_loans": RAW_LOANS,
    "raw_attributes": RAW_ATTRIBUTES,
    "attribute_history": ATTRIBUTE_HISTORY,
    "raw_clicks": RAW_CLICKS,
    "raw_financials": RAW_FINANCIALS,
    "scored_orders": SCORED_ORDERS,
}

SILVER_LOANS = """
SELECT l.*, CASE WHEN overdue_amt > 0 THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INT) ELSE 0 END AS dpd
FROM (SELECT f.*, CASE WHEN installments_missed > 0 THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
      FROM (SELECT loan_id, Customer_ID, loan_start_date, coalesce(tenure, 0) AS tenure,
                   coalesce(installment_num, 0) AS installment_num, coalesce(loan_amt, 0) AS loan_amt,
                   coalesce(due_amt, 0) AS due_amt, coalesce(paid_amt, 0) AS paid_amt,
                   coalesce(overdue_amt, 0) AS overdue_amt, coalesce(balance, 0) AS balance, snapshot_date,
                   coalesce(installment_num, 0) AS mob,
                   CASE WHEN due_amt <> 0 AND overdue_amt IS NOT NULL THEN CAST(ceil(overdue_amt / due_amt) AS INT) ELSE 0 END AS installments_missed
            FROM raw_loans) f) l
"""

GOLD_LABELS = """
SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def, snapshot_date
FROM silver_loans WHERE mob = 6
"""

MONTHS = f"""
SELECT CAST(unnest(generate_series(DATE '{FIRST_MONTH}', DATE '{LAST_MONTH}', INTERVAL 1 MONTH)) AS DATE) AS month
"""

TYPED_ATTRIBUTES = r"""
SELECT Customer_ID, Name, CAST(trunc(TRY_CAST(trim(Age) AS DOUBLE)) AS DOUBLE) AS Age,
       CASE WHEN regexp_full_match(SSN, '\d{3}-\d{2}-\d{4}') THEN SSN ELSE '___' END AS SSN,
       CASE WHEN trim(trim(Occupation, '_')) = '' THEN '___' ELSE trim(trim(Occupation, '_')) END AS Occupation,
       snapshot_date
FROM raw_attributes
"""

CARRIED_ATTRIBUTES = """
SELECT a.* EXCLUDE (snapshot_date), m.month AS snapshot_date
FROM typed_attributes a JOIN months m ON a.snapshot_date <= m.month
"""


def _ages_filled(source: str) -> str:
    return f"""
SELECT a.Customer_ID, a.Name,
       CAST(round(CASE WHEN a.Age BETWEEN 0 AND 100 THEN a.Age ELSE g.mean_age END) AS INT) AS Age,
       a.SSN, a.Occupation, a.snapshot_date
FROM {source} a LEFT JOIN (SELECT snapshot_date, Occupation, avg(Age) AS mean_age FROM {source}
                           WHERE Age BETWEEN 0 AND 100 GROUP BY snapshot_date, Occupation) g
  ON g.snapshot_date = a.snapshot_date AND g.Occupation = a.Occupation
"""


SILVER_CLICKS = f"""
SELECT c.Customer_ID, c.snapshot_date,
       {", ".join(f"coalesce(c.{name}, CAST(trunc(m.{name}) AS INT)) AS {name}" for name in CLICK_FEATURES)}
FROM raw_clicks c JOIN (SELECT snapshot_date, {", ".join(f"avg({name}) AS {name}" for name in CLICK_FEATURES)}
                        FROM raw_clicks GROUP BY snapshot_date) m ON m.snapshot_date = c.snapshot_date
"""


def _number(name: str, kind: str, cap: int | None) -> str:
    digits = f"TRY_CAST(regexp_replace({name}, '[^0-9.]', '', 'g') AS DOUBLE)"
    value = digits if kind == "double" else f"CAST(trunc({digits}) AS INT)"
    if cap is None:
        return f"{value} AS {name}"
    return f"CASE WHEN {value} > {cap} THEN {cap} ELSE {value} END AS {name}"


CHECK_NUMBERS = [
    ("Annual_Income", "double", None), ("Monthly_Inhand_Salary", "double", None), ("Num_Bank_Accounts", "int", 10),
    ("Num_Credit_Card", "int", 10), ("Num_Credit_Inquiries", "int", 200), ("Interest_Rate", "double", 33),
    ("Num_of_Loan", "int", 9), ("Delay_from_due_date", "int", 57), ("Num_of_Delayed_Payment", "int", 25),
    ("Changed_Credit_Limit", "double", None), ("Outstanding_Debt", "double", None),
    ("Credit_Utilization_Ratio", "double", None), ("Total_EMI_per_month", "double", None),
    ("Amount_invested_monthly", "double", None), ("Monthly_Balance", "double", None),
]
NUMBER_SQL = ", ".join(_number(*rule) for rule in CHECK_NUMBERS)
HISTORY_SQL = (
    "CASE WHEN Credit_History_Age IS NULL THEN NULL ELSE "
    r"coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s+Years', 1) AS INT), 0) * 12 + "
    r"coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s+Months', 1) AS INT), 0) END AS Credit_History_Months"
)
SPEND_SQL = (
    "CASE WHEN regexp_matches(Payment_Behaviour, '(?i)low_spent') THEN 1 "
    "WHEN regexp_matches(Payment_Behaviour, '(?i)medium_spent') THEN 2 "
    "WHEN regexp_matches(Payment_Behaviour, '(?i)high_spent') THEN 3 ELSE 0 END AS Spend_Level"
)
VALUE_SQL = (
    "CASE WHEN regexp_matches(Payment_Behaviour, '(?i)small_value') THEN 1 "
    "WHEN regexp_matches(Payment_Behaviour, '(?i)medium_value') THEN 2 "
    "WHEN regexp_matches(Payment_Behaviour, '(?i)large_value') THEN 3 ELSE 0 END AS Value_Level"
)
CREDIT_MIX_SQL = (
    "CASE WHEN Credit_Mix IS NULL OR Credit_Mix IN ('_', '', 'NA', 'NaN') THEN 'Unknown' "
    "ELSE upper(left(Credit_Mix, 1)) || lower(substr(Credit_Mix, 2)) END AS Credit_Mix"
)
MIN_AMOUNT_SQL = (
    "CASE Payment_of_Min_Amount WHEN 'Yes' THEN 'Yes' WHEN 'No' THEN 'No' ELSE 'Unknown' END AS Payment_of_Min_Amount"
)
DATE_TEXT_SQL = "regexp_replace(snapshot_date, '[./]', '-', 'g')"
DATE_SQL = (
    f"CAST(coalesce(try_strptime({DATE_TEXT_SQL}, '%Y-%m-%d'), try_strptime({DATE_TEXT_SQL}, '%d-%m-%Y'), "
    f"try_strptime({DATE_TEXT_SQL}, '%m-%d-%Y')) AS DATE) AS snapshot_date"
)
LOAN_NAMES = [
    "Auto Loan", "Credit-Builder Loan", "Debt Consolidation Loan", "Home Equity Loan",
    "Mortgage Loan", "Payday Loan", "Personal Loan", "Student Loan",
]

# One row per customer and listed loan type. A customer has one financial row.
LOAN_ITEMS = """
SELECT Customer_ID, place, trim(item) AS item
FROM (SELECT Customer_ID, unnest(string_split(replace(Type_of_Loan, 'and', ','), ',')) AS item,
             generate_subscripts(string_split(replace(Type_of_Loan, 'and', ','), ','), 1) AS place
      FROM raw_financials) s
WHERE trim(item) NOT IN ('', 'Not Specified')
"""

LOAN_FLAGS = f"""
SELECT f.Customer_ID,
       {", ".join(f'''CAST(coalesce(max(CASE WHEN i.item = '{name}' THEN 1 END), 0) AS INT) AS "{name}"''' for name in LOAN_NAMES)},
       CAST(CASE WHEN count(CASE WHEN i.item IN ({", ".join(f"'{name}'" for name in LOAN_NAMES)}) THEN 1 END) = 0 THEN 1 ELSE 0 END AS INT) AS unseen
FROM raw_financials f LEFT JOIN loan_items i ON i.Customer_ID = f.Customer_ID
GROUP BY f.Customer_ID
"""

CLEAN_FINANCIALS = f"""
SELECT r.Customer_ID, {NUMBER_SQL}, {HISTORY_SQL}, {SPEND_SQL}, {VALUE_SQL}, {CREDIT_MIX_SQL}, {MIN_AMOUNT_SQL},
       l.* EXCLUDE (Customer_ID), {DATE_SQL}
FROM raw_financials r JOIN loan_flags l ON l.Customer_ID = r.Customer_ID
"""

SILVER_FINANCIALS = """
SELECT f.* EXCLUDE (snapshot_date), m.month AS snapshot_date
FROM clean_financials f JOIN months m ON f.snapshot_date <= m.month
"""

GOLD_JOINED = """
SELECT a.*, f.* EXCLUDE (Customer_ID, snapshot_date), c.* EXCLUDE (Customer_ID, snapshot_date)
FROM silver_attributes a
JOIN silver_financials f ON f.Customer_ID = a.Customer_ID AND f.snapshot_date = a.snapshot_date
JOIN silver_clicks c ON c.Customer_ID = a.Customer_ID AND c.snapshot_date = a.snapshot_date
"""

CLICK_SUM = "(" + " + ".join(CLICK_FEATURES) + ")"
FEATURE_SQL = {
    "Debt_to_Income_Ratio": "Outstanding_Debt / NULLIF(Annual_Income, 0)",
    "Delayed_Payment_Rate": "CAST(Num_of_Delayed_Payment AS DOUBLE) / NULLIF(Num_of_Loan, 0)",
    "EMI_to_Income_Ratio": "Total_EMI_per_month / NULLIF(Monthly_Inhand_Salary, 0)",
    "Investment_Rate": "Amount_invested_monthly / NULLIF(Monthly_Inhand_Salary, 0)",
    "Loan_Diversity_Score": " + ".join(f'"{name}"' for name in [*LOAN_NAMES, "unseen"]),
    "Click_Total": CLICK_SUM,
    "Click_Mean": f"{CLICK_SUM} * CAST(0.05 AS DOUBLE)",
    "Click_Variance": "("
    + " + ".join(f"pow({name} - {CLICK_SUM} * CAST(0.05 AS DOUBLE), 2)" for name in CLICK_FEATURES)
    + ") / CAST(20 AS DOUBLE)",
    "Debt_to_Click_Ratio": f"Outstanding_Debt / NULLIF({CLICK_SUM} + 1, 0)",
    "Income_to_Utilization": "Annual_Income / NULLIF(Credit_Utilization_Ratio + 1, 0)",
    "Investment_to_Clicks": f"Amount_invested_monthly / NULLIF({CLICK_SUM} + 1, 0)",
    "Age_to_Credit_Age_Ratio": "CAST(Credit_History_Months AS DOUBLE) / NULLIF(Age * 12, 0)",
    "EMI_to_Debt_Ratio": "Total_EMI_per_month / NULLIF(Outstanding_Debt + 1, 0)",
    "Debt_to_Salary_Interaction": "Outstanding_Debt / NULLIF(Monthly_Inhand_Salary + 1, 0)",
    "Debt_Interest_Product": "Outstanding_Debt * Interest_Rate",
    "Log_Debt": "ln(1 + Outstanding_Debt)",
    "Log_Income": "ln(1 + Annual_Income)",
    "Credit_Utilization_Sq": "pow(Credit_Utilization_Ratio, 2)",
    "Credit_Utilization_Cube": "pow(Credit_Utilization_Ratio, 3)",
    "High_Risk_Flag": "CASE WHEN Outstanding_Debt / NULLIF(Annual_Income, 0) > 0.8 THEN 1 ELSE 0 END",
    "High_Interest_Flag": "CASE WHEN Interest_Rate > 25 THEN 1 ELSE 0 END",
    "Has_Multiple_Loans": "CASE WHEN Num_of_Loan > 2 THEN 1 ELSE 0 END",
    "Age_Bucket": "CASE WHEN Age < 25 THEN 0 WHEN Age < 40 THEN 1 WHEN Age < 55 THEN 2 ELSE 3 END",
    "Debt_to_Income_Bin": (
        "CASE WHEN Outstanding_Debt / NULLIF(Annual_Income, 0) < 0.3 THEN 0 "
        "WHEN Outstanding_Debt / NULLIF(Annual_Income, 0) < 0.7 THEN 1 "
        "WHEN Outstanding_Debt / NULLIF(Annual_Income, 0) < 1.0 THEN 2 ELSE 3 END"
    ),
    "Min_Payment_Flag": "CASE Payment_of_Min_Amount WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 ELSE -1 END",
    "PMET_Job_Indicator": (
        "CASE WHEN Occupation IN ('Engineer', 'Manager', 'Analyst', 'Lawyer', 'Scientist', 'Doctor', "
        "'Accountant', 'Developer', 'Architect') THEN 1 ELSE 0 END"
    ),
    "Is_Year_End": "CASE WHEN month(snapshot_date) = 12 THEN 1 ELSE 0 END",
}
WHOLE_FEATURES = {
    "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Num_Credit_Inquiries", "Age", "Credit_History_Months",
    "Spend_Level", "Value_Level", *LOAN_NAMES, "unseen", *CLICK_FEATURES, "Loan_Diversity_Score", "Click_Total",
    "High_Risk_Flag", "High_Interest_Flag", "Has_Multiple_Loans", "Age_Bucket", "Debt_to_Income_Bin",
    "Min_Payment_Flag", "PMET_Job_Indicator", "Is_Year_End",
}
BASE_NAMES = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Interest_Rate", "Changed_Credit_Limit",
    "Num_Credit_Inquiries", "Outstanding_Debt", "Credit_Utilization_Ratio", "Monthly_Inhand_Salary", "Age",
    "Credit_History_Months", "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
    "Spend_Level", "Value_Level",
]


def feature_sql(names: list[str], filled: bool = False, digits: int | None = 6) -> str:
    """Select list of features; doubles rounded unless ``digits`` is None, gaps as 0 when ``filled``."""
    parts = []
    for name in names:
        text = FEATURE_SQL.get(name, f'"{name}"')
        if filled:
            text = f"coalesce({text}, 0)"
        if name in WHOLE_FEATURES:
            text = f"CAST({text} AS INT)"
        elif digits is not None:
            text = f"round({text}, {digits})"
        parts.append(f'{text} AS "{name}"')
    return ", ".join(parts)


ALL_NAMES = [*BASE_NAMES, *LOAN_NAMES, "unseen", *CLICK_FEATURES, *FEATURE_SQL]
GOLD_FEATURES = f"SELECT Customer_ID, snapshot_date, {feature_sql(ALL_NAMES, filled=True, digits=None)} FROM gold_joined"
# The same with the text columns that models may use.
GOLD_MODEL = GOLD_FEATURES.replace("snapshot_date, ", "snapshot_date, Occupation, Credit_Mix, ", 1)

CHECK_VIEWS = {
    "silver_loans": SILVER_LOANS,
    "gold_labels": GOLD_LABELS,
    "months": MONTHS,
    "typed_attributes": TYPED_ATTRIBUTES,
    "carried_attributes": CARRIED_ATTRIBUTES,
    "silver_attributes": _ages_filled("carried_attributes"),
    "raw_attributes_filled": _ages_filled("typed_attributes"),
    "silver_clicks": SILVER_CLICKS,
    "loan_items": LOAN_ITEMS,
    "loan_flags": LOAN_FLAGS,
    "clean_financials": CLEAN_FINANCIALS,
    "silver_financials": SILVER_FINANCIALS,
    "gold_joined": GOLD_JOINED,
    "gold_features": GOLD_FEATURES,
    "gold_model": GOLD_MODEL,
}

GIVEN_TABLES = ["lineitem", "orders", "customer", "events"]


def check_sql(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the views it uses, in order of dependency."""
    views = {**{name: text.format(**{t: t for t in GIVEN_TABLES}) for name, text in RAW_VIEWS.items()}, **CHECK_VIEWS}
    views.update(extra or {})
    used: dict[str, str] = {}

    def visit(text: str) -> None:
        for name, definition in views.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                visit(definition)
                used[name] = definition

    visit(body)
    clauses = ",\n".join(f"{name} AS ({definition.strip()})" for name, definition in used.items())
    return f"WITH {clauses}\n{body.strip()}" if clauses else body.strip()
