"""Raw table layouts. Raw columns are read as text and typed by the cleaning steps."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the four raw tables, in file order.
LOAN_COLUMNS = [
    "loan_id", "Customer_ID", "loan_start_date", "tenure", "installment_num", "loan_amt",
    "due_amt", "paid_amt", "overdue_amt", "balance", "snapshot_date",
]
ATTRIBUTE_COLUMNS = ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"]
CLICK_FEATURES = [f"fe_{number}" for number in range(1, 21)]
CLICK_COLUMNS = ["Customer_ID", "snapshot_date", *CLICK_FEATURES]
FINANCIAL_COLUMNS = [
    "Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card",
    "Interest_Rate", "Num_of_Loan", "Type_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment",
    "Changed_Credit_Limit", "Num_Credit_Inquiries", "Credit_Mix", "Outstanding_Debt",
    "Credit_Utilization_Ratio", "Credit_History_Age", "Payment_of_Min_Amount", "Total_EMI_per_month",
    "Amount_invested_monthly", "Payment_Behaviour", "Monthly_Balance", "snapshot_date",
]

# Target types after cleaning.
LOAN_TYPES = {
    "loan_id": "string", "Customer_ID": "string", "loan_start_date": "date", "tenure": "int",
    "installment_num": "int", "loan_amt": "double", "due_amt": "double", "paid_amt": "double",
    "overdue_amt": "double", "balance": "double", "snapshot_date": "date",
}
ATTRIBUTE_TYPES = {
    "Customer_ID": "string", "Name": "string", "Age": "int", "SSN": "string",
    "Occupation": "string", "snapshot_date": "date",
}
CLICK_TYPES = {"Customer_ID": "string", "snapshot_date": "date", **dict.fromkeys(CLICK_FEATURES, "int")}


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])
