"""Declared column types of the four raw sources and the casts that enforce them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column types of the raw sources. Decimals are double here.
LOAN_TYPES = {
    "loan_id": "string", "Customer_ID": "string", "loan_start_date": "date", "tenure": "int",
    "installment_num": "int", "loan_amt": "double", "due_amt": "double", "paid_amt": "double",
    "overdue_amt": "double", "balance": "double", "snapshot_date": "date",
}
ATTRIBUTE_TYPES = {
    "Customer_ID": "string", "Name": "string", "Age": "int", "SSN": "string", "Occupation": "string",
    "snapshot_date": "date",
}
FINANCIAL_TYPES = {
    "Customer_ID": "string", "Annual_Income": "double", "Monthly_Inhand_Salary": "double",
    "Num_Bank_Accounts": "int", "Num_Credit_Card": "int", "Interest_Rate": "int", "Num_of_Loan": "int",
    "Type_of_Loan": "string", "Delay_from_due_date": "int", "Num_of_Delayed_Payment": "int",
    "Changed_Credit_Limit": "double", "Num_Credit_Inquiries": "int", "Credit_Mix": "string",
    "Outstanding_Debt": "double", "Credit_Utilization_Ratio": "double", "Credit_History_Age": "string",
    "Payment_of_Min_Amount": "string", "Total_EMI_per_month": "double", "Amount_invested_monthly": "double",
    "Payment_Behaviour": "string", "Monthly_Balance": "double", "snapshot_date": "date",
}
CLICK_TYPES = {"Customer_ID": "string", "snapshot_date": "date", **{f"fe_{i}": "int" for i in range(1, 21)}}


def text_schema(columns: Sequence[str]) -> T.StructType:
    """Every column as text: a raw file is landed untouched and typed later."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def enforce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the mapped columns in one projection; text that does not parse becomes null."""
    return df.select([F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def to_number(column: str | Column) -> Column:
    """Number of a text column, null where it does not parse."""
    return (F.col(column) if isinstance(column, str) else column).try_cast("double")


def prefixed(df: DataFrame, prefix: str) -> list[str]:
    """Columns that start with a prefix; an error when there is none."""
    found = [c for c in df.columns if c.startswith(prefix)]
    if not found:
        raise ValueError(f"no column starts with {prefix!r}")
    return found


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same frame, or an error naming the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def unique_columns(columns: Sequence[str]) -> list[str]:
    """The names in order, each once."""
    return list(dict.fromkeys(columns))
