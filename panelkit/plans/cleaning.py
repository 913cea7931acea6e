"""Row-level cleaning before modelling, driven by rule tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.encode import collapse
from panelkit.functions.numeric import INVALID_RULES, NON_NEGATIVE, apply_rules, at_least
from panelkit.functions.text import blank_to
from panelkit.sources.schema import unique_columns

# Columns superseded by their imputed form.
REDUNDANT = ["Age", "Num_Bank_Accounts", "Num_Credit_Card", "Age_Bin", "Bank_Accounts_Imputed_Bin",
             "Credit_Cards_Imputed_Bin"]
CATEGORICAL = ["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour_Imputed"]


def clean_rows(df: DataFrame, non_negative: Sequence[str] = NON_NEGATIVE,
               rules: Mapping[str, tuple[str, float]] = INVALID_RULES,
               redundant: Sequence[str] = REDUNDANT) -> DataFrame:
    """Clip counts, null invalid values, rebuild combined features, collapse one-hot columns, drop redundant ones."""
    df = df.select(*unique_columns(df.columns))
    have = set(df.columns)
    first = {c: at_least(c, 0) for c in non_negative if c in have}
    if "Occupation" in have:
        first["Occupation"] = blank_to("Occupation")
    df = df.withColumns(first)
    df = df.withColumns(apply_rules({c: r for c, r in rules.items() if c in have}))
    if {"Bank_Accounts_imputed", "Credit_Cards_imputed", "Num_of_Loan_Cleaned"} <= have:
        df = df.withColumn("Num_Fin_Pdts", F.col("Bank_Accounts_imputed") + F.col("Credit_Cards_imputed")
                           + F.col("Num_of_Loan_Cleaned"))
    if {"Interest_Rate", "Outstanding_Debt"} <= have:
        df = df.withColumn("InterestRate_x_Debt", F.col("Interest_Rate") * F.col("Outstanding_Debt"))
    for name in ("Credit_Mix", "Payment_of_Min_Amount"):
        flags = [c for c in df.columns if c.startswith(name + "_")]
        if flags:
            df = df.withColumn(name, collapse(flags, name + "_")).drop(*flags)
    fills = {c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in CATEGORICAL if c in df.columns}
    return df.withColumns(fills).drop(*[c for c in redundant if c in df.columns]) if fills else \
        df.drop(*[c for c in redundant if c in df.columns])
