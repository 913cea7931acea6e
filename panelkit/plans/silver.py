"""Typed and cleaned source tables; the same code serves the full history and one month."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.encode import MOST_LEVELS, collected_levels, multi_hot, one_hot
from panelkit.functions.text import clean_list, replace_token, spell_undefined, strip_underscores, years_of
from panelkit.sources.schema import ATTRIBUTE_TYPES, CLICK_TYPES, FINANCIAL_TYPES, LOAN_TYPES, enforce

# Columns whose numbers carry stray underscores, and the placeholder behaviour.
NOISY_ATTRIBUTES = ["Age", "Occupation"]
NOISY_FINANCIALS = ["Annual_Income", "Num_of_Loan", "Num_of_Delayed_Payment", "Outstanding_Debt",
                    "Amount_invested_monthly", "Monthly_Balance", "Changed_Credit_Limit"]
BEHAVIOUR_TOKEN, BEHAVIOUR_VALUE = "!@9#%8", "High_spent_Small_value_payments"


def silver_attributes(raw: DataFrame) -> DataFrame:
    """Customer attributes without underscores, typed."""
    return enforce(raw.withColumns({c: strip_underscores(c) for c in NOISY_ATTRIBUTES}), ATTRIBUTE_TYPES)


def financial_vocabulary(raw: DataFrame, most: int = MOST_LEVELS) -> dict[str, list[str]]:
    """Levels the one-hot columns need, from one pass; raises if a column has more than ``most``, as they become column names."""
    prepared = raw.select(clean_list("Type_of_Loan").alias("loan"), spell_undefined("Credit_Mix").alias("mix"), F.col("Payment_of_Min_Amount").alias("pay"))
    return collected_levels(prepared, {"Loan": ("loan", ","), "Credit_Mix": ("mix", None), "Payment_of_Min_Amount": ("pay", None)}, most)


def silver_financials(raw: DataFrame, levels: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Customer financials: cleaned text, typed numbers, loan list, one-hot columns, history in years.

    ``levels`` fixes the one-hot columns, so that every month has the same ones; without it they come from the data.
    """
    levels = levels or financial_vocabulary(raw)
    text = raw.withColumns({**{c: strip_underscores(c) for c in NOISY_FINANCIALS},
                            "Credit_Mix": spell_undefined("Credit_Mix"),
                            "Type_of_Loan_Cleaned": clean_list("Type_of_Loan")})
    wide = text.withColumns({
        "Num_of_Loan_Cleaned": F.size(F.split("Type_of_Loan_Cleaned", ",")),
        **multi_hot("Type_of_Loan_Cleaned", levels["Loan"], "Loan_"),
        **one_hot("Credit_Mix", levels["Credit_Mix"], "Credit_Mix_"),
        **one_hot("Payment_of_Min_Amount", levels["Payment_of_Min_Amount"], "Payment_of_Min_Amount_"),
        "Credit_History_Age_Years": years_of("Credit_History_Age"),
        "Payment_Behaviour_Imputed": replace_token("Payment_Behaviour", BEHAVIOUR_TOKEN, BEHAVIOUR_VALUE)})
    return enforce(wide, FINANCIAL_TYPES)


def delinquency(loans: DataFrame) -> DataFrame:
    """Month on book, missed instalments, first missed date and days past due.

    Every missing number of the loan row is zero, as is the missed count where nothing is due; an overdue
    amount with nothing due therefore has no first missed date and no days past due.
    """
    missed = F.ceil(F.try_divide(F.col("overdue_amt"), F.col("due_amt"))).cast("int")
    numbers = [f.name for f in loans.schema.fields if f.dataType.typeName() in ("integer", "long", "double")]
    filled = (loans.withColumns({"mob": F.col("installment_num").cast("int"), "installments_missed": missed})
              .fillna(0, [*numbers, "mob", "installments_missed"]))
    first = F.when(F.col("installments_missed") > 0, F.add_months("snapshot_date", -F.col("installments_missed")))
    return (filled.withColumn("first_missed_date", first)
            .withColumn("dpd", F.when(F.col("overdue_amt") > 0, F.datediff("snapshot_date", "first_missed_date"))
                        .otherwise(0)))


def silver_loans(raw: DataFrame) -> DataFrame:
    """Loan ledger, typed, with delinquency."""
    return delinquency(enforce(raw, LOAN_TYPES))


def silver_clicks(raw: DataFrame) -> DataFrame:
    """Clickstream, typed; the snapshot date is named after its source."""
    return enforce(raw, CLICK_TYPES).withColumnRenamed("snapshot_date", "clicks_snapshot_date")


def silver_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All four silver tables."""
    return {"attributes": silver_attributes(raw["attributes"]), "financials": silver_financials(raw["financials"]),
            "loans": silver_loans(raw["loans"]), "clicks": silver_clicks(raw["clicks"])}
