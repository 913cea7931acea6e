"""Label store and feature store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.binning import labelled_bin, labelled_bin_at
from panelkit.functions.dates import Split, in_window, in_windows, split_of
from panelkit.functions.numeric import ratio
from panelkit.operators.asof import asof_lookup
from panelkit.operators.impute import apply_age, apply_counts, fill_from
from panelkit.operators.lookback import lookback
from panelkit.plans.params import COUNTS, DatedParams, FeatureParams, fit_params
from panelkit.sources.schema import prefixed, require_columns

# Lookback features the store keeps, and working columns it drops.
CLICK_FEATURES = ["fe_10_mean_90d", "fe_5_mean_90d", "fe_4_mean_90d", "fe_9_mean_90d", "fe_3_std_60d",
                  "fe_8_mean_90d", "fe_3_mean_90d", "fe_14_trend_30d", "fe_1_trend_30d", "fe_16_std_60d"]
DROPPED = ["label", "Credit_History_Age", "Type_of_Loan", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour",
           "Type_of_Loan_Cleaned", "Num_of_Loan", "Age_History_Inconsistent", "Age_was_invalid", "Age_clean",
           "Age_imputation_method", "Bank_Accounts_clean", "Credit_Cards_clean", "Bank_Accounts_Was_Invalid",
           "Bank_Accounts_imputation_method", "Credit_Cards_Was_Invalid", "Credit_Cards_imputation_method"]


def label_store(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Default label of every loan at a month on book."""
    return loans.filter(F.col("mob") == mob).select(
        "loan_id", "Customer_ID", F.when(F.col("dpd") >= dpd, 1).otherwise(0).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"), "snapshot_date")


def join_sources(labels: DataFrame, attributes: DataFrame, financials: DataFrame,
                 point_in_time: bool = False) -> DataFrame:
    """Labels with the customer's attributes and financials.

    By default all snapshots of a customer are joined, as dates are not compared. With ``point_in_time`` each
    label takes the latest snapshot not after it.
    """
    base = labels.select("loan_id", "Customer_ID", "label", F.col("snapshot_date").alias("labels_snapshot_date"))
    people = attributes.select("Customer_ID", "Age", "Occupation",
                               F.col("snapshot_date").alias("attributes_snapshot_date"))
    money = financials.withColumnRenamed("snapshot_date", "financials_snapshot_date")
    if not point_in_time:
        return base.join(people, "Customer_ID", "left").join(money, "Customer_ID", "left")
    probes, out = base.select("Customer_ID", "labels_snapshot_date").distinct(), base
    for table, date in ((people, "attributes_snapshot_date"), (money, "financials_snapshot_date")):
        columns = [c for c in table.columns if c != "Customer_ID"]
        known = asof_lookup(probes, table, ["Customer_ID"], "labels_snapshot_date", date, columns)
        out = (out.join(known, ["Customer_ID", "labels_snapshot_date"], "left")
               .select(*out.columns, *[F.col(f"found.{c}").alias(c) for c in columns]))
    return out


def derived_ratios(df: DataFrame) -> DataFrame:
    """Product count, debt per account, delayed payments per card, interest times debt."""
    return df.withColumns({
        "Num_Fin_Pdts": F.col("Num_Bank_Accounts") + F.col("Num_Credit_Card") + F.col("Num_of_Loan_Cleaned"),
        "Debt_per_Credit_Account": ratio("Outstanding_Debt", F.col("Bank_Accounts_clean") + F.col("Credit_Cards_clean")),
        "Delayed_Payments_per_Card": ratio("Num_of_Delayed_Payment", "Credit_Cards_clean"),
        "InterestRate_x_Debt": F.col("Interest_Rate") * F.col("Outstanding_Debt")})


def apply_params(df: DataFrame, params: FeatureParams) -> DataFrame:
    """All fitted imputations and ratios; training, scoring and backfill use this one function."""
    df = fill_from(df, "Changed_Credit_Limit", params.tables["changed_credit_limit"],
                   ["Credit_Mix", "Payment_of_Min_Amount"], "Changed_Credit_Limit_Median") \
        if "changed_credit_limit" in params.tables else df
    df = apply_age(df, params.tables["age_income_lookup"], params.tables["occupation_age_median"],
                   params.scalars["overall_age_median"], params.edges["age"])
    for kind, (column, stem, _) in COUNTS.items():
        df = apply_counts(df, column, stem, params.scalars[f"{kind}_p95"], params.tables[f"{kind}_group_stats"],
                          params.tables[f"{kind}_occupation_median"], params.scalars[f"{kind}_overall_median"])
        df = df.withColumn(f"{stem}_Imputed_Bin", labelled_bin(f"{stem}_imputed", params.edges[kind]))
    return derived_ratios(df)


def apply_dated_params(df: DataFrame, params: DatedParams, date: str = "params_date") -> DataFrame:
    """The same with each row's parameters taken by its ``date`` column, so that months of several models are one job.

    Medians, caps, edges and labels are joined by date, bins are found by counting edges. A row whose date has no parameters keeps its own
    values and has nulls where they would be filled.
    """
    renamed = date != "params_date"
    df = df.withColumnRenamed(date, "params_date") if renamed else df
    by, tables = ["params_date"], params.tables
    if "changed_credit_limit" in tables:
        df = fill_from(df, "Changed_Credit_Limit", tables["changed_credit_limit"], [*by, "Credit_Mix", "Payment_of_Min_Amount"], "Changed_Credit_Limit_Median")
    numbers = params.numbers.columns

    def binned(column: str, kind: str):
        return labelled_bin_at(column, F.col(f"{kind}_edges"), F.col(f"{kind}_labels"), params.most_edges)

    df = df.join(params.numbers, by, "left")
    df = apply_age(df, tables["age_income_lookup"], tables["occupation_age_median"], F.col("overall_age_median"), by=by)
    df = df.withColumn("Age_Bin", binned("Age_imputed", "age"))
    for kind, (column, stem, _) in COUNTS.items():
        df = apply_counts(df, column, stem, F.col(f"{kind}_p95"), tables[f"{kind}_group_stats"], tables[f"{kind}_occupation_median"],
                          F.col(f"{kind}_overall_median"), by)
        df = df.withColumn(f"{stem}_Imputed_Bin", binned(f"{stem}_imputed", kind))
    made = derived_ratios(df).drop(*[c for c in numbers if c != "params_date"])
    return made.withColumnRenamed("params_date", date) if renamed else made


def feature_store(labels: DataFrame, attributes: DataFrame, financials: DataFrame, windows: Sequence[Split],
                  clicks: DataFrame | None = None, train_date: str = "", point_in_time: bool = False,
                  with_limit: bool = True, click_windows: Sequence[int] = (30, 60, 90),
                  click_features: Sequence[str] = CLICK_FEATURES, trend: int = 30,
                  drop: Sequence[str] = DROPPED) -> tuple[DataFrame, FeatureParams]:
    """Feature rows of all splits and the parameters fitted on the training rows.

    One frame carries the split as a column, so every transform is planned once. The older variant without
    limit imputation and clickstream is ``with_limit=False, clicks=None``. Raises if a click feature asked for can't be made.
    """
    labels = labels.filter(in_windows("snapshot_date", windows))
    joined = join_sources(labels, attributes, financials, point_in_time)
    rows = joined.withColumn("data_split", split_of("labels_snapshot_date", windows)).filter("data_split is not null")
    train = labels.filter(in_window("snapshot_date", windows, windows[0].name))
    params = fit_params(join_sources(train, attributes, financials, point_in_time), train_date, with_limit)
    made = apply_params(rows, params)
    if clicks is not None:
        columns = prefixed(clicks, "fe_")
        needed = [c for c in columns if any(f.startswith(f"{c}_") for f in click_features)]
        events = clicks.dropDuplicates().withColumns({c: F.col(c).cast("double") for c in needed})
        last = [c for c in needed if f"{c}_latest" in click_features]
        features = lookback(events, made, ["Customer_ID"], "clicks_snapshot_date", "labels_snapshot_date", needed, click_windows,
                            ("mean", "median", "max", "min", "std"), keep=click_features, trend=trend, dedupe=False, latest=bool(last))
        features = features.drop(*[f"{c}_latest" for c in needed if c not in last])
        require_columns(features, click_features)
        made = made.join(features, ["Customer_ID", "labels_snapshot_date"], "left")
    return made.drop(*drop), params
