"""Hand-written rows with the edge cases of each cleaning and feature rule."""

import datetime as dt
from functools import partial

import pytest
from pyspark.sql import functions as F

from panelkit.functions.binning import edge_labels, labelled_bin, labelled_bin_at
from panelkit.functions.dates import month_spine, months_back, split_of, split_windows
from panelkit.functions.numeric import INVALID_RULES, NON_NEGATIVE, apply_rules, at_least, status, worst_status
from panelkit.functions.text import clean_list, replace_token, spell_undefined, years_of
from panelkit.operators.asof import asof_join, latest_non_null, latest_per_key
from panelkit.operators.impute import age_for_apply, age_for_fit, apply_age, apply_counts
from panelkit.operators.lookback import lookback
from panelkit.operators.quality import one_to_one, require_splits, with_labels
from panelkit.plans.cleaning import clean_rows
from panelkit.plans.gold import label_store
from panelkit.plans.silver import delinquency, silver_attributes, silver_financials
from panelkit.sources.schema import FINANCIAL_TYPES, require_columns

D = dt.date


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_delinquency(spark):
    df = spark.createDataFrame(
        [("a", 0, 0.0, 0.0, D(2024, 1, 1)), ("b", 6, 5.0, 0.0, D(2024, 1, 1)), ("c", 6, 100.0, 30.0, D(2024, 3, 31)),
         ("d", 6, None, 30.0, D(2024, 3, 31))],
        "loan_id string, installment_num int, overdue_amt double, due_amt double, snapshot_date date")
    made = delinquency(df).orderBy("loan_id")
    assert rows(made.select("installments_missed", "first_missed_date", "dpd")) == [
        (0, None, 0), (0, None, None), (4, D(2023, 11, 30), 122), (0, None, 0)]
    assert made.filter("loan_id = 'd'").first()["overdue_amt"] == 0.0
    labels = label_store(made.withColumn("Customer_ID", F.lit("x"))).orderBy("loan_id")
    assert rows(labels.select("loan_id", "label", "label_def")) == [
        ("b", 0, "30dpd_6mob"), ("c", 1, "30dpd_6mob"), ("d", 0, "30dpd_6mob")]


def test_attribute_cleaning(spark):
    raw = spark.createDataFrame([("1", "28_", "Doctor"), ("2", "-500", "_______"), ("3", None, None), ("4", "x", "A_B")],
                                "Customer_ID string, Age string, Occupation string")
    raw = raw.selectExpr("Customer_ID", "'n' AS Name", "Age", "'s' AS SSN", "Occupation", "'2024-01-01' AS snapshot_date")
    assert rows(silver_attributes(raw).orderBy("Customer_ID").select("Age", "Occupation", "snapshot_date")) == [
        (28, "Doctor", D(2024, 1, 1)), (-500, "", D(2024, 1, 1)), (None, None, D(2024, 1, 1)), (None, "AB", D(2024, 1, 1))]


def test_text_rules(spark):
    df = spark.createDataFrame([
        ("_", None, "12 Years and 3 Months", "!@9#%8"), ("__", "Auto Loan, and Home Loan", "7 Years", "x"),
        ("Good", "A and B", None, None)], "mix string, loans string, age string, pay string")
    assert rows(df.select(spell_undefined("mix"), clean_list("loans"), F.size(F.split(clean_list("loans"), ",")), years_of("age"),
                          replace_token("pay", "!@9#%8", "High_spent_Small_value_payments"))) == [
        ("Not Defined", "Not Specified", 1, 12.25, "High_spent_Small_value_payments"),
        ("Not DefinedNot Defined", "Auto Loan,Home Loan", 2, None, "x"), ("Good", "AB", 1, None, None)]


def test_financials_one_hot_follow_vocabulary(spark):
    raw = spark.createDataFrame([("1", "Auto Loan, and Home Loan", "_", "Yes"), ("2", None, "Good", "No")],
                                "Customer_ID string, Type_of_Loan string, Credit_Mix string, Payment_of_Min_Amount string")
    for c in FINANCIAL_TYPES:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit("1234.5_" if c == "Annual_Income" else None).cast("string"))
    made = silver_financials(raw).orderBy("Customer_ID")
    assert rows(made.select("Annual_Income", "Loan_Auto_Loan", "Loan_Home_Loan", "Loan_Not_Specified", "Credit_Mix_Not_Defined",
                            "Payment_of_Min_Amount_No")) == [(1234.5, 1, 1, 0, 1, 0), (1234.5, 0, 0, 1, 0, 1)]
    fixed = silver_financials(raw, {"Loan": ["Auto Loan", "Boat Loan"], "Credit_Mix": ["Good"], "Payment_of_Min_Amount": []})
    assert rows(fixed.orderBy("Customer_ID").select("Loan_Boat_Loan", "Credit_Mix_Good")) == [(0, 0), (0, 1)]


def test_cleaning_rules(spark):
    df = spark.createDataFrame([(51, -2, 60, -3.3e26, 10000.0), (50, 31, 50, 5.0, 9999.0), (None, None, None, None, None)],
                               "Interest_Rate int, Num_Credit_Inquiries int, Num_of_Delayed_Payment int, Monthly_Balance double, "
                               "Amount_invested_monthly double")
    assert rows(clean_rows(df)) == [(None, 0, None, None, None), (50, None, 50, 5.0, 9999.0), (None,) * 5]
    assert rows(df.select(*[c.alias(n) for n, c in apply_rules(INVALID_RULES).items()]))[0][1] == -2
    assert "Num_Credit_Inquiries" in NON_NEGATIVE
    assert rows(spark.range(1).select(at_least(F.lit(None).cast("int")))) == [(None,)]


def test_collapse_and_unknown(spark):
    df = spark.createDataFrame([("", 1, 0), (None, 0, 0), ("Chef", 0, 1)], "Occupation string, Credit_Mix_Bad int, Credit_Mix_Good int")
    assert rows(clean_rows(df).select("Occupation", "Credit_Mix")) == [("Unknown", "Bad"), ("Unknown", "Unknown"), ("Chef", "Good")]


def test_age_fit_and_apply_differ_for_conflicts(spark):
    df = spark.createDataFrame([(28, 5.0), (20, 25.0), (-500, None), (8000, 1.0), (None, 3.0)], "Age int, Credit_History_Age_Years double")
    assert rows(age_for_fit(df).select("Age_clean", "Age_History_Inconsistent", "Age_was_invalid")) == [
        (28, 0, 0), (20, 1, 0), (None, 0, 1), (None, 0, 1), (None, 0, 0)]
    assert rows(age_for_apply(df).select("Age_clean", "Age_History_Inconsistent", "Age_was_invalid")) == [
        (28, 0, 0), (None, 1, 1), (None, 0, 1), (None, 0, 1), (None, 0, 0)]


def test_age_candidates(spark):
    import math
    lookup = spark.createDataFrame(
        [("one", "18-30", 10.0, 25.0), ("far", "18-30", 9.0, 25.0), ("far", "31-60", 9.15, 45.0),
         ("near", "18-30", 9.0, 25.0), ("near", "31-60", 9.04, 45.0)], "Occupation string, Age_Bin string, log_income_median double, age_median double")
    occupation = spark.createDataFrame([("one", 33.0), ("far", 33.0), ("near", 33.0)], "Occupation string, occupation_age_median double")
    income = math.exp(9.0) - 1
    df = spark.createDataFrame([(1, None, "one", 0.0), (2, None, "far", income), (3, None, "near", income), (4, None, "other", income),
                                (5, None, None, income), (6, None, "far", None), (7, 50, "far", income)],
                               "id int, Age int, Occupation string, Annual_Income double").withColumn("Credit_History_Age_Years", F.lit(None).cast("double"))
    made = apply_age(df, lookup, occupation, 40.0, [18.0, 30.0, 60.0]).orderBy("id")
    assert rows(made.select("Age_imputed", "Age_imputation_method", "Age_Bin")) == [
        (25, "occupation_income_age_bin", "18-30"), (25, "occupation_income_age_bin", "18-30"), (33, "occupation_median", "31-60"),
        (40, "overall_median", "31-60"), (40, "overall_median", "31-60"), (33, "occupation_median", "31-60"), (50, "original", "31-60")]


def test_count_hierarchy(spark):
    group = spark.createDataFrame([("a", "x", 2.5)], "Occupation string, Age_Bin string, median double")
    occupation = spark.createDataFrame([("a", 4.0)], "Occupation string, occupation_median double")
    df = spark.createDataFrame([(1, "a", "x", 900), (2, "a", "y", None), (3, None, "x", -1), (4, "a", "x", 7)],
                               "id int, Occupation string, Age_Bin string, raw int")
    made = apply_counts(df, "raw", "Made", 10.0, group, occupation, 5.0).orderBy("id")
    assert rows(made.select("Made_clean", "Made_Was_Invalid", "Made_imputed", "Made_imputation_method")) == [
        (None, 1, 3, "occupation_age_bin_median"), (None, 0, 4, "occupation_median"), (None, 1, 5, "overall_median"), (7, 0, 7, "original")]


def test_bins(spark):
    df = spark.createDataFrame([(17,), (18,), (30,), (31,), (60,), (61,), (None,)], "v int")
    assert [r[0] for r in rows(df.select(labelled_bin("v", [18.0, 30.0, 60.0])))] == [None, "18-30", "18-30", "31-60", "31-60", None, None]
    assert [r[0] for r in rows(df.select(labelled_bin("v", [18.0, 18.0])))] == [None] * 7
    assert edge_labels([0.0, 5.0, 9.0]) == ["0-5", "6-9"]


def test_split_windows(spark):
    windows = {w.name: (w.start, w.end) for w in split_windows("2025-06-01")}
    assert windows == {"train": (D(2023, 1, 1), D(2024, 12, 31)), "validation": (D(2025, 1, 1), D(2025, 1, 31)),
                       "test": (D(2025, 2, 1), D(2025, 3, 31)), "oot": (D(2025, 4, 1), D(2025, 5, 31))}
    df = spark.createDataFrame([(D(2024, 12, 31),), (D(2025, 1, 1),), (D(2025, 3, 31),), (D(2025, 6, 1),), (D(2022, 1, 1),)], "d date")
    assert [r[0] for r in rows(df.select(split_of("d", split_windows("2025-06-01"))))] == ["train", "validation", "test", None, None]
    assert months_back(D(2024, 3, 31), 1) == D(2024, 2, 29) and months_back(D(2024, 1, 15), 1) == D(2023, 12, 15)


def test_month_spine(spark):
    bounds = spark.createDataFrame([(D(2024, 1, 15), D(2024, 3, 1))], "s date, e date")
    assert [r[0] for r in rows(month_spine(bounds, "s", "e"))] == [D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1)]
    assert [r[0] for r in rows(month_spine(bounds, "s", "e", truncate=False))] == [D(2024, 2, 1), D(2024, 3, 1)]


def test_lookback_boundaries(spark):
    day = D(2024, 6, 30)
    clicks = spark.createDataFrame([("c", day, 100), ("c", day - dt.timedelta(30), 1), ("c", day - dt.timedelta(31), 3), ("c", day - dt.timedelta(60), 5),
                                    ("c", day - dt.timedelta(61), 7), ("c", day - dt.timedelta(90), 9), ("c", day - dt.timedelta(91), 999)],
                                   "Customer_ID string, at date, fe_1 int")
    keys = spark.createDataFrame([("c", day), ("d", day)], "Customer_ID string, label_day date")
    made = lookback(clicks, keys, ["Customer_ID"], "at", "label_day", ["fe_1"], stats=("mean", "max"), latest=True)
    r = made.first()
    assert made.count() == 1
    assert (r["fe_1_mean_30d"], r["fe_1_mean_60d"], r["fe_1_max_90d"], r["click_count_30d"], r["click_count_60d"], r["click_count_90d"]) == (1.0, 3.0, 9, 1, 3, 5)
    assert r["fe_1_trend_30d"] == 1.0 - 4.0 and r["fe_1_latest"] == 1
    older = spark.createDataFrame([("c", day + dt.timedelta(200))], "Customer_ID string, label_day date")
    far = lookback(clicks, older, ["Customer_ID"], "at", "label_day", ["fe_1"], latest=True).first()
    assert far["fe_1_latest"] == 100 and far["click_count_90d"] is None


def test_latest_row_and_latest_value_differ(spark):
    df = spark.createDataFrame([("c", D(2024, 1, 1), 1, 10), ("c", D(2024, 2, 1), None, 20)], "k string, d date, a int, b int")
    assert rows(latest_per_key(df, ["k"], ["d"]).select("a", "b")) == [(None, 20)]
    assert rows(latest_non_null(df, ["k"], "d", ["a", "b"])) == [("c", 1, 20)]


@pytest.mark.parametrize("join", [asof_join, partial(asof_join, slices=1), partial(asof_join, slices=40)])
def test_role_change_mid_history(spark, join):
    roles = spark.createDataFrame([(D(2024, 1, 1), "m1"), (D(2024, 3, 1), "m2")], "since date, champion string")
    months = spark.createDataFrame([(D(2023, 12, 1),), (D(2024, 2, 1),), (D(2024, 3, 1),), (D(2024, 9, 1),)], "month date")
    assert sorted(rows(join(months, roles, [], "month", "since", ["champion"]))) == [
        (D(2023, 12, 1), None), (D(2024, 2, 1), "m1"), (D(2024, 3, 1), "m2"), (D(2024, 9, 1), "m2")]
    assert dict(rows(join(months, roles, [], "month", "since", ["champion"], strict=True)))[D(2024, 3, 1)] == "m1"


def test_statuses(spark):
    df = spark.createDataFrame([(None,), (0.1,), (0.11,), (0.25,), (0.26,)], "v double")
    assert [r[0] for r in rows(df.select(status("v", 0.1, 0.25)))] == ["n/a", "ok", "watch", "watch", "alert"]
    pairs = spark.createDataFrame([("ok", "n/a"), ("no labels yet", "n/a"), ("watch", "no labels yet"), ("ok", "alert")], "a string, b string")
    assert [r[0] for r in rows(pairs.select(worst_status("a", "b")))] == ["n/a", "no labels yet", "watch", "alert"]


def test_checks_raise(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    right = spark.createDataFrame([(1, 0)], "k int, label int")
    with pytest.raises(ValueError, match="not unique on the left"):
        one_to_one(left, right, ["k"])
    with pytest.raises(ValueError, match="1 feature rows"):
        with_labels(spark.createDataFrame([(1,), (2,)], "k int"), right, ["k"])
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(left, ["k", "z"])
    early = spark.createDataFrame([(D(2020, 1, 1), "train")], "d date, data_split string")
    with pytest.raises(ValueError, match="train"):
        require_splits(early, split_windows("2025-06-01"), "d")


def test_levels_have_a_limit(spark):
    from panelkit.functions.encode import collected_levels, one_hot
    df = spark.createDataFrame([("a,b",), ("b",), ("c,c",), (None,), ("b",)], "v string").withColumn("w", F.col("v"))
    assert collected_levels(df, {"v": ("v", ","), "w": ("w", None)}) == {"v": ["a", "b", "c"], "w": ["a,b", "b", "c,c"]}
    with pytest.raises(ValueError, match="more than 2"):
        collected_levels(df, {"v": ("v", ",")}, most=2)
    assert collected_levels(df, {"v": ("v", ","), "w": ("w", None)}, 2, "other") == {"v": ["a", "b", "other"], "w": ["a,b", "b", "other"]}
    flags = df.select("w", *[e.alias(n) for n, e in one_hot("w", ["b", "other"], "is_", "other").items()])
    assert sorted(map(tuple, flags.distinct().collect()), key=str) == sorted([("a,b", 0, 1), ("b", 1, 0), ("c,c", 0, 1), (None, 0, 0)], key=str)
    assert collected_levels(df.limit(0), {"v": ("v", ",")}) == {"v": []}


def test_bins_of_edges_in_rows(spark):
    """Edges and labels that come with each row give the bins of edges known beforehand, and nothing is sorted or filtered for a row."""
    values = [None, -1.0, 0.0, 1.0, 2.0, 2.5, 5.0, 5.1, 8.0, 10.0, 11.0, float("nan")]
    for edges in ([], [2.0], [2.0, 5.0], [0.0, 2.0, 5.0, 8.0, 10.0]):
        rows = spark.createDataFrame([(v, edges, edge_labels(edges)) for v in values], "v double, edges array<double>, labels array<string>")
        made = rows.select(labelled_bin("v", edges).alias("known"), labelled_bin_at("v", F.col("edges"), F.col("labels"), 5).alias("got"))
        assert [r["got"] for r in made.collect()] == [r["known"] for r in made.collect()]
        assert "lambda" not in made._jdf.queryExecution().optimizedPlan().toString()
