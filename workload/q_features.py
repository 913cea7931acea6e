"""Feature-store builds: silver, labels, splits, fitted imputation, lookbacks, gold and inference features."""

from pyspark.sql import functions as F

from panelkit.functions.binning import labelled_bin
from panelkit.functions.dates import month_start, split_of, split_windows, two_way_windows
from panelkit.operators.impute import (age_for_apply, age_for_fit, apply_age, apply_counts, fill_from, fit_age, fit_counts,
                                       fit_group_medians, integer_quartiles, quartile_edges)
from panelkit.operators.lookback import lookback
from panelkit.operators.profile import method_counts
from panelkit.plans.bronze import land
from panelkit.plans.cleaning import clean_rows
from panelkit.plans.gold import CLICK_FEATURES, apply_dated_params, apply_params, derived_ratios, feature_store, join_sources, label_store
from panelkit.plans.inference import inference_features, params_in_force
from panelkit.plans.params import fit_params, load_dated_params, load_params
from panelkit.plans.silver import (delinquency, financial_vocabulary, silver_all, silver_attributes, silver_clicks,
                                   silver_financials, silver_loans)
from panelkit.session import fresh_path, materialize
from workload.q_aggregates import LOOKBACK_PAIRS, _window_sql
from workload.q_joins import labels, people
from workload.q_scalars import LOANS, financials
from workload.registry import query
from workload.views import DATA_START, TRAIN_DATE, as_text, label_keys, months, roles, runs, table, view

WINDOWS = split_windows(TRAIN_DATE, DATA_START)


@query("fs2_silver_attributes", "WITH @attributes SELECT * FROM attributes")
def fs2(spark, d):
    return silver_attributes(view(spark, d, "attributes_raw"))


HOT = ", ".join([f"CASE WHEN list_contains(string_split(Type_of_Loan_Cleaned, ','), '{v}') THEN 1 ELSE 0 END AS Loan_{v.replace(' ', '_').replace('-', '_')}"
                 for v in LOANS]
                + [f"CASE WHEN Credit_Mix = '{v}' THEN 1 ELSE 0 END AS Credit_Mix_{v.replace(' ', '_')}" for v in ("Bad", "Good", "Not Defined", "Standard")]
                + [f"CASE WHEN Payment_of_Min_Amount = '{v}' THEN 1 ELSE 0 END AS Payment_of_Min_Amount_{v}" for v in ("NM", "No", "Yes")])


@query("fs3_silver_financials", f"WITH @financials SELECT *, {HOT} FROM financials")
def fs3(spark, d):
    return silver_financials(view(spark, d, "financials_raw"))


@query("fs4_silver_loans", "WITH @silver_loans SELECT * FROM silver_loans")
def fs4(spark, d):
    return silver_loans(as_text(view(spark, d, "ledger")))


CLICK_SQL = """WITH wide AS (SELECT CAST(user_id AS VARCHAR) AS Customer_ID, CAST(ts AS DATE) AS clicks_snapshot_date, """ + ", ".join(
    f"TRY_CAST(CASE WHEN event_id % {i + 3} = 0 THEN 'x' ELSE CAST((event_id * {i}) % 101 AS VARCHAR) END AS INTEGER) AS fe_{i}"
    for i in range(1, 21)) + " FROM events)"


def raw_clicks(spark, d):
    """Twenty-feature clickstream as text, with values that do not parse."""
    features = [f"CASE WHEN event_id % {i + 3} = 0 THEN 'x' ELSE CAST((event_id * {i}) % 101 AS STRING) END AS fe_{i}" for i in range(1, 21)]
    return table(spark, d, "events").selectExpr("CAST(user_id AS STRING) AS Customer_ID", "CAST(CAST(ts AS DATE) AS STRING) AS snapshot_date", *features)


@query("fs5_silver_clickstream", CLICK_SQL + " SELECT * FROM wide")
def fs5(spark, d):
    return silver_clicks(raw_clicks(spark, d))


@query("fs6_all_silver", """WITH @attributes, @financials, @silver_loans SELECT 'attributes' AS source, count(*) AS n, count(Age) AS n_values FROM attributes
 UNION ALL SELECT 'financials', count(*), count(Changed_Credit_Limit) FROM financials
 UNION ALL SELECT 'loans', count(*), count(dpd) FROM silver_loans
 UNION ALL SELECT 'clicks', count(*), count(CASE WHEN event_id % 4 <> 0 THEN 1 END) FROM events""")
def fs6(spark, d):
    raw = {"attributes": view(spark, d, "attributes_raw"), "financials": view(spark, d, "financials_raw"),
           "loans": as_text(view(spark, d, "ledger")), "clicks": raw_clicks(spark, d)}
    measured = {"attributes": "Age", "financials": "Changed_Credit_Limit", "loans": "dpd", "clicks": "fe_1"}
    parts = [t.agg(F.lit(k).alias("source"), F.count(F.lit(1)).alias("n"), F.count(measured[k]).alias("n_values"))
             for k, t in silver_all(raw).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


LABELS = "lab AS (SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def, snapshot_date FROM silver_loans WHERE mob = 6)"


@query("fs7_label_store", f"WITH @silver_loans, {LABELS} SELECT * FROM lab")
def fs7(spark, d):
    return label_store(silver_loans(as_text(view(spark, d, "ledger"))))


@query("fs7_label_rate_by_month", f"WITH @silver_loans, {LABELS} SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month, count(*) AS n, "
       "CAST(sum(label) AS BIGINT) AS bads, round(avg(label), 9) AS bad_rate FROM lab GROUP BY 1")
def label_rate(spark, d):
    made = label_store(delinquency(view(spark, d, "ledger")))
    return made.groupBy(month_start("snapshot_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("bads"), F.round(F.avg("label"), 9).alias("bad_rate"))


@query("fs8_chronological_split", "WITH @split_panel SELECT loan_id, label_date, data_split FROM split_panel WHERE data_split IS NOT NULL")
def fs8(spark, d):
    return (view(spark, d, "panel").withColumn("data_split", split_of("label_date", WINDOWS)).filter("data_split IS NOT NULL")
            .select("loan_id", "label_date", "data_split"))


@query("fs8_moved_rows", """WITH @split_panel, later AS (SELECT *, CASE WHEN label_date BETWEEN DATE '1995-01-01' AND DATE '2000-06-30' THEN 'train'
 WHEN label_date <= DATE '2000-07-30' THEN 'validation' WHEN label_date <= DATE '2000-09-30' THEN 'test' WHEN label_date <= DATE '2000-11-30' THEN 'oot' END AS new_split
 FROM split_panel WHERE data_split IS NOT NULL) SELECT new_split, count(*) AS n, count(*) FILTER (new_split <> data_split) AS n_moved FROM later
 WHERE new_split IS NOT NULL GROUP BY 1""")
def fs8_moved(spark, d):
    rows = view(spark, d, "panel").withColumns({"data_split": split_of("label_date", WINDOWS),
                                                "new_split": split_of("label_date", split_windows("2000-12-01", DATA_START))})
    return (rows.filter("data_split IS NOT NULL AND new_split IS NOT NULL").groupBy("new_split")
            .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("new_split") != F.col("data_split"), 1)).alias("n_moved")))


@query("fs21_two_way_split", """WITH @panel SELECT CASE WHEN label_date <= DATE '1999-12-31' THEN 'train' ELSE 'unseen' END AS data_split, count(*) AS n FROM panel
 WHERE label_date <= DATE '1999-12-31' OR label_date >= DATE '2000-03-01' GROUP BY 1""")
def fs21(spark, d):
    split = split_of("label_date", two_way_windows("1995-01-01", "1999-12-31", "2000-03-01", "2001-12-31"))
    return (view(spark, d, "panel").withColumn("data_split", split).filter("data_split IS NOT NULL").groupBy("data_split")
            .agg(F.count(F.lit(1)).alias("n")))


# ---- the gold build as SQL, step by step ----------------------------------------------------------------------------
def _edges(column: str, source: str, where: str = "") -> str:
    return f"SELECT list_sort(list_distinct(quantile_disc({column}, [0.0, 0.25, 0.5, 0.75, 1.0]))) AS e FROM {source} {where}"


def _bin(value: str, e: str) -> str:
    at = f"len(list_filter({e}[2:], lambda q: {value} > q))"
    return (f"CASE WHEN len({e}) < 2 OR {value} IS NULL OR {value} < {e}[1] OR {value} > {e}[len({e})] THEN NULL WHEN {at} = 0 "
            f"THEN concat(CAST(CAST({e}[1] AS INT) AS VARCHAR), '-', CAST(CAST({e}[2] AS INT) AS VARCHAR)) "
            f"ELSE concat(CAST(CAST({e}[{at} + 1] AS INT) + 1 AS VARCHAR), '-', CAST(CAST({e}[{at} + 2] AS INT) AS VARCHAR)) END")


def _apply_age(source: str, out: str, key: str, binned: bool) -> str:
    """CTEs that impute the age of ``source``."""
    return f"""{out}_a AS (SELECT s.*, CASE WHEN Age BETWEEN 18 AND 100 AND NOT coalesce(Credit_History_Age_Years > Age, false) THEN Age END AS Age_clean,
 CASE WHEN Age BETWEEN 18 AND 100 AND coalesce(Credit_History_Age_Years > Age, false) THEN 1 ELSE 0 END AS Age_History_Inconsistent,
 CASE WHEN Age IS NOT NULL AND (Age NOT BETWEEN 18 AND 100 OR coalesce(Credit_History_Age_Years > Age, false)) THEN 1 ELSE 0 END AS Age_was_invalid FROM {source} s),
{out}_c AS (SELECT {key}, age_median, abs(log_income_median - ln(1 + greatest(Annual_Income, 0))) AS dist, row_number() OVER (PARTITION BY {key}
 ORDER BY abs(log_income_median - ln(1 + greatest(Annual_Income, 0))), age_median, Age_Bin) AS place FROM {out}_a JOIN age_lookup USING (Occupation)
 WHERE Age_clean IS NULL AND Annual_Income IS NOT NULL),
{out}_n AS (SELECT {key}, max(CASE WHEN place = 1 THEN age_median END) AS near_age, max(CASE WHEN place = 1 THEN dist END) AS d1, max(CASE WHEN place = 2 THEN dist END) AS d2
 FROM {out}_c WHERE place <= 2 GROUP BY 1),
{out} AS (SELECT a.*, CAST(round(CAST(coalesce(Age_clean, CASE WHEN d1 IS NOT NULL AND (d2 IS NULL OR d2 - d1 >= 0.05) THEN near_age END, occ_median, overall) AS DOUBLE)) AS INTEGER) AS Age_imputed,
 CASE WHEN Age_clean IS NOT NULL THEN 'original' WHEN d1 IS NOT NULL AND (d2 IS NULL OR d2 - d1 >= 0.05) THEN 'occupation_income_age_bin'
 WHEN occ_median IS NOT NULL THEN 'occupation_median' ELSE 'overall_median' END AS Age_imputation_method
 FROM {out}_a a LEFT JOIN {out}_n USING ({key}) LEFT JOIN age_occ USING (Occupation), age_all)"""


def _fit_counts(raw: str, kind: str, least: int) -> str:
    return f"""{kind}_cap AS (SELECT quantile_disc({raw}, 0.95) AS cap FROM aged WHERE data_split = 'train'),
{kind}_fit AS (SELECT Occupation, Age_Bin, CASE WHEN {raw} BETWEEN 0 AND cap THEN {raw} END AS clean FROM aged, {kind}_cap WHERE data_split = 'train'),
{kind}_group AS (SELECT Occupation, Age_Bin, quantile_disc(clean, 0.5) AS g FROM {kind}_fit GROUP BY ALL HAVING count(clean) >= {least}),
{kind}_occ AS (SELECT Occupation, quantile_disc(clean, 0.5) AS o FROM {kind}_fit GROUP BY 1),
{kind}_all AS (SELECT quantile_disc(clean, 0.5) AS t FROM {kind}_fit)"""


def _apply_counts(raw: str, stem: str, kind: str, source: str, out: str) -> str:
    return f"""{out} AS (SELECT s.*, CASE WHEN {raw} BETWEEN 0 AND cap THEN {raw} END AS {stem}_clean,
 CASE WHEN {raw} NOT BETWEEN 0 AND cap THEN 1 ELSE 0 END AS {stem}_Was_Invalid,
 CAST(round(CAST(coalesce(CASE WHEN {raw} BETWEEN 0 AND cap THEN {raw} END, g, o, t) AS DOUBLE)) AS INTEGER) AS {stem}_imputed,
 CASE WHEN {raw} BETWEEN 0 AND cap THEN 'original' WHEN g IS NOT NULL THEN 'occupation_age_bin_median' WHEN o IS NOT NULL THEN 'occupation_median'
 ELSE 'overall_median' END AS {stem}_imputation_method
 FROM {source} s LEFT JOIN {kind}_group USING (Occupation, Age_Bin) LEFT JOIN {kind}_occ USING (Occupation), {kind}_cap, {kind}_all)"""


JOINED = """joined AS (SELECT p.loan_id, p.Customer_ID, p.label, p.label_date AS labels_snapshot_date, p.data_split, a.Age, a.Occupation,
 a.snapshot_date AS attributes_snapshot_date, f.* EXCLUDE (Customer_ID, snapshot_date), f.snapshot_date AS financials_snapshot_date
 FROM split_panel p LEFT JOIN attributes a USING (Customer_ID) LEFT JOIN financials f USING (Customer_ID) WHERE p.data_split IS NOT NULL)"""

AGE_FIT = f"""age_fit AS (SELECT Occupation, Age AS clean, ln(1 + greatest(Annual_Income, 0)) AS li FROM joined WHERE data_split = 'train' AND Age BETWEEN 18 AND 100
 AND Annual_Income IS NOT NULL AND Occupation IS NOT NULL),
age_e AS ({_edges('clean', 'age_fit')}),
age_lookup AS (SELECT Occupation, {_bin('clean', 'e')} AS Age_Bin, quantile_disc(li, 0.5) AS log_income_median, quantile_disc(clean, 0.5) AS age_median, count(*) AS count
 FROM age_fit, age_e GROUP BY ALL HAVING count(*) >= 20),
age_occ AS (SELECT Occupation, quantile_disc(clean, 0.5) AS occ_median FROM age_fit GROUP BY 1),
age_all AS (SELECT quantile_disc(clean, 0.5) AS overall FROM age_fit)"""

AGED = f"""{_apply_age('joined', 'age_done', 'loan_id', False)},
age_f AS ({_edges('Age_imputed', 'age_done', "WHERE data_split = 'train'")}),
aged AS (SELECT a.*, {_bin('Age_imputed', 'e')} AS Age_Bin FROM age_done a, age_f)"""

COUNTS = f"""{_fit_counts('Num_Bank_Accounts', 'bank', 30)},
{_fit_counts('Num_Credit_Card', 'card', 10)},
{_apply_counts('Num_Bank_Accounts', 'Bank_Accounts', 'bank', 'aged', 'banked')},
{_apply_counts('Num_Credit_Card', 'Credit_Cards', 'card', 'banked', 'carded')},
bank_e AS ({_edges('Bank_Accounts_imputed', 'carded', "WHERE data_split = 'train'")}),
card_e AS ({_edges('Credit_Cards_imputed', 'carded', "WHERE data_split = 'train'")})"""

RATIOS = f"""made AS (SELECT c.* EXCLUDE (Changed_Credit_Limit), coalesce(Changed_Credit_Limit, lm) AS Changed_Credit_Limit,
 {_bin('Bank_Accounts_imputed', 'b.e')} AS Bank_Accounts_Imputed_Bin, {_bin('Credit_Cards_imputed', 'k.e')} AS Credit_Cards_Imputed_Bin,
 Num_Bank_Accounts + Num_Credit_Card + Num_of_Loan_Cleaned AS Num_Fin_Pdts, Outstanding_Debt / nullif(Bank_Accounts_clean + Credit_Cards_clean, 0) AS Debt_per_Credit_Account,
 Num_of_Delayed_Payment / nullif(Credit_Cards_clean, 0) AS Delayed_Payments_per_Card, Interest_Rate * Outstanding_Debt AS InterestRate_x_Debt
 FROM carded c LEFT JOIN limit_med USING (Credit_Mix, Payment_of_Min_Amount), bank_e b, card_e k),
"""
LIMIT = """limit_med AS (SELECT Credit_Mix, Payment_of_Min_Amount, quantile_disc(Changed_Credit_Limit, 0.5) AS lm FROM joined WHERE data_split = 'train' GROUP BY ALL)"""
BASE = f"WITH @split_panel, @attributes, @financials, {JOINED}, {AGE_FIT}"
GOLD = f"{BASE}, {AGED}, {COUNTS}, {LIMIT}, {RATIOS.rstrip().rstrip(',')}"


def joined(spark, d):
    """Labels of all splits with their sources."""
    rows = join_sources(labels(spark, d), people(spark, d), financials(spark, d))
    return rows.withColumn("data_split", split_of("labels_snapshot_date", WINDOWS)).filter("data_split IS NOT NULL")


@query("fs9_limit_imputation", f"{BASE}, {LIMIT} SELECT loan_id, coalesce(Changed_Credit_Limit, lm) AS Changed_Credit_Limit FROM joined LEFT JOIN limit_med "
       "USING (Credit_Mix, Payment_of_Min_Amount)")
def fs9(spark, d):
    rows, keys = joined(spark, d), ["Credit_Mix", "Payment_of_Min_Amount"]
    fitted = fit_group_medians(rows.filter("data_split = 'train'"), "Changed_Credit_Limit", keys, "m")
    return fill_from(rows, "Changed_Credit_Limit", fitted, keys, "m").select("loan_id", "Changed_Credit_Limit")


@query("fs10_age_flags_at_apply", f"{BASE}, {_apply_age('joined', 'age_done', 'loan_id', False)} SELECT loan_id, Age_clean, Age_History_Inconsistent, Age_was_invalid FROM age_done")
def fs10(spark, d):
    return age_for_apply(joined(spark, d)).select("loan_id", "Age_clean", "Age_History_Inconsistent", "Age_was_invalid")


@query("fs10_age_flags_at_fit", f"""{BASE} SELECT loan_id, CASE WHEN Age BETWEEN 18 AND 100 THEN Age END AS Age_clean,
 CASE WHEN Age BETWEEN 18 AND 100 AND coalesce(Credit_History_Age_Years > Age, false) THEN 1 ELSE 0 END AS Age_History_Inconsistent,
 CASE WHEN Age NOT BETWEEN 18 AND 100 THEN 1 ELSE 0 END AS Age_was_invalid FROM joined""")
def fs10_fit(spark, d):
    return age_for_fit(joined(spark, d)).select("loan_id", "Age_clean", "Age_History_Inconsistent", "Age_was_invalid")


@query("fs11_age_lookup", f"{BASE} SELECT Occupation, Age_Bin, round(log_income_median, 8) AS log_income_median, CAST(age_median AS DOUBLE) AS age_median, count FROM age_lookup")
def fs11_lookup(spark, d):
    found = fit_age(joined(spark, d).filter("data_split = 'train'"))["age_income_lookup"]
    return found.withColumn("log_income_median", F.round("log_income_median", 8))


@query("fs11_age_imputation", f"{BASE}, {AGED} SELECT loan_id, Age_imputed, Age_imputation_method, Age_Bin FROM aged")
def fs11(spark, d):
    rows = materialize(joined(spark, d).select("loan_id", "data_split", "Age", "Occupation", "Annual_Income", "Credit_History_Age_Years"))
    fitted = fit_age(rows.filter("data_split = 'train'"))
    args = (materialize(fitted["age_income_lookup"]), materialize(fitted["occupation_age_median"]), fitted["overall_age_median"])
    edges = integer_quartiles(apply_age(rows.filter("data_split = 'train'"), *args), ["Age_imputed"])["Age_imputed"]
    return apply_age(rows, *args, edges).select("loan_id", "Age_imputed", "Age_imputation_method", "Age_Bin")


@query("fs12_quantile_bins", f"WITH e AS ({_edges('p_size', 'part')}) SELECT p_partkey, p_size, {_bin('p_size', 'e')} AS size_bin FROM part, e")
def fs12(spark, d):
    parts = table(spark, d, "part")
    return parts.select("p_partkey", "p_size", labelled_bin("p_size", quartile_edges(parts, "p_size")).alias("size_bin"))


@query("fs13_count_imputation", f"{BASE}, {AGED}, {COUNTS} SELECT loan_id, Bank_Accounts_clean, Bank_Accounts_Was_Invalid, Bank_Accounts_imputed, Bank_Accounts_imputation_method FROM carded")
def fs13(spark, d):
    rows = materialize(joined(spark, d).select("loan_id", "data_split", "Age", "Occupation", "Annual_Income", "Credit_History_Age_Years", "Num_Bank_Accounts"))
    train = rows.filter("data_split = 'train'")
    fitted = fit_age(train)
    args = (materialize(fitted["age_income_lookup"]), materialize(fitted["occupation_age_median"]), fitted["overall_age_median"])
    edges = integer_quartiles(apply_age(train, *args), ["Age_imputed"])["Age_imputed"]
    aged = materialize(apply_age(rows, *args, edges))
    found = fit_counts(aged.filter("data_split = 'train'"), {"Num_Bank_Accounts": 30})["Num_Bank_Accounts"]
    return apply_counts(aged, "Num_Bank_Accounts", "Bank_Accounts", **found).select(
        "loan_id", "Bank_Accounts_clean", "Bank_Accounts_Was_Invalid", "Bank_Accounts_imputed", "Bank_Accounts_imputation_method")


@query("fs14_ratios", """WITH @financials SELECT Customer_ID, Num_Bank_Accounts + Num_Credit_Card + Num_of_Loan_Cleaned AS Num_Fin_Pdts,
 Outstanding_Debt / nullif(Num_Bank_Accounts + Num_Credit_Card, 0) AS Debt_per_Credit_Account, Num_of_Delayed_Payment / nullif(Num_Credit_Card, 0) AS Delayed_Payments_per_Card,
 Interest_Rate * Outstanding_Debt AS InterestRate_x_Debt FROM financials""")
def fs14(spark, d):
    rows = financials(spark, d).withColumns({"Bank_Accounts_clean": F.col("Num_Bank_Accounts"), "Credit_Cards_clean": F.col("Num_Credit_Card")})
    return derived_ratios(rows).select("Customer_ID", "Num_Fin_Pdts", "Debt_per_Credit_Account", "Delayed_Payments_per_Card", "InterestRate_x_Debt")


COUNT_SQL = ", ".join(f"nullif(count(*) FILTER (days <= {w}), 0) AS click_count_{w}d" for w in (7, 14, 21))
TREND_SQL = ", ".join(f"round(avg({c}) FILTER (days <= 7) - avg({c}) FILTER (days BETWEEN 8 AND 14), 7) AS {c}_trend_7d" for c in ("fe_1", "fe_2", "fe_3"))


@query("fs15_lookback_features", LOOKBACK_PAIRS.replace("SELECT Customer_ID, labels_snapshot_date, fe_1, fe_2, fe_3,", "SELECT Customer_ID, labels_snapshot_date, clicks_snapshot_date, fe_1, fe_2, fe_3,")
       + ", w AS (SELECT Customer_ID, labels_snapshot_date, " + _window_sql(["mean", "max", "min", "std"], features=("fe_1", "fe_2", "fe_3"))
       + f", {COUNT_SQL}, {TREND_SQL} FROM p WHERE days <= 21 GROUP BY ALL), l AS (SELECT Customer_ID, labels_snapshot_date, max(struct_pack(at := clicks_snapshot_date, a := fe_1, b := fe_2, c := coalesce(fe_3, -1))) AS m "
       "FROM p GROUP BY ALL) SELECT w.*, l.Customer_ID, l.labels_snapshot_date, m.a AS fe_1_latest, m.b AS fe_2_latest, nullif(m.c, -1) AS fe_3_latest FROM l LEFT JOIN w "
       "USING (Customer_ID, labels_snapshot_date)".replace("SELECT w.*, l.Customer_ID, l.labels_snapshot_date,", "SELECT w.* EXCLUDE (Customer_ID, labels_snapshot_date), Customer_ID, labels_snapshot_date,"))
def fs15(spark, d):
    made = lookback(view(spark, d, "clicks"), label_keys(spark, d), ["Customer_ID"], "clicks_snapshot_date", "labels_snapshot_date",
                    ["fe_1", "fe_2", "fe_3"], (7, 14, 21), trend=7, latest=True, dedupe=False)
    digits = {c: 7 if "_trend_" in c else 8 for c in made.columns if "_trend_" in c or c[-1] == "d" and c.startswith("fe_")}
    return made.withColumns({c: F.round(c, n) for c, n in digits.items()})


FEATURES = ["loan_id", "labels_snapshot_date", "attributes_snapshot_date", "financials_snapshot_date", "data_split", "Occupation", "Annual_Income",
            "Changed_Credit_Limit", "Age_imputed", "Age_Bin", "Bank_Accounts_imputed", "Bank_Accounts_Imputed_Bin", "Credit_Cards_imputed",
            "Credit_Cards_Imputed_Bin", "Num_Fin_Pdts", "Debt_per_Credit_Account", "Delayed_Payments_per_Card", "InterestRate_x_Debt"]
CLICKS = list(CLICK_FEATURES)
OTHER_CLICKS = ["fe_1_latest", "fe_4_median_60d", "fe_9_max_30d", "click_count_90d", "fe_5_min_60d"]


def _click_sql(name):
    """A click feature by its name: an aggregate over the pairs of key date and click, ``days`` apart."""
    stem, days = name.rsplit("_", 1)
    if name.endswith("_latest"):
        return f"max_by({name.removesuffix('_latest')}, struct_pack(d := -days, {', '.join(f'{c} := {c}' for c in CLICK_COLUMNS)})) AS {name}"
    if "click_count" in name:
        return f"nullif(count(*) FILTER (days <= {days[:-1]}), 0) AS {name}"
    column, stat = stem.rsplit("_", 1)
    if stat == "trend":
        d = int(days[:-1])
        return f"avg({column}) FILTER (days <= {d}) - avg({column}) FILTER (days BETWEEN {d + 1} AND {2 * d}) AS {name}"
    made = {"mean": "avg({c})", "max": "max({c})", "min": "min({c})", "std": "stddev_samp({c})", "median": "quantile_disc({c}, 0.5)"}[stat].format(c=column)
    return f"{made} FILTER (days <= {days[:-1]}) AS {name}"


CLICK_COLUMNS = ("fe_1", "fe_3", "fe_4", "fe_5", "fe_8", "fe_9", "fe_10", "fe_14", "fe_16")


def _gold_clicks(names):
    """The click features of the gold rows in SQL, and all columns."""
    return GOLD.replace("WITH @split_panel", "WITH @split_panel, @order_clicks") + f""", c AS (SELECT DISTINCT * FROM order_clicks),
 pairs AS (SELECT k.Customer_ID, k.labels_snapshot_date, {", ".join(CLICK_COLUMNS)}, date_diff('day', clicks_snapshot_date, k.labels_snapshot_date) AS days
 FROM (SELECT DISTINCT Customer_ID, labels_snapshot_date FROM joined) k JOIN c USING (Customer_ID) WHERE date_diff('day', clicks_snapshot_date, k.labels_snapshot_date) >= 1),
 near AS (SELECT Customer_ID, labels_snapshot_date, {", ".join(_click_sql(n) for n in names if not n.endswith("_latest"))} FROM pairs WHERE days <= 90 GROUP BY ALL),
 last AS (SELECT Customer_ID, labels_snapshot_date, {", ".join([_click_sql(n) for n in names if n.endswith("_latest")] or ["count(*) AS n_clicks"])} FROM pairs GROUP BY ALL)"""


@query("fs16_gold_feature_store", _gold_clicks(CLICKS) + " SELECT " + ", ".join(FEATURES) + ", " + ", ".join(f"round({c}, 6) AS {c}" for c in CLICKS)
       + " FROM made LEFT JOIN near USING (Customer_ID, labels_snapshot_date)")
def fs16(spark, d):
    made, _ = feature_store(labels(spark, d), people(spark, d), financials(spark, d), WINDOWS, view(spark, d, "order_clicks"), TRAIN_DATE)
    return made.select(*FEATURES, *[F.round(c, 6).alias(c) for c in CLICKS])


@query("fs16_other_click_features", _gold_clicks(OTHER_CLICKS) + " SELECT loan_id, labels_snapshot_date, " + ", ".join(OTHER_CLICKS)
       + " FROM made LEFT JOIN near USING (Customer_ID, labels_snapshot_date) LEFT JOIN last USING (Customer_ID, labels_snapshot_date)")
def fs16_other(spark, d):
    """Last values, medians, extremes and counts, asked for by name."""
    made, _ = feature_store(labels(spark, d), people(spark, d), financials(spark, d), WINDOWS, view(spark, d, "order_clicks"), TRAIN_DATE,
                            click_features=OTHER_CLICKS)
    return made.select("loan_id", "labels_snapshot_date", *OTHER_CLICKS)


METHODS = [("Age", "Age_imputation_method"), ("Bank_Accounts", "Bank_Accounts_imputation_method"), ("Credit_Cards", "Credit_Cards_imputation_method")]


@query("agg29_method_counts", GOLD + ", u AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, {c} AS method FROM made" for f, c in METHODS)
       + ") SELECT feature, method, count(*) AS n, round(count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY feature), 9) AS share FROM u GROUP BY feature, method")
def agg29(spark, d):
    """How often each method filled each imputed feature of the gold store."""
    made, _ = feature_store(labels(spark, d), people(spark, d), financials(spark, d), WINDOWS, train_date=TRAIN_DATE, drop=())
    return method_counts(made).withColumn("share", F.round("share", 9))


@query("fs17_gold_without_limit_and_clicks", GOLD.replace("coalesce(Changed_Credit_Limit, lm) AS Changed_Credit_Limit", "Changed_Credit_Limit")
       + " SELECT loan_id, Changed_Credit_Limit, Age_imputed, Bank_Accounts_imputed, Credit_Cards_imputed, Debt_per_Credit_Account FROM made")
def fs17(spark, d):
    made, _ = feature_store(labels(spark, d), people(spark, d), financials(spark, d), WINDOWS, train_date=TRAIN_DATE, with_limit=False)
    return made.select("loan_id", "Changed_Credit_Limit", "Age_imputed", "Bank_Accounts_imputed", "Credit_Cards_imputed", "Debt_per_Credit_Account")


def fitted(spark, d):
    """Parameters fitted on the panel."""
    return feature_store(labels(spark, d), people(spark, d), financials(spark, d), WINDOWS, train_date=TRAIN_DATE)[1]


@query("fs18_parameter_tables", f"""{BASE}, {AGED}, {COUNTS}, {LIMIT},
 g AS (SELECT 'changed_credit_limit' AS param, Credit_Mix AS key1, Payment_of_Min_Amount AS key2, 'Changed_Credit_Limit_Median' AS field, CAST(lm AS DOUBLE) AS value FROM limit_med
 UNION ALL SELECT 'occupation_age_median', Occupation, NULL, 'occupation_age_median', occ_median FROM age_occ
 UNION ALL SELECT 'bank_group_stats', Occupation, Age_Bin, 'median', g FROM bank_group UNION ALL SELECT 'bank_occupation_median', Occupation, NULL, 'occupation_median', o FROM bank_occ
 UNION ALL SELECT 'card_group_stats', Occupation, Age_Bin, 'median', g FROM card_group UNION ALL SELECT 'card_occupation_median', Occupation, NULL, 'occupation_median', o FROM card_occ
 UNION ALL SELECT 'scalar', 'bank_p95', NULL, 'value', cap FROM bank_cap UNION ALL SELECT 'scalar', 'card_p95', NULL, 'value', cap FROM card_cap
 UNION ALL SELECT 'scalar', 'overall_age_median', NULL, 'value', overall FROM age_all UNION ALL SELECT 'scalar', 'bank_overall_median', NULL, 'value', t FROM bank_all
 UNION ALL SELECT 'scalar', 'card_overall_median', NULL, 'value', t FROM card_all
 UNION ALL SELECT 'age_income_lookup', Occupation, Age_Bin, 'log_income_median', round(log_income_median, 8) FROM age_lookup UNION ALL SELECT 'age_income_lookup', Occupation, Age_Bin, 'age_median', age_median FROM age_lookup
 UNION ALL SELECT 'age_income_lookup', Occupation, Age_Bin, 'count', count FROM age_lookup
 UNION ALL SELECT 'edge', 'age', CAST(i - 1 AS VARCHAR), 'value', e[i] FROM age_f, (SELECT unnest(range(1, 6)) AS i) WHERE i <= len(e)
 UNION ALL SELECT 'edge', 'bank', CAST(i - 1 AS VARCHAR), 'value', e[i] FROM bank_e, (SELECT unnest(range(1, 6)) AS i) WHERE i <= len(e)
 UNION ALL SELECT 'edge', 'card', CAST(i - 1 AS VARCHAR), 'value', e[i] FROM card_e, (SELECT unnest(range(1, 6)) AS i) WHERE i <= len(e))
 SELECT * FROM g WHERE key1 IS NOT NULL""")
def fs18(spark, d):
    path = fresh_path(spark, "params")
    fitted(spark, d).save(spark, path)
    params = load_params(spark, path, TRAIN_DATE)
    value = F.when(F.col("field") == "log_income_median", F.round("value", 8)).otherwise(F.col("value")).alias("value")
    groups = params.group_rows().select("param", "key1", "key2", "field", value)
    edges = params.edge_rows(spark).select(F.lit("edge").alias("param"), F.col("param").alias("key1"), F.col("pos").cast("string").alias("key2"),
                                           F.lit("value").alias("field"), F.col("edge").alias("value"))
    scalars = params.scalar_rows(spark).select(F.lit("scalar").alias("param"), F.col("name").alias("key1"), F.lit(None).cast("string").alias("key2"),
                                               F.lit("value").alias("field"), "value")
    return groups.unionByName(scalars).unionByName(edges).filter("key1 IS NOT NULL")


@query("fs19_inference_features", f"""{BASE}, {AGED}, {COUNTS}, {LIMIT},
 apps AS (SELECT concat(f.Customer_ID, '_', strftime(f.snapshot_date, '%Y_%m_%d')) AS loan_id, a.Age, a.Occupation, f.* FROM financials f LEFT JOIN
 (SELECT Customer_ID, Age, Occupation FROM attributes) a USING (Customer_ID)),
 {_apply_age('apps', 'app_age', 'loan_id', False)}, app_binned AS (SELECT a.*, {_bin('Age_imputed', 'e')} AS Age_Bin FROM app_age a, age_f),
 {_apply_counts('Num_Bank_Accounts', 'Bank_Accounts', 'bank', 'app_binned', 'app_bank')}, {_apply_counts('Num_Credit_Card', 'Credit_Cards', 'card', 'app_bank', 'app_card')}
 SELECT loan_id, CAST(Age_imputed AS DOUBLE) AS Age_imputed, Age_Bin, CAST(Bank_Accounts_imputed AS DOUBLE) AS Bank_Accounts_imputed,
 CAST(Credit_Cards_imputed AS DOUBLE) AS Credit_Cards_imputed, coalesce(Changed_Credit_Limit, lm) AS Changed_Credit_Limit,
 Outstanding_Debt / nullif(Bank_Accounts_clean + Credit_Cards_clean, 0) AS Debt_per_Credit_Account, '{TRAIN_DATE}' AS feature_params_date
 FROM app_card LEFT JOIN limit_med USING (Credit_Mix, Payment_of_Min_Amount)""")
def fs19(spark, d):
    path = fresh_path(spark, "params")
    fitted(spark, d).save(spark, path)
    made = inference_features(financials(spark, d), people(spark, d), load_params(spark, path, TRAIN_DATE))
    return made.select("loan_id", "Age_imputed", "Age_Bin", "Bank_Accounts_imputed", "Credit_Cards_imputed", "Changed_Credit_Limit",
                       "Debt_per_Credit_Account", "feature_params_date")


@query("fs20_parameters_in_force", """WITH @roles, @months SELECT month, champion, as_of AS model_train_date FROM months ASOF LEFT JOIN roles ON month >= effective_from
 LEFT JOIN (SELECT model_version AS champion, as_of FROM runs) USING (champion)""")
def fs20(spark, d):
    models = runs(spark, d).select("model_version", F.col("as_of").alias("model_train_date"))
    return params_in_force(months(spark, d), roles(spark, d), models)


BOTH_DATES = ("2000-06-01", TRAIN_DATE)
#: Bytes of a row group of the backfill's rows: a group is read by one task, and each row costs much more than reading it.
GROUP_BYTES = 16 << 20


@query("fs20_backfill_over_dates", f"""WITH @split_panel SELECT CASE WHEN label_date < DATE '2000-09-01' THEN '{BOTH_DATES[0]}' ELSE '{BOTH_DATES[1]}' END AS params_date, count(*) AS n, count(*) AS n_same
 FROM split_panel WHERE data_split IS NOT NULL GROUP BY 1""")
def fs20_backfill(spark, d):
    """Months before and after a change of the model in force, each by the parameters of its model, in one job; against a run for each date."""
    path, rows = fresh_path(spark, "params"), joined(spark, d)
    rows = materialize(rows.withColumn("params_date", F.when(F.col("labels_snapshot_date") < "2000-09-01", BOTH_DATES[0]).otherwise(BOTH_DATES[1])), "rows", GROUP_BYTES)
    for day in BOTH_DATES:
        fit_params(rows.filter((F.col("data_split") == "train") & (F.col("labels_snapshot_date") < F.add_months(F.lit(day).cast("date"), -5))), day).save(spark, path)
    once = apply_dated_params(rows, load_dated_params(spark, path))
    names = sorted(set(once.columns) - {"params_date"})
    key = F.xxhash64(*names)
    each = [apply_params(rows.filter(F.col("params_date") == day), load_params(spark, path, day)).select("loan_id", key.alias("expected")) for day in BOTH_DATES]
    both = once.select("loan_id", "params_date", key.alias("got")).join(each[0].unionByName(each[1]), "loan_id")
    return both.groupBy("params_date").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("got") == F.col("expected"), 1)).alias("n_same"))


@query("fs22_monthly_silver", f"""WITH @financials SELECT Customer_ID, snapshot_date, Annual_Income, Type_of_Loan_Cleaned, Credit_History_Age_Years, {HOT} FROM financials
 WHERE snapshot_date BETWEEN DATE '1999-01-01' AND DATE '1999-06-01'""")
def fs22(spark, d):
    raw, base = view(spark, d, "financials_raw"), fresh_path(spark, "monthly")
    raw.write.option("header", "true").option("nullValue", "\u0000").csv(f"{base}/raw")
    days = raw.filter("snapshot_date BETWEEN '1999-01-01' AND '1999-06-01'").select(F.col("snapshot_date").cast("date").alias("snapshot_date"))
    land(spark, "features_financials", [f"{base}/raw"], raw.columns, f"{base}/bronze", days=days)
    month = spark.read.parquet(f"{base}/bronze").select(
        *[F.when(F.col(c).cast("string") != "\u0000", F.col(c).cast("string")).alias(c) for c in raw.columns])
    hot = [c.split(" AS ")[-1] for c in HOT.split(", CASE")]
    return silver_financials(month, financial_vocabulary(raw)).select(
        "Customer_ID", "snapshot_date", "Annual_Income", "Type_of_Loan_Cleaned", "Credit_History_Age_Years", *hot)


@query("flt7_model_cleaning", """WITH @financials SELECT Customer_ID, CASE WHEN Interest_Rate > 50 THEN NULL ELSE Interest_Rate END AS Interest_Rate,
 CASE WHEN greatest(Num_Credit_Inquiries, 0) > 30 THEN NULL ELSE greatest(Num_Credit_Inquiries, 0) END AS Num_Credit_Inquiries,
 CASE WHEN Interest_Rate > 50 THEN NULL ELSE Interest_Rate * Outstanding_Debt END AS InterestRate_x_Debt, Payment_Behaviour_Imputed FROM financials""")
def model_cleaning(spark, d):
    rows = financials(spark, d).drop("Credit_Mix", "Payment_of_Min_Amount")
    return clean_rows(rows).select("Customer_ID", "Interest_Rate", "Num_Credit_Inquiries", "InterestRate_x_Debt", "Payment_Behaviour_Imputed")
