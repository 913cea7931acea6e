"""Projections, filters, cleaning and scalar functions."""

from pyspark.sql import functions as F

from panelkit.functions.dates import month_start
from panelkit.functions.encode import collapse, collected_levels, multi_hot, one_hot, vocabulary
from panelkit.functions.numeric import (INVALID_RULES, apply_rules, at_least, clip, first_method, log1p_floor, map_codes, ratio,
                                        round_half_up, signed_log, status, within, worst_status)
from panelkit.functions.text import (blank_to, clean_list, column_name, feature_stem, replace_token, spell_undefined,
                                     strip_underscores, years_of)
from panelkit.operators.impute import median_fill
from panelkit.operators.profile import sample_skewness
from panelkit.operators.quality import any_null, column_roles, rule_counts
from panelkit.operators.quantiles import collect_quantiles
from panelkit.plans.inference import business_key
from panelkit.plans.silver import delinquency, financial_vocabulary, silver_financials
from panelkit.sources.schema import enforce, prefixed, to_number, unique_columns
from workload.registry import query
from workload.views import as_text, table, view

# ---- projections ----------------------------------------------------------------------------------------------------
DIRTY = {"id": "loan_id", "amount": "CASE WHEN label = 1 THEN 'n/a' ELSE CAST(x1 AS {t}) END",
         "count": "CASE WHEN model = '2-HIGH' THEN '' WHEN model = '5-LOW' THEN '12x' ELSE loan_id END",
         "day": "CASE WHEN model = '3-MEDIUM' THEN 'no day' ELSE CAST(label_date AS {t}) END"}


@query("o_cast_enforced_types", "WITH @panel, raw AS (SELECT " + ", ".join(f"{e.format(t='VARCHAR')} AS {c}" for c, e in DIRTY.items())
       + " FROM panel) SELECT id, TRY_CAST(amount AS DOUBLE) AS amount, TRY_CAST(count AS INTEGER) AS count, TRY_CAST(day AS DATE) AS day FROM raw")
def o_cast(spark, d):
    raw = view(spark, d, "panel").selectExpr(*[f"{e.format(t='STRING')} AS {c}" for c, e in DIRTY.items()])
    return enforce(raw, {"amount": "double", "count": "int", "day": "date"})


@query("prj1_source_dates", """WITH @attributes, @financials SELECT Customer_ID, a.snapshot_date AS attributes_snapshot_date,
 f.snapshot_date AS financials_snapshot_date FROM attributes a JOIN financials f USING (Customer_ID)""".replace("@attributes, @financials", "@attributes, @financials"))
def prj1(spark, d):
    people, money = (view(spark, d, f"{n}_raw").select("Customer_ID", F.col("snapshot_date").cast("date").alias("snapshot_date"))
                     .withColumnsRenamed({"snapshot_date": f"{n}_snapshot_date"}) for n in ("attributes", "financials"))
    return people.join(money, "Customer_ID")


@query("prj2_select_and_drop", "WITH @panel SELECT loan_id, month, score FROM panel")
def prj2(spark, d):
    return view(spark, d, "panel").drop("Customer_ID", "label", "label_date", "model", "x1", "x2", "x3", "level")


@query("prj3_provenance", """WITH @panel SELECT loan_id, '30dpd_6mob' AS label_def, 'champion' AS model_role,
 '2001-06-01' AS feature_params_date FROM panel""")
def prj3(spark, d):
    return view(spark, d, "panel").select("loan_id", F.lit("30dpd_6mob").alias("label_def"), F.lit("champion").alias("model_role"),
                                          F.lit("2001-06-01").alias("feature_params_date"))


@query("prj4_natural_row_key", """WITH @panel, s AS (SELECT loan_id, label_date, score FROM panel WHERE score >= 0.5)
 SELECT p.loan_id, p.label_date, s.score IS NOT NULL AS matched FROM panel p LEFT JOIN s USING (loan_id, label_date)""")
def prj4(spark, d):
    panel = view(spark, d, "panel")
    key = ["loan_id", "label_date"]
    high = panel.filter("score >= 0.5").select(*key, F.lit(True).alias("matched"))
    return panel.select(*key).join(high, key, "left").fillna(False, ["matched"])


@query("prj5_business_key", """WITH @panel SELECT concat(Customer_ID, '_', strftime(label_date, '%Y_%m_%d')) AS loan_key, label FROM panel""")
def prj5(spark, d):
    return view(spark, d, "panel").select(business_key("Customer_ID", "label_date").alias("loan_key"), "label")


@query("prj6_prefixed_columns", "WITH @clicks SELECT fe_1, fe_2, fe_3 FROM clicks")
def prj6(spark, d):
    clicks = view(spark, d, "clicks")
    return clicks.select(*prefixed(clicks, "fe_"))


@query("prj7_unique_columns", "WITH @panel SELECT loan_id, label, score FROM panel")
def prj7(spark, d):
    return view(spark, d, "panel").select(*unique_columns(["loan_id", "label", "score", "label", "loan_id"]))


@query("prj8_column_roles", """WITH @panel, r AS (SELECT bool_and(label IN (0, 1)) AS label, bool_and(score IN (0, 1)) AS score,
 bool_and(coalesce(x3 IN (0, 1), true)) AS x3 FROM panel)
 SELECT 'model' AS feature, 'categorical' AS type UNION ALL SELECT 'label', CASE WHEN label THEN 'binary' ELSE 'numeric' END FROM r
 UNION ALL SELECT 'score', CASE WHEN score THEN 'binary' ELSE 'numeric' END FROM r
 UNION ALL SELECT 'x3', CASE WHEN x3 THEN 'binary' ELSE 'numeric' END FROM r""")
def prj8(spark, d):
    found = column_roles(view(spark, d, "panel").select("model", "label", "score", "x3"), ["model"])
    return spark.createDataFrame(list(found.items()), "feature string, type string")


# ---- filters --------------------------------------------------------------------------------------------------------
@query("flt1_month_on_book", "WITH @ledger SELECT loan_id, snapshot_date, overdue_amt FROM ledger WHERE installment_num = 6")
def flt1(spark, d):
    return view(spark, d, "ledger").filter("installment_num = 6").select("loan_id", "snapshot_date", "overdue_amt")


@query("flt2_closed_date_range", "WITH @panel SELECT loan_id, label_date FROM panel WHERE label_date BETWEEN DATE '1999-02-01' AND DATE '1999-03-31'")
def flt2(spark, d):
    return view(spark, d, "panel").filter("label_date BETWEEN DATE '1999-02-01' AND DATE '1999-03-31'").select("loan_id", "label_date")


@query("flt3_valid_range", "WITH @attributes SELECT Customer_ID, Age, CASE WHEN Age BETWEEN 18 AND 100 THEN Age END AS Age_clean FROM attributes")
def flt3(spark, d):
    rows = enforce(view(spark, d, "attributes_raw").withColumn("Age", strip_underscores("Age")), {"Age": "int"})
    return rows.select("Customer_ID", "Age", within("Age", 18, 100).alias("Age_clean"))


@query("flt4_not_null", "WITH @panel SELECT loan_id, x3, level FROM panel WHERE x3 IS NOT NULL AND level IS NOT NULL")
def flt4(spark, d):
    return view(spark, d, "panel").select("loan_id", "x3", "level").dropna(subset=["x3", "level"])


@query("flt5_group_size", "WITH @panel SELECT Customer_ID, count(*) AS n FROM panel GROUP BY Customer_ID HAVING count(*) >= 12")
def flt5(spark, d):
    return view(spark, d, "panel").groupBy("Customer_ID").agg(F.count(F.lit(1)).alias("n")).filter("n >= 12")


@query("flt6_strictly_before", "WITH @clicks SELECT Customer_ID, fe_1 FROM clicks WHERE date_diff('day', clicks_snapshot_date, DATE '2024-01-20') > 0")
def flt6(spark, d):
    return (view(spark, d, "clicks").filter(F.datediff(F.lit("2024-01-20").cast("date"), "clicks_snapshot_date") > 0)
            .select("Customer_ID", "fe_1"))


RULED = "CASE WHEN Interest_Rate > 50 THEN NULL ELSE Interest_Rate END AS Interest_Rate, " \
        "CASE WHEN Num_Credit_Inquiries > 30 THEN NULL ELSE Num_Credit_Inquiries END AS Num_Credit_Inquiries, " \
        "CASE WHEN Num_of_Delayed_Payment > 50 THEN NULL ELSE Num_of_Delayed_Payment END AS Num_of_Delayed_Payment, " \
        "CASE WHEN abs(Monthly_Balance) > 1e9 THEN NULL ELSE Monthly_Balance END AS Monthly_Balance, " \
        "CASE WHEN Amount_invested_monthly = 10000 THEN NULL ELSE Amount_invested_monthly END AS Amount_invested_monthly"


def financials(spark, d):
    """Silver financials without one-hot columns."""
    return silver_financials(view(spark, d, "financials_raw"), {"Loan": [], "Credit_Mix": [], "Payment_of_Min_Amount": []})


@query("flt7_cleaning_rules", f"WITH @financials SELECT Customer_ID, {RULED} FROM financials")
def flt7(spark, d):
    return financials(spark, d).withColumns(apply_rules(INVALID_RULES)).select("Customer_ID", *INVALID_RULES)


@query("flt8_clip_at_zero", """WITH @financials SELECT Customer_ID, CASE WHEN Num_Credit_Inquiries IS NOT NULL THEN greatest(Num_Credit_Inquiries, 0) END
 AS Num_Credit_Inquiries, CASE WHEN Num_of_Delayed_Payment IS NOT NULL THEN greatest(Num_of_Delayed_Payment, 0) END AS Num_of_Delayed_Payment
 FROM financials""")
def flt8(spark, d):
    return financials(spark, d).select("Customer_ID", *[at_least(c, 0).alias(c) for c in ("Num_Credit_Inquiries", "Num_of_Delayed_Payment")])


@query("flt9_completed_cohort", """WITH @ledger SELECT loan_id, loan_start_date, overdue_amt FROM ledger
 WHERE loan_start_date < DATE '1999-01-01' AND installment_num = 7""")
def flt9(spark, d):
    return (view(spark, d, "ledger").filter("loan_start_date < DATE '1999-01-01' AND installment_num = 7")
            .select("loan_id", "loan_start_date", "overdue_amt"))


@query("flt10_any_null", "WITH @panel SELECT loan_id, score, x3, level FROM panel WHERE loan_id IS NULL OR score IS NULL OR x3 IS NULL OR level IS NULL")
def flt10(spark, d):
    return any_null(view(spark, d, "panel").select("loan_id", "score", "x3", "level"))


# ---- text -----------------------------------------------------------------------------------------------------------
@query("str1_strip_underscores", """SELECT p_partkey, TRY_CAST(replace(concat('_', CAST(p_size AS VARCHAR), '__'), '_', '') AS INTEGER) AS size,
 replace(replace(p_name, ' ', '_'), '_', '') AS name FROM part""")
def str1(spark, d):
    raw = table(spark, d, "part").selectExpr("p_partkey", "concat('_', CAST(p_size AS STRING), '__') AS size", "replace(p_name, ' ', '_') AS name")
    return raw.select("p_partkey", strip_underscores("size").try_cast("int").alias("size"), strip_underscores("name").alias("name"))


@query("str2_undefined_mix", """SELECT c_custkey, replace(CASE c_nationkey % 4 WHEN 0 THEN '_' WHEN 1 THEN '__' ELSE 'Good' END, '_', 'Not Defined')
 AS Credit_Mix FROM customer""")
def str2(spark, d):
    raw = table(spark, d, "customer").selectExpr("c_custkey", "CASE c_nationkey % 4 WHEN 0 THEN '_' WHEN 1 THEN '__' ELSE 'Good' END AS Credit_Mix")
    return raw.select("c_custkey", spell_undefined("Credit_Mix").alias("Credit_Mix"))


@query("str3_loan_list", "WITH @financials SELECT Customer_ID, Type_of_Loan_Cleaned FROM financials")
def str3(spark, d):
    return view(spark, d, "financials_raw").select("Customer_ID", clean_list("Type_of_Loan").alias("Type_of_Loan_Cleaned"))


@query("str4_placeholder", "WITH @financials SELECT Customer_ID, Payment_Behaviour_Imputed FROM financials")
def str4(spark, d):
    return view(spark, d, "financials_raw").select("Customer_ID", replace_token(
        "Payment_Behaviour", "!@9#%8", "High_spent_Small_value_payments").alias("Payment_Behaviour_Imputed"))


@query("str5_history_years", "WITH @financials SELECT Customer_ID, Credit_History_Age_Years FROM financials")
def str5(spark, d):
    return view(spark, d, "financials_raw").select("Customer_ID", years_of("Credit_History_Age").alias("Credit_History_Age_Years"))


@query("str6_blank_to_unknown", "WITH @attributes SELECT Customer_ID, coalesce(nullif(Occupation, ''), 'Unknown') AS Occupation FROM attributes")
def str6(spark, d):
    return view(spark, d, "attributes_raw").select("Customer_ID", blank_to(strip_underscores("Occupation")).alias("Occupation"))


@query("str7_column_names", """SELECT level, concat('Loan_', replace(replace(level, ' ', '_'), '-', '_')) AS column_name FROM (WITH @financials
 SELECT DISTINCT unnest(string_split(Type_of_Loan_Cleaned, ',')) AS level FROM financials)""")
def str7(spark, d):
    levels = financial_vocabulary(view(spark, d, "financials_raw"))["Loan"]
    return spark.createDataFrame([(v, "Loan_" + column_name(v)) for v in levels], "level string, column_name string")


@query("str8_feature_stem", """WITH @clicks, m AS (SELECT avg(fe_1) AS fe_1_mean_30d, max(fe_2) AS fe_2_latest, min(fe_3) AS fe_3_min_60d FROM clicks),
 u AS (UNPIVOT m ON COLUMNS(*) INTO NAME feature VALUE value)
 SELECT feature, regexp_extract(feature, '(fe_\\d+)', 1) AS stem, CAST(regexp_extract(feature, 'fe_(\\d+)', 1) AS INTEGER) AS number,
 round(value, 6) AS value FROM u""")
def str8(spark, d):
    wide = view(spark, d, "clicks").agg(F.avg("fe_1").alias("fe_1_mean_30d"), F.max("fe_2").alias("fe_2_latest"), F.min("fe_3").alias("fe_3_min_60d"))
    long = wide.unpivot([], wide.columns, "feature", "value")
    return long.select("feature", feature_stem("feature").alias("stem"), feature_stem("feature", r"fe_(\d+)").cast("int").alias("number"),
                       F.round("value", 6).alias("value"))


@query("str9_median_fill", """WITH @panel, m AS (SELECT quantile_cont(x3, 0.5) AS m3 FROM panel)
 SELECT loan_id, coalesce(x3, m3) AS x3, x2 FROM panel, m""")
def str9(spark, d):
    return median_fill(view(spark, d, "panel").select("loan_id", "x2", "x3"), ["x2", "x3"])


# ---- lists and encodings --------------------------------------------------------------------------------------------
@query("arr1_list_size", "WITH @financials SELECT Customer_ID, Num_of_Loan_Cleaned FROM financials")
def arr1(spark, d):
    cleaned = view(spark, d, "financials_raw").select("Customer_ID", clean_list("Type_of_Loan").alias("l"))
    return cleaned.select("Customer_ID", F.size(F.split("l", ",")).alias("Num_of_Loan_Cleaned"))


@query("arr2_list_elements", "WITH @financials SELECT DISTINCT unnest(string_split(Type_of_Loan_Cleaned, ',')) AS level FROM financials")
def arr2(spark, d):
    return vocabulary(view(spark, d, "financials_raw").select(clean_list("Type_of_Loan").alias("l")), "l", ",")


LOANS = ["Auto Loan", "Debt-Consolidation Loan", "Home Loan", "Not Specified", "Payday Loan", "Personal LoanAuto Loan", "Student Loan"]


@query("arr3_multi_hot", "WITH @financials SELECT Customer_ID, " + ", ".join(
    f"CASE WHEN list_contains(string_split(Type_of_Loan_Cleaned, ','), '{v}') THEN 1 ELSE 0 END AS Loan_{v.replace(' ', '_').replace('-', '_')}"
    for v in LOANS) + " FROM financials")
def arr3(spark, d):
    cleaned = view(spark, d, "financials_raw").select("Customer_ID", clean_list("Type_of_Loan").alias("l"))
    levels = collected_levels(cleaned, {"l": ("l", ",")})["l"]
    return cleaned.withColumns(multi_hot("l", levels, "Loan_")).drop("l")


@query("enc1_one_hot", "WITH @financials SELECT Customer_ID, " + ", ".join(
    f"CASE WHEN Credit_Mix = '{v}' THEN 1 ELSE 0 END AS Credit_Mix_{v.replace(' ', '_')}" for v in ("Bad", "Good", "Not Defined", "Standard"))
       + " FROM financials")
def enc1(spark, d):
    raw = view(spark, d, "financials_raw").select("Customer_ID", spell_undefined("Credit_Mix").alias("Credit_Mix"))
    levels = collected_levels(raw, {"mix": ("Credit_Mix", None)})["mix"]
    return raw.withColumns(one_hot("Credit_Mix", levels, "Credit_Mix_")).drop("Credit_Mix")


@query("enc2_collapse_flags", """WITH @financials SELECT Customer_ID, CASE WHEN Payment_of_Min_Amount IN ('No', 'Yes') THEN Payment_of_Min_Amount
 ELSE 'Unknown' END AS Payment_of_Min_Amount FROM financials""")
def enc2(spark, d):
    flags = view(spark, d, "financials_raw").select("Customer_ID", *[
        e.alias(n) for n, e in one_hot("Payment_of_Min_Amount", ["No", "Yes"], "Pay_").items()])
    return flags.select("Customer_ID", collapse(["Pay_No", "Pay_Yes"], "Pay_").alias("Payment_of_Min_Amount"))


# ---- dates ----------------------------------------------------------------------------------------------------------
@query("dat1_days_past_due", """WITH @silver_loans SELECT loan_id, snapshot_date, mob, installments_missed, first_missed_date, dpd FROM silver_loans""")
def dat1(spark, d):
    return delinquency(view(spark, d, "ledger")).select("loan_id", "snapshot_date", "mob", "installments_missed", "first_missed_date", "dpd")


@query("dat2_to_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def dat2(spark, d):
    return table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"))


@query("dat3_month_period", "SELECT l_orderkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem")
def dat3(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", month_start("l_shipdate").alias("month"))


@query("dat4_days_between", """SELECT l_orderkey, l_shipdate::DATE AS shipped, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))
 AS INTEGER) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def dat4(spark, d):
    items, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", F.to_date("l_shipdate").alias("shipped"), F.datediff("l_shipdate", "o_orderdate").alias("days"))


# ---- numbers --------------------------------------------------------------------------------------------------------
@query("mth1_log1p_floor", "SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 9) AS log_balance FROM customer")
def mth1(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.round(log1p_floor("c_acctbal"), 9).alias("log_balance"))


@query("mth2_distance", "WITH @panel SELECT loan_id, abs(x2 - x3) AS distance FROM panel")
def mth2(spark, d):
    return view(spark, d, "panel").select("loan_id", F.abs(F.col("x2") - F.col("x3")).alias("distance"))


@query("mth3_half_up", "SELECT l_orderkey, CAST(round(l_quantity / 2 - 10) AS INTEGER) AS half FROM lineitem")
def mth3(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", round_half_up(F.col("l_quantity") / 2 - 10).alias("half"))


@query("mth4_safe_ratio", "SELECT c_custkey, c_acctbal / nullif(c_custkey % 5, 0) AS per_account FROM customer")
def mth4(spark, d):
    return table(spark, d, "customer").select("c_custkey", ratio("c_acctbal", F.col("c_custkey") % 5).alias("per_account"))


@query("mth5_interactions", """WITH @financials SELECT Customer_ID, Num_Bank_Accounts + Num_Credit_Card + Num_of_Loan_Cleaned AS Num_Fin_Pdts,
 Interest_Rate * Outstanding_Debt AS InterestRate_x_Debt FROM financials""")
def mth5(spark, d):
    return financials(spark, d).select(
        "Customer_ID", (F.col("Num_Bank_Accounts") + F.col("Num_Credit_Card") + F.col("Num_of_Loan_Cleaned")).alias("Num_Fin_Pdts"),
        (F.col("Interest_Rate") * F.col("Outstanding_Debt")).alias("InterestRate_x_Debt"))


@query("mth6_signed_log", """WITH s AS (SELECT abs(skewness(c_acctbal)) > 1 AS log_balance, abs(skewness(exp(c_acctbal / 2000))) > 1 AS log_large FROM customer)
 SELECT c_custkey, round(CASE WHEN log_balance THEN sign(c_acctbal) * ln(1 + abs(c_acctbal)) ELSE c_acctbal END, 8) AS balance,
 round(CASE WHEN log_large THEN ln(1 + exp(c_acctbal / 2000)) ELSE exp(c_acctbal / 2000) END, 8) AS large FROM customer, s""")
def mth6(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), F.exp(F.col("c_acctbal") / 2000).alias("large"))
    skew = rows.agg(*[sample_skewness(c).alias(c) for c in ("balance", "large")]).first()
    return rows.select("c_custkey", *[F.round(signed_log(c) if abs(skew[c]) > 1 else F.col(c), 8).alias(c) for c in ("balance", "large")])


@query("mth7_winsorise", """WITH @panel, q AS (SELECT quantile_cont(x1, 0.01) AS a1, quantile_cont(x1, 0.99) AS b1, quantile_cont(x3, 0.01) AS a3,
 quantile_cont(x3, 0.99) AS b3 FROM panel) SELECT loan_id, round(least(greatest(x1, a1), b1), 6) AS x1,
 CASE WHEN x3 IS NOT NULL THEN round(least(greatest(x3, a3), b3), 6) END AS x3 FROM panel, q""")
def mth7(spark, d):
    panel = view(spark, d, "panel")
    cuts = collect_quantiles(panel, ["x1", "x3"], [0.01, 0.99])
    return panel.select("loan_id", *[F.round(clip(c, *cuts[c]), 6).alias(c) for c in ("x1", "x3")])


@query("mth8_coalesce_hierarchy", """WITH @panel, o AS (SELECT Customer_ID, max(x3) AS m FROM panel GROUP BY 1), g AS (SELECT model, max(x3) AS m FROM panel GROUP BY 1),
 a AS (SELECT max(x3) AS m FROM panel)
 SELECT loan_id, coalesce(x3, CASE WHEN label = 1 THEN o.m END, CASE WHEN model <> '5-LOW' THEN g.m END, a.m) AS x3
 FROM panel LEFT JOIN o USING (Customer_ID) LEFT JOIN g USING (model), a""")
def mth8(spark, d):
    panel = view(spark, d, "panel")
    own = panel.groupBy("Customer_ID").agg(F.max("x3").alias("own"))
    group = panel.groupBy("model").agg(F.max("x3").alias("grp"))
    overall = panel.agg(F.max("x3")).first()[0]
    return panel.join(own, "Customer_ID", "left").join(group, "model", "left").select("loan_id", F.coalesce(
        "x3", F.when(F.col("label") == 1, F.col("own")), F.when(F.col("model") != "5-LOW", F.col("grp")), F.lit(overall)).alias("x3"))


@query("mth9_threshold_flag", "WITH @panel SELECT loan_id, CASE WHEN score >= 0.35 THEN 1 ELSE 0 END AS predicted_default FROM panel")
def mth9(spark, d):
    return view(spark, d, "panel").select("loan_id", (F.col("score") >= 0.35).cast("int").alias("predicted_default"))


@query("con1_method_label", """WITH @panel SELECT loan_id, CASE WHEN x3 IS NOT NULL THEN 'original' WHEN level IS NOT NULL THEN 'group' ELSE 'overall' END
 AS method FROM panel""")
def con1(spark, d):
    return view(spark, d, "panel").select("loan_id", first_method(
        [(F.col("x3").isNotNull(), "original"), (F.col("level").isNotNull(), "group")], "overall").alias("method"))


@query("con2_status_order", """WITH @panel, s AS (SELECT loan_id, CASE WHEN x3 IS NULL THEN 'no labels yet' WHEN x3 > 40 THEN 'alert' WHEN x3 > 20 THEN 'watch' ELSE 'ok' END
 AS performance, CASE WHEN score > 0.9 THEN 'alert' WHEN score > 0.7 THEN 'watch' ELSE 'ok' END AS stability FROM panel),
 r(state, place) AS (VALUES ('ok', 1), ('n/a', 2), ('no labels yet', 3), ('watch', 4), ('alert', 5))
 SELECT loan_id, performance, stability, CASE WHEN a.place >= b.place THEN performance ELSE stability END AS overall FROM s
 JOIN r a ON a.state = performance JOIN r b ON b.state = stability""")
def con2(spark, d):
    rows = view(spark, d, "panel").select("loan_id", status("x3", 20, 40, "no labels yet").alias("performance"),
                                          status("score", 0.7, 0.9).alias("stability"))
    return rows.withColumn("overall", worst_status("performance", "stability"))


@query("map1_code_labels", """WITH @panel SELECT loan_id, CASE model WHEN '1-URGENT' THEN 'Urgent' WHEN '5-LOW' THEN 'Low' END AS name FROM panel""")
def map1(spark, d):
    return view(spark, d, "panel").select("loan_id", map_codes("model", {"1-URGENT": "Urgent", "5-LOW": "Low"}).alias("name"))


@query("dq9_rule_hits", """WITH @financials SELECT 'Interest_Rate' AS column, count(*) FILTER (Interest_Rate > 50) AS n_invalid FROM financials
 UNION ALL SELECT 'Num_Credit_Inquiries', count(*) FILTER (Num_Credit_Inquiries > 30) FROM financials
 UNION ALL SELECT 'Num_of_Delayed_Payment', count(*) FILTER (Num_of_Delayed_Payment > 50) FROM financials
 UNION ALL SELECT 'Monthly_Balance', count(*) FILTER (abs(Monthly_Balance) > 1e9) FROM financials
 UNION ALL SELECT 'Amount_invested_monthly', count(*) FILTER (Amount_invested_monthly = 10000) FROM financials""")
def dq9(spark, d):
    return rule_counts(financials(spark, d), INVALID_RULES)


@query("dq7_rules_equivalent", "WITH @financials SELECT 'rules' AS check_name, count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM financials")
def dq7(spark, d):
    rows = financials(spark, d)
    byhand = rows.withColumns({
        "Interest_Rate": F.expr("IF(Interest_Rate > 50, NULL, Interest_Rate)"),
        "Num_Credit_Inquiries": F.expr("IF(Num_Credit_Inquiries > 30, NULL, Num_Credit_Inquiries)"),
        "Num_of_Delayed_Payment": F.expr("IF(Num_of_Delayed_Payment > 50, NULL, Num_of_Delayed_Payment)"),
        "Monthly_Balance": F.expr("IF(abs(Monthly_Balance) > 1e9, NULL, Monthly_Balance)"),
        "Amount_invested_monthly": F.expr("IF(Amount_invested_monthly = 10000, NULL, Amount_invested_monthly)")})
    left = rows.withColumns(apply_rules(INVALID_RULES)).select("Customer_ID", F.struct(*INVALID_RULES).alias("a"))
    both = left.join(byhand.select("Customer_ID", F.struct(*INVALID_RULES).alias("b")), "Customer_ID")
    return both.agg(F.lit("rules").alias("check_name"), F.count(F.lit(1)).alias("n"),
                    F.count(F.when(~F.col("a").eqNullSafe(F.col("b")), 1)).alias("n_different"))


@query("src_text_numbers", """WITH @panel SELECT loan_id, TRY_CAST(CASE WHEN label = 1 THEN 'x' ELSE CAST(x1 AS VARCHAR) END AS DOUBLE) AS x1 FROM panel""")
def text_numbers(spark, d):
    raw = as_text(view(spark, d, "panel").selectExpr("loan_id", "CASE WHEN label = 1 THEN 'x' ELSE CAST(x1 AS STRING) END AS x1"))
    return raw.select("loan_id", to_number("x1").alias("x1"))
