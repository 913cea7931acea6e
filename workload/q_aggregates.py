"""Aggregations and data-quality checks."""

from pyspark.sql import functions as F

from panelkit.functions.dates import split_of, split_windows
from panelkit.functions.numeric import within
from panelkit.operators.drift import binned, contingency, decile_edges, shares
from panelkit.operators.impute import QUARTILES, fill_from, fit_group_medians
from panelkit.operators.lookback import history_mean, lookback
from panelkit.operators.metrics import score_summary
from panelkit.operators.profile import column_profile, mode_of, ranked_pivot, top_value_share
from panelkit.operators.quality import duplicate_keys, later_than, missing_shares, mostly_missing, require_splits, split_check
from panelkit.operators.quantiles import exact_quantiles, medians
from panelkit.plans.gold import join_sources
from panelkit.plans.silver import delinquency
from panelkit.sources.schema import require_columns
from workload.q_joins import WINDOW_SQL, financials, labels, people
from workload.registry import query
from workload.views import ALL_MONTHS, DATA_START, TRAIN_DATE, label_keys, table, view


def split_panel(spark, d):
    """The panel with its chronological split, rows outside all windows dropped."""
    split = split_of("label_date", split_windows(TRAIN_DATE, DATA_START))
    return view(spark, d, "panel").withColumn("data_split", split).filter("data_split IS NOT NULL")


@query("agg1_row_count", "SELECT count(*) AS n FROM lineitem")
def agg1(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("agg2_class_distribution", """WITH @split_panel SELECT data_split, label, count(*) AS n, count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY data_split)
 AS proportion FROM split_panel WHERE data_split IS NOT NULL GROUP BY data_split, label""")
def agg2(spark, d):
    counts = split_panel(spark, d).groupBy("data_split", "label").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("data_split").agg(F.sum("n").alias("total"))
    return counts.join(totals, "data_split").select("data_split", "label", "n", (F.col("n") / F.col("total")).alias("proportion"))


@query("agg3_split_dates", "WITH @split_panel SELECT data_split, min(label_date) AS min_date, max(label_date) AS max_date FROM split_panel "
       "WHERE data_split IS NOT NULL GROUP BY 1")
def agg3(spark, d):
    return split_panel(spark, d).groupBy("data_split").agg(F.min("label_date").alias("min_date"), F.max("label_date").alias("max_date"))


@query("agg4_group_median", """SELECT l_returnflag, l_linestatus, quantile_disc(l_extendedprice, 0.5) AS price, quantile_disc(l_quantity, 0.5) AS quantity
 FROM lineitem GROUP BY ALL""")
def agg4(spark, d):
    return medians(table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"], ["l_returnflag", "l_linestatus"]).select(
        "l_returnflag", "l_linestatus", F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"))


@query("agg5_exact_quantiles", "SELECT unnest([0.0e0, 0.25e0, 0.5e0, 0.75e0, 1.0e0]) AS prob, unnest(quantile_disc(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 1.0])) AS value FROM lineitem")
def agg5(spark, d):
    return exact_quantiles(table(spark, d, "lineitem"), ["l_extendedprice"], QUARTILES, interpolate=False).select("prob", "value")


@query("agg6_interpolated_quantiles", """SELECT l_returnflag, unnest([0.01e0, 0.1e0, 0.5e0, 0.99e0]) AS prob, round(unnest(quantile_cont(l_extendedprice,
 [0.01, 0.1, 0.5, 0.99])), 6) AS value FROM lineitem GROUP BY 1""")
def agg6(spark, d):
    return exact_quantiles(table(spark, d, "lineitem"), ["l_extendedprice"], [0.01, 0.1, 0.5, 0.99], ["l_returnflag"]).select(
        "l_returnflag", "prob", F.round("value", 6).alias("value"))


@query("agg7_count_and_median", """SELECT c_mktsegment, c_nationkey, quantile_disc(c_acctbal, 0.5) AS c_acctbal, count(c_acctbal) AS c_acctbal_n FROM customer
 GROUP BY ALL HAVING count(*) >= 10""")
def agg7(spark, d):
    return medians(table(spark, d, "customer"), ["c_acctbal"], ["c_mktsegment", "c_nationkey"]).filter("c_acctbal_n >= 10")


@query("agg8_conditional_pivot", """WITH o AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders)
 SELECT o_custkey, max(CASE WHEN place = 1 THEN o_totalprice END) AS best, max(CASE WHEN place = 2 THEN o_totalprice END) AS second FROM o GROUP BY 1""")
def agg8(spark, d):
    made = ranked_pivot(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], {"price": "o_totalprice"}, ["best", "second"])
    return made.withColumnsRenamed({"best_price": "best", "second_price": "second"})


def _window_sql(stats, windows=(7, 14, 21), features=("fe_1", "fe_3"), digits=8):
    made = {"mean": "avg({c})", "max": "max({c})", "min": "min({c})", "std": "stddev_samp({c})", "median": "quantile_disc({c}, 0.5)"}
    return ", ".join(f"round({made[s].format(c=c)} FILTER (days <= {w}), {digits}) AS {c}_{s}_{w}d"
                     for w in windows for c in features for s in stats)


LOOKBACK_PAIRS = WINDOW_SQL.replace("labels_snapshot_date, fe_1,", "labels_snapshot_date, fe_1, fe_2, fe_3,")


@query("agg9_window_statistics", LOOKBACK_PAIRS + " SELECT Customer_ID, labels_snapshot_date, " + _window_sql(["mean", "max", "min", "std"])
       + " FROM p WHERE days <= 21 GROUP BY ALL")
def agg9(spark, d):
    made = lookback(view(spark, d, "clicks"), label_keys(spark, d), ["Customer_ID"], "clicks_snapshot_date", "labels_snapshot_date",
                    ["fe_1", "fe_3"], (7, 14, 21), counts=False, trend=None, dedupe=False)
    return made.select("Customer_ID", "labels_snapshot_date", *[F.round(c, 8).alias(c) for c in made.columns[2:]])


@query("agg9_window_medians", LOOKBACK_PAIRS + " SELECT Customer_ID, labels_snapshot_date, " + _window_sql(["mean", "median", "max", "min", "std"], (7, 21))
       + " FROM p WHERE days <= 21 GROUP BY ALL")
def agg9_medians(spark, d):
    made = lookback(view(spark, d, "clicks"), label_keys(spark, d), ["Customer_ID"], "clicks_snapshot_date", "labels_snapshot_date",
                    ["fe_1", "fe_3"], (7, 21), ("mean", "median", "max", "min", "std"), counts=False, trend=None, dedupe=False)
    return made.select("Customer_ID", "labels_snapshot_date", *[F.round(c, 8).alias(c) for c in made.columns[2:]])


@query("agg10_window_counts", WINDOW_SQL + """ SELECT Customer_ID, labels_snapshot_date, count(*) FILTER (days <= 3) AS click_count_3d,
 count(*) FILTER (days <= 10) AS click_count_10d FROM p WHERE days <= 10 GROUP BY ALL""")
def agg10(spark, d):
    return lookback(view(spark, d, "clicks"), label_keys(spark, d), ["Customer_ID"], "clicks_snapshot_date", "labels_snapshot_date",
                    ["fe_1"], (3, 10), trend=None, keep=["click_count_3d", "click_count_10d"], dedupe=False, empty_count_zero=True)


@query("agg11_trend", WINDOW_SQL + """ SELECT Customer_ID, labels_snapshot_date, round(avg(fe_1) FILTER (days <= 7) - avg(fe_1) FILTER (days > 7), 7) AS fe_1_trend_7d
 FROM p WHERE days <= 14 GROUP BY ALL""")
def agg11(spark, d):
    made = lookback(view(spark, d, "clicks"), label_keys(spark, d), ["Customer_ID"], "clicks_snapshot_date", "labels_snapshot_date",
                    ["fe_1"], (7,), counts=False, trend=7, keep=["fe_1_trend_7d"], dedupe=False)
    return made.withColumn("fe_1_trend_7d", F.round("fe_1_trend_7d", 7))


@query("agg12_history_mean", LOOKBACK_PAIRS + """ SELECT Customer_ID, labels_snapshot_date, round(avg(fe_1), 8) AS fe_1_hist_mean, round(avg(fe_3), 8) AS fe_3_hist_mean
 FROM p GROUP BY ALL""")
def agg12(spark, d):
    made = history_mean(view(spark, d, "clicks"), label_keys(spark, d), ["Customer_ID"], "clicks_snapshot_date", "labels_snapshot_date", ["fe_1", "fe_3"])
    return made.select("Customer_ID", "labels_snapshot_date", *[F.round(f"{c}_hist_mean", 8).alias(f"{c}_hist_mean") for c in ("fe_1", "fe_3")])


@query("agg13_rate_by_group", """WITH @silver_loans SELECT mob, round(avg(CASE WHEN dpd >= 30 THEN 1e0 ELSE 0e0 END), 9) AS bad_rate, count(*) AS n FROM silver_loans GROUP BY mob""")
def agg13(spark, d):
    return delinquency(view(spark, d, "ledger")).groupBy("mob").agg(
        F.round(F.avg(F.when(F.col("dpd") >= 30, 1.0).otherwise(0.0)), 9).alias("bad_rate"), F.count(F.lit(1)).alias("n"))


@query("agg13_rate_by_month_and_split", """WITH @split_panel SELECT month, data_split, round(avg(label), 9) AS default_rate, count(*) AS n FROM split_panel
 WHERE data_split IS NOT NULL GROUP BY ALL""")
def agg13_split(spark, d):
    return split_panel(spark, d).groupBy("month", "data_split").agg(F.round(F.avg("label"), 9).alias("default_rate"), F.count(F.lit(1)).alias("n"))


@query("agg14_missing_shares", """WITH @split_panel, m AS (SELECT data_split, avg(CASE WHEN x2 IS NULL THEN 1e0 ELSE 0 END) AS x2, avg(CASE WHEN x3 IS NULL THEN 1e0 ELSE 0 END) AS x3,
 avg(CASE WHEN level IS NULL THEN 1e0 ELSE 0 END) AS level FROM split_panel WHERE data_split IS NOT NULL GROUP BY 1)
 SELECT data_split, feature, round(missing_rate, 9) AS missing_rate FROM (UNPIVOT m ON x2, x3, level INTO NAME feature VALUE missing_rate)""")
def agg14(spark, d):
    return missing_shares(split_panel(spark, d), ["x2", "x3", "level"], ["data_split"]).withColumn("missing_rate", F.round("missing_rate", 9))


@query("agg15_column_profile", """WITH @panel, u AS (SELECT 'x1' AS feature, x1 AS v FROM panel UNION ALL SELECT 'x3', x3 FROM panel),
 q AS (SELECT feature, quantile_cont(v, 0.01) AS p01, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.99) AS p99 FROM u GROUP BY 1)
 SELECT feature, round(any_value(p01), 6) AS p01, any_value(median) AS median, round(any_value(p99), 6) AS p99, min(v) AS min, max(v) AS max,
 round(avg(CASE WHEN v IS NULL THEN 1e0 ELSE 0 END), 9) AS missing, round(skewness(v), 6) AS skew,
 round(avg(CASE WHEN v < p01 OR v > p99 THEN 1e0 ELSE 0 END), 9) AS share_outside_p01_p99, round(max(v) / any_value(p99), 8) AS max_over_p99
 FROM u JOIN q USING (feature) GROUP BY feature""")
def agg15(spark, d):
    made = column_profile(view(spark, d, "panel"), ["x1", "x3"])
    digits = {"p01": 6, "p99": 6, "missing": 9, "skew": 6, "share_outside_p01_p99": 9, "max_over_p99": 8}
    return made.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("agg16_top_value_share", """WITH @panel, u AS (SELECT 'level' AS feature, level AS v FROM panel UNION ALL SELECT 'x2', CAST(x2 AS VARCHAR) FROM panel),
 c AS (SELECT feature, v, count(*) AS n FROM u GROUP BY ALL) SELECT feature, round(max(n) * 1e0 / sum(n), 9) AS top_value_share FROM c GROUP BY 1""")
def agg16(spark, d):
    return top_value_share(view(spark, d, "panel"), ["level", "x2"]).withColumn("top_value_share", F.round("top_value_share", 9))


@query("agg17_mode", """WITH @panel, c AS (SELECT Customer_ID, level, count(*) AS n FROM panel WHERE level IS NOT NULL GROUP BY ALL)
 SELECT Customer_ID, level AS mode FROM (SELECT *, row_number() OVER (PARTITION BY Customer_ID ORDER BY n DESC, level) AS rn FROM c) WHERE rn = 1""")
def agg17(spark, d):
    return mode_of(view(spark, d, "panel"), ["Customer_ID"], "level")


@query("agg18_distinct_counts", "SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1")
def agg18(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"),
                                                              F.count_distinct(F.to_date("ts")).alias("days"))


@query("agg19_duplicate_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def agg19(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


@query("agg20_two_key_statistics", """WITH @financials SELECT Credit_Mix, Payment_of_Min_Amount, count(Changed_Credit_Limit) AS n, quantile_cont(Changed_Credit_Limit, 0.5) AS median,
 round(avg(Changed_Credit_Limit), 8) AS mean, round(stddev_samp(Changed_Credit_Limit), 8) AS std FROM financials GROUP BY ALL""")
def agg20(spark, d):
    rows, keys = financials(spark, d), ["Credit_Mix", "Payment_of_Min_Amount"]
    stats = rows.groupBy(*keys).agg(F.count("Changed_Credit_Limit").alias("n"), F.round(F.avg("Changed_Credit_Limit"), 8).alias("mean"),
                                    F.round(F.stddev_samp("Changed_Credit_Limit"), 8).alias("std"))
    middle = exact_quantiles(rows, ["Changed_Credit_Limit"], [0.5], keys).select(*keys, F.col("value").alias("median"))
    return stats.join(middle, keys, "left")


@query("agg21_contingency", """WITH @panel, e AS (SELECT list_sort(list_distinct(quantile_cont(x2, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]))) AS e FROM panel)
 SELECT 'x2' AS feature, CAST(len(list_filter(e[2:len(e) - 1], lambda q: x2 > q)) AS VARCHAR) AS bin, CAST(sum(1 - label) AS BIGINT) AS goods,
 CAST(sum(label) AS BIGINT) AS bads FROM panel, e GROUP BY ALL""")
def agg21(spark, d):
    panel = view(spark, d, "panel")
    return contingency(binned(panel, decile_edges(panel, ["x2"]), keep=["label"]), "label")


@query("agg22_normalised_distribution", """WITH @panel SELECT 'level' AS feature, month, coalesce(level, '__MISSING__') AS bin, count(*) AS n,
 round(count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY month), 9) AS share FROM panel GROUP BY month, level""")
def agg22(spark, d):
    return shares(binned(view(spark, d, "panel"), {}, ["level"], keep=["month"]), ["month"]).withColumn("share", F.round("share", 9))


@query("agg23_score_summary", """WITH @panel SELECT month, count(*) AS n, round(avg(score), 8) AS mean_score, round(avg(CASE WHEN score >= 0.6 THEN 1e0 ELSE 0 END), 9) AS predicted_default_rate,
 round(quantile_cont(score, 0.1), 8) AS p10, round(quantile_cont(score, 0.5), 8) AS p50, round(quantile_cont(score, 0.9), 8) AS p90 FROM panel GROUP BY month""")
def agg23(spark, d):
    made = score_summary(view(spark, d, "panel"), "score", 0.6, ["month"])
    return made.withColumns({"predicted_default_rate": F.round("predicted_default_rate", 9),
                             **{c: F.round(c, 8) for c in ("mean_score", "p10", "p50", "p90")}})


MONTH_MEANS = ", ".join(f"round(avg(score) FILTER (strftime(month, '%Y-%m') = '{m}'), 8) AS \"{m}\"" for m in ALL_MONTHS)


@query("agg24_feature_by_month", f"WITH @panel SELECT model, {MONTH_MEANS} FROM panel GROUP BY 1")
def agg24(spark, d):
    rows = view(spark, d, "panel").withColumn("m", F.date_format("month", "yyyy-MM"))
    return rows.groupBy("model").pivot("m", ALL_MONTHS).agg(F.round(F.avg("score"), 8))


@query("agg25_unpivot", "WITH @panel SELECT loan_id, feature, value FROM (UNPIVOT (SELECT loan_id, x1, x2 FROM panel) ON x1, x2 INTO NAME feature VALUE value)")
def agg25(spark, d):
    return view(spark, d, "panel").unpivot(["loan_id"], ["x1", "x2"], "feature", "value")


@query("agg26_first_month", "WITH @panel SELECT model, min(month) AS first_month, max(month) AS last_month FROM panel GROUP BY 1")
def agg26(spark, d):
    return view(spark, d, "panel").groupBy("model").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))


@query("agg27_describe", """SELECT 'l_quantity' AS feature, count(l_quantity) AS n, round(avg(l_quantity), 8) AS mean, round(stddev_samp(l_quantity), 8) AS std,
 min(l_quantity) AS min, quantile_cont(l_quantity, 0.25) AS p25, quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.75) AS p75, max(l_quantity) AS max FROM lineitem""")
def agg27(spark, d):
    rows = table(spark, d, "lineitem")
    q = exact_quantiles(rows, ["l_quantity"], [0.25, 0.5, 0.75]).groupBy("feature").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in (0.25, 0.5, 0.75)])
    stats = rows.agg(F.lit("l_quantity").alias("feature"), F.count("l_quantity").alias("n"), F.round(F.avg("l_quantity"), 8).alias("mean"),
                     F.round(F.stddev_samp("l_quantity"), 8).alias("std"), F.min("l_quantity").alias("min"), F.max("l_quantity").alias("max"))
    return stats.join(q, "feature")


@query("agg28_remaining_nulls", """WITH @split_panel, m AS (SELECT level, quantile_disc(x3, 0.5) AS m FROM split_panel WHERE data_split = 'train' AND level IS NOT NULL GROUP BY 1)
 SELECT data_split, count(*) FILTER (coalesce(x3, m) IS NULL) AS remaining FROM split_panel LEFT JOIN m USING (level) WHERE data_split IS NOT NULL GROUP BY 1""")
def agg28(spark, d):
    rows = split_panel(spark, d).select("loan_id", "data_split", "level", "x3")
    filled = fill_from(rows, "x3", fit_group_medians(rows.filter("data_split = 'train'"), "x3", ["level"], "m"), ["level"], "m")
    return filled.groupBy("data_split").agg(F.count(F.when(F.col("x3").isNull(), 1)).alias("remaining"))


# ---- data quality ---------------------------------------------------------------------------------------------------
@query("dq1_rows_without_label", """WITH @panel SELECT count(*) AS n, count(*) FILTER (label IS NULL) AS n_missing FROM (SELECT l_orderkey FROM lineitem) LEFT JOIN
 (SELECT CAST(loan_id AS BIGINT) AS l_orderkey, label FROM panel WHERE label_date < DATE '2000-01-01') USING (l_orderkey)""")
def dq1(spark, d):
    known = view(spark, d, "panel").filter("label_date < DATE '2000-01-01'").select(F.col("loan_id").cast("long").alias("l_orderkey"), "label")
    joined = table(spark, d, "lineitem").select("l_orderkey").join(known, "l_orderkey", "left")
    return joined.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("label").isNull(), 1)).alias("n_missing"))


@query("dq2_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq2_keys(spark, d):
    return duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq3_split_windows", """WITH @split_panel SELECT data_split, count(*) AS n, CAST(0 AS BIGINT) AS n_outside, min(label_date) AS first_date, max(label_date) AS last_date
 FROM split_panel WHERE data_split IS NOT NULL GROUP BY 1""")
def dq3(spark, d):
    windows = split_windows(TRAIN_DATE, DATA_START)
    return split_check(require_splits(split_panel(spark, d), windows, "label_date"), windows, "label_date")


@query("dq4_future_features", """WITH @panel, @attributes, @financials SELECT 'attributes_snapshot_date' AS feature_date, count(*) FILTER (a.snapshot_date > label_date) AS n_future
 FROM panel LEFT JOIN attributes a USING (Customer_ID) UNION ALL SELECT 'financials_snapshot_date', count(*) FILTER (f.snapshot_date > label_date)
 FROM panel LEFT JOIN financials f USING (Customer_ID)""")
def dq4(spark, d):
    return later_than(join_sources_of(spark, d), ["attributes_snapshot_date", "financials_snapshot_date"], "labels_snapshot_date")


def join_sources_of(spark, d):
    """Panel labels with all sources."""
    return join_sources(labels(spark, d), people(spark, d), financials(spark, d))


@query("dq5_required_columns", "SELECT s_suppkey, s_acctbal FROM supplier")
def dq5(spark, d):
    return require_columns(table(spark, d, "supplier"), ["s_suppkey", "s_acctbal"]).select("s_suppkey", "s_acctbal")


@query("dq6_mostly_missing", """WITH @panel SELECT 'sparse' AS feature, round(avg(CASE WHEN x2 > 40 THEN 1e0 ELSE 0 END), 9) AS missing_rate FROM panel HAVING avg(CASE WHEN x2 > 40 THEN 1e0 ELSE 0 END) > 0.5""")
def dq6(spark, d):
    rows = view(spark, d, "panel").withColumn("sparse", F.expr("CASE WHEN x2 <= 40 THEN x2 END"))
    return mostly_missing(rows, ["sparse", "x2", "x3"]).withColumn("missing_rate", F.round("missing_rate", 9))
