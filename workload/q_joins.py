"""Joins, windows, sorts and set operations."""

from pyspark.sql import functions as F

from panelkit.functions.dates import split_of, split_windows
from panelkit.functions.numeric import log1p_floor
from panelkit.operators.asof import asof_join, latest_non_null, latest_per_key, role_intervals
from panelkit.operators.drift import shares
from panelkit.operators.impute import fill_from, fit_group_medians
from panelkit.operators.lookback import lookback, pair_within
from panelkit.operators.profile import by_strength, explained_variance, label_correlations, spearman_lookup
from panelkit.operators.quality import one_to_one, with_labels
from panelkit.operators.quantiles import medians
from panelkit.operators.selection import keep_first
from panelkit.plans.gold import join_sources
from panelkit.plans.governance import latest_training, rank_candidates, roles_asof
from panelkit.plans.inference import rows_to_monitor, rows_to_score
from panelkit.plans.monitoring import known_labels, monitored_rows
from panelkit.plans.silver import silver_attributes
from workload.q_scalars import financials
from workload.registry import query
from workload.views import DATA_START, TRAIN_DATE, label_keys, months, roles, runs, table, view


def labels(spark, d):
    """The panel as a label store."""
    return view(spark, d, "panel").select("loan_id", "Customer_ID", "label", F.col("label_date").alias("snapshot_date"))


def people(spark, d):
    """Silver attributes."""
    return silver_attributes(view(spark, d, "attributes_raw"))


@query("jn1_sources_by_customer", """WITH @panel, @attributes, @financials SELECT loan_id, label, label_date AS labels_snapshot_date, Age, Occupation,
 a.snapshot_date AS attributes_snapshot_date, Annual_Income, f.snapshot_date AS financials_snapshot_date
 FROM panel LEFT JOIN attributes a USING (Customer_ID) LEFT JOIN financials f USING (Customer_ID)""")
def jn1(spark, d):
    return join_sources(labels(spark, d), people(spark, d), financials(spark, d)).select(
        "loan_id", "label", "labels_snapshot_date", "Age", "Occupation", "attributes_snapshot_date", "Annual_Income",
        "financials_snapshot_date")


@query("jn1_point_in_time", """WITH @panel, @attributes SELECT loan_id, CASE WHEN a.snapshot_date <= label_date THEN Age END AS Age,
 CASE WHEN a.snapshot_date <= label_date THEN a.snapshot_date END AS attributes_snapshot_date
 FROM panel LEFT JOIN attributes a USING (Customer_ID)""")
def jn1_pit(spark, d):
    return join_sources(labels(spark, d), people(spark, d), financials(spark, d), point_in_time=True).select(
        "loan_id", "Age", "attributes_snapshot_date")


@query("jn2_labels_by_key", """WITH f AS (SELECT CAST(l_orderkey AS VARCHAR) AS loan_id, CAST(l_shipdate AS DATE) AS snapshot_date, round(sum(l_extendedprice), 2) AS balance FROM lineitem GROUP BY ALL),
 lab AS (SELECT CAST(l_orderkey AS VARCHAR) AS loan_id, CAST(l_shipdate AS DATE) AS snapshot_date, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS label FROM lineitem GROUP BY ALL)
 SELECT loan_id, snapshot_date, label, balance FROM f JOIN lab USING (loan_id, snapshot_date)""")
def jn2(spark, d):
    """Balances and labels of a loan's snapshots, one table each, on loan and date."""
    items = table(spark, d, "lineitem").selectExpr("CAST(l_orderkey AS STRING) AS loan_id", "CAST(l_shipdate AS DATE) AS snapshot_date", "l_extendedprice", "l_returnflag")
    features = items.groupBy("loan_id", "snapshot_date").agg(F.round(F.sum("l_extendedprice"), 2).alias("balance"))
    marks = items.groupBy("loan_id", "snapshot_date").agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("label"))
    return with_labels(features, marks, ["loan_id", "snapshot_date"])


@query("jn3_same_day_clicks", """WITH @panel, @order_clicks SELECT p.loan_id, p.label_date, c.fe_1, c.fe_3 FROM panel p LEFT JOIN order_clicks c
 ON p.Customer_ID = c.Customer_ID AND p.label_date = c.clicks_snapshot_date""")
def jn3(spark, d):
    clicks = view(spark, d, "order_clicks").selectExpr("Customer_ID", "clicks_snapshot_date AS label_date", "fe_1", "fe_3")
    return view(spark, d, "panel").select("loan_id", "Customer_ID", "label_date").join(clicks, ["Customer_ID", "label_date"], "left").drop("Customer_ID")


@query("jn4_lookback_pairs", """WITH @clicks, @label_keys SELECT Customer_ID, labels_snapshot_date, clicks_snapshot_date, fe_2,
 CAST(date_diff('day', clicks_snapshot_date, labels_snapshot_date) AS INTEGER) AS days_before
 FROM clicks JOIN label_keys USING (Customer_ID) WHERE date_diff('day', clicks_snapshot_date, labels_snapshot_date) BETWEEN 1 AND 7""")
def jn4(spark, d):
    return pair_within(view(spark, d, "clicks").drop("fe_1", "fe_3"), label_keys(spark, d), ["Customer_ID"], "clicks_snapshot_date",
                       "labels_snapshot_date", 7)


@query("jn5_parameter_lookup", """WITH @panel, g AS (SELECT level, model, quantile_disc(x3, 0.5) AS m FROM panel WHERE level IS NOT NULL GROUP BY ALL)
 SELECT loan_id, coalesce(x3, m) AS x3 FROM panel LEFT JOIN g USING (level, model)""")
def jn5(spark, d):
    panel = view(spark, d, "panel").select("loan_id", "level", "model", "x3")
    return fill_from(panel, "x3", fit_group_medians(panel, "x3", ["level", "model"], "m"), ["level", "model"], "m").select("loan_id", "x3")


@query("jn6_roles_as_of", """WITH @roles, @months SELECT month, effective_from, champion, challenger FROM months ASOF LEFT JOIN roles
 ON month >= effective_from""")
def jn6(spark, d):
    return roles_asof(months(spark, d), roles(spark, d))


@query("jn6_as_of_orders", """WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(struct_pack(k := o_orderkey, p := o_totalprice)) AS r FROM orders GROUP BY ALL),
 i AS (SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, CAST(l_shipdate AS DATE) AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
 SELECT i.l_orderkey, i.l_linenumber, i.l_partkey, i.day, o.r.k AS last_order, o.r.p AS last_price FROM i ASOF LEFT JOIN o
 ON i.o_custkey = o.o_custkey AND i.day > o.day""")
def jn6_orders(spark, d):
    orders, items = table(spark, d, "orders"), table(spark, d, "lineitem")
    left = items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", F.to_date("l_shipdate").alias("day"))
    right = orders.select("o_custkey", F.to_date("o_orderdate").alias("ordered"), F.col("o_orderkey").alias("last_order"),
                          F.col("o_totalprice").alias("last_price"))
    return asof_join(left, right, ["o_custkey"], "day", "ordered", ["last_order", "last_price"], strict=True).drop("o_custkey")


@query("jn7_group_candidates", """WITH c AS (SELECT c_custkey, c_mktsegment, ln(1 + greatest(c_acctbal, 0)) AS li, c_nationkey % 4 AS bin FROM customer),
 g AS (SELECT c_mktsegment, bin, quantile_disc(li, 0.5) AS m FROM c WHERE c_custkey % 5 <> 0 GROUP BY ALL)
 SELECT c_custkey, CAST(g.bin AS BIGINT) AS bin, round(abs(m - li), 8) AS distance FROM c JOIN g USING (c_mktsegment) WHERE c_custkey % 5 = 0""")
def jn7(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment", log1p_floor("c_acctbal").alias("li"),
                                              (F.col("c_nationkey") % 4).cast("long").alias("bin"))
    groups = medians(rows.filter("c_custkey % 5 <> 0"), ["li"], ["c_mktsegment", "bin"]).select("c_mktsegment", "bin", F.col("li").alias("m"))
    return (rows.filter("c_custkey % 5 = 0").drop("bin").join(groups, "c_mktsegment")
            .select("c_custkey", "bin", F.round(F.abs(F.col("m") - F.col("li")), 8).alias("distance")))


WINDOW_SQL = """WITH @clicks, @label_keys, p AS (SELECT Customer_ID, labels_snapshot_date, fe_1,
 date_diff('day', clicks_snapshot_date, labels_snapshot_date) AS days FROM clicks JOIN label_keys USING (Customer_ID)
 WHERE clicks_snapshot_date < labels_snapshot_date)"""


@query("jn8_blocks_assembled", WINDOW_SQL + """, a AS (SELECT Customer_ID, labels_snapshot_date, round(avg(fe_1), 8) AS fe_1_mean_7d FROM p WHERE days <= 7 GROUP BY ALL),
 b AS (SELECT Customer_ID, labels_snapshot_date, count(*) AS click_count_21d FROM p WHERE days <= 21 GROUP BY ALL)
 SELECT Customer_ID, labels_snapshot_date, fe_1_mean_7d, click_count_21d FROM a FULL JOIN b USING (Customer_ID, labels_snapshot_date)""")
def jn8(spark, d):
    made = lookback(view(spark, d, "clicks").drop("fe_2", "fe_3"), label_keys(spark, d), ["Customer_ID"], "clicks_snapshot_date",
                    "labels_snapshot_date", ["fe_1"], (7, 21), trend=None, keep=["fe_1_mean_7d", "click_count_21d"], dedupe=False)
    return made.withColumn("fe_1_mean_7d", F.round("fe_1_mean_7d", 8))


@query("jn9_features_on_spine", WINDOW_SQL + """, f AS (SELECT Customer_ID, labels_snapshot_date, max(fe_1) AS fe_1_max_7d FROM p WHERE days <= 7 GROUP BY ALL)
 SELECT k.Customer_ID, k.labels_snapshot_date, fe_1_max_7d FROM label_keys k LEFT JOIN f USING (Customer_ID, labels_snapshot_date)""")
def jn9(spark, d):
    keys = label_keys(spark, d)
    made = lookback(view(spark, d, "clicks").drop("fe_2", "fe_3"), keys, ["Customer_ID"], "clicks_snapshot_date", "labels_snapshot_date",
                    ["fe_1"], (7,), trend=None, keep=["fe_1_max_7d"], dedupe=False)
    return keys.join(made, ["Customer_ID", "labels_snapshot_date"], "left")


def stores(spark, d):
    """Inference store (loans from 2001-03 on, without the odd customers) and gold store of the panel."""
    panel = view(spark, d, "panel")
    inference = panel.filter("label_date >= DATE '2001-03-01' AND CAST(Customer_ID AS INT) % 2 = 0").select("loan_id", "month", "x2")
    gold = (panel.withColumn("data_split", split_of("label_date", split_windows(TRAIN_DATE, DATA_START)))
            .filter("data_split IS NOT NULL").select("loan_id", "month", "x2", "data_split"))
    return inference, gold


STORES = """WITH @split_panel, inf AS (SELECT loan_id, month, x2 FROM panel WHERE label_date >= DATE '2001-03-01' AND CAST(Customer_ID AS INT) % 2 = 0),
 gold AS (SELECT loan_id, month, x2, data_split FROM split_panel WHERE data_split IS NOT NULL)"""


@query("jn10_rows_not_scored", STORES + " SELECT loan_id, month, data_split FROM gold WHERE loan_id NOT IN (SELECT loan_id FROM inf)")
def jn10(spark, d):
    inference, gold = stores(spark, d)
    return gold.join(inference.select("loan_id"), "loan_id", "left_anti").select("loan_id", "month", "data_split")


@query("jn11_ids_in_both", """SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
 AND c_custkey IN (SELECT user_id FROM events)""")
def jn11(spark, d):
    customers, orders, events = (table(spark, d, t) for t in ("customer", "orders", "events"))
    defaulted = orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return (customers.join(defaulted, "c_custkey", "left_semi")
            .join(events.select(F.col("user_id").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_mktsegment"))


@query("jn12_monitored_rows", """WITH @panel, p AS (SELECT loan_id, score FROM panel),
 l AS (SELECT loan_id, label, label_date FROM panel WHERE label_date <= DATE '2001-01-31')
 SELECT loan_id, score, label, l.label_date, f.x2 FROM p LEFT JOIN l USING (loan_id) LEFT JOIN (SELECT loan_id, x2 FROM panel) f USING (loan_id)""")
def jn12(spark, d):
    panel = view(spark, d, "panel")
    return monitored_rows(panel.select("loan_id", "score"),
                          known_labels(panel.select("loan_id", "label", "label_date"), "2001-01-31"), panel.select("loan_id", "x2"))


@query("jn13_champion_in_force", """WITH @panel, m AS (SELECT model, month, count(*) AS n FROM panel GROUP BY ALL),
 c AS (SELECT month, max(struct_pack(n := n, model := model)).model AS model FROM m GROUP BY month)
 SELECT loan_id, model, month FROM panel JOIN c USING (month, model)""")
def jn13(spark, d):
    panel = view(spark, d, "panel").select("loan_id", "model", "month")
    counts = panel.groupBy("month", "model").agg(F.count(F.lit(1)).alias("n"))
    champion = counts.groupBy("month").agg(F.max_by("model", F.struct("n", "model")).alias("model"))
    return panel.join(champion, ["month", "model"], "left_semi")


@query("jn14_source_precedence", STORES + """ SELECT loan_id, month, x2, 'inference_feature_store' AS feature_source FROM inf UNION ALL
 SELECT loan_id, month, x2, 'gold_feature_store' FROM gold WHERE month NOT IN (SELECT month FROM inf)""")
def jn14(spark, d):
    inference, gold = stores(spark, d)
    return rows_to_score(inference, gold, "month").drop("data_split")


TREND = WINDOW_SQL + """, a AS (SELECT Customer_ID, labels_snapshot_date, avg(fe_1) AS m FROM p WHERE days <= 7 GROUP BY ALL),
 b AS (SELECT Customer_ID, labels_snapshot_date, avg(fe_1) AS m FROM p WHERE days BETWEEN 8 AND 14 GROUP BY ALL)"""


@query("jn15_trend_blocks", TREND + """ SELECT Customer_ID, labels_snapshot_date, round(a.m - b.m, 8) AS fe_1_trend_7d FROM a JOIN b
 USING (Customer_ID, labels_snapshot_date)""")
def jn15(spark, d):
    made = lookback(view(spark, d, "clicks").drop("fe_2", "fe_3"), label_keys(spark, d), ["Customer_ID"], "clicks_snapshot_date",
                    "labels_snapshot_date", ["fe_1"], (7,), counts=False, trend=7, keep=["fe_1_trend_7d"], dedupe=False)
    return made.filter("fe_1_trend_7d IS NOT NULL").withColumn("fe_1_trend_7d", F.round("fe_1_trend_7d", 8))


@query("jn16_metric_tables", """WITH @panel, u AS (UNPIVOT (SELECT label, x1, x2, x3 FROM panel) ON x1, x2, x3 INTO NAME feature VALUE value)
 SELECT feature, r AS raw, l AS late FROM (SELECT feature, round(corr(value, label), 8) AS r FROM u WHERE feature <> 'x1' GROUP BY 1)
 FULL JOIN (SELECT feature, round(max(value), 4) AS l FROM u WHERE feature <> 'x2' GROUP BY 1) USING (feature)""")
def jn16(spark, d):
    panel = view(spark, d, "panel")
    raw = label_correlations(panel, ["x2", "x3"], "label").select("feature", F.round("correlation", 8).alias("raw"))
    late = panel.agg(F.max("x1").alias("x1"), F.max("x3").alias("x3")).unpivot([], ["x1", "x3"], "feature", "late")
    return raw.join(late.withColumn("late", F.round("late", 4)), "feature", "full_outer")


@query("jn17_split_or_production", STORES + " SELECT loan_id, coalesce(data_split, 'production') AS data_split FROM inf LEFT JOIN gold USING (loan_id) "
       "UNION ALL SELECT loan_id, data_split FROM gold WHERE loan_id NOT IN (SELECT loan_id FROM inf)")
def jn17(spark, d):
    inference, gold = stores(spark, d)
    return rows_to_monitor(inference, gold).select("loan_id", "data_split")


# ---- windows --------------------------------------------------------------------------------------------------------
@query("win1_nearest_candidates", """WITH c AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer),
 g AS (SELECT c_mktsegment, c_nationkey % 4 AS bin, avg(c_acctbal) AS m FROM customer GROUP BY ALL),
 r AS (SELECT c_custkey, g.bin, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(m - c_acctbal), g.bin) AS place FROM c JOIN g USING (c_mktsegment))
 SELECT c_custkey, max(CASE WHEN place = 1 THEN bin END) AS nearest, max(CASE WHEN place = 2 THEN bin END) AS second FROM r GROUP BY 1""")
def win1(spark, d):
    customers = table(spark, d, "customer")
    groups = (customers.groupBy("c_mktsegment", (F.col("c_nationkey") % 4).alias("bin")).agg(F.avg("c_acctbal").alias("m"))
              .groupBy("c_mktsegment").agg(F.collect_list(F.struct("bin", "m")).alias("groups")))  # four bins per segment
    near = F.array_sort(F.transform("groups", lambda g: F.struct(F.abs(g["m"] - F.col("c_acctbal")).alias("d"), g["bin"].alias("bin"))))
    rows = customers.join(groups, "c_mktsegment").withColumn("near", near)
    return rows.select("c_custkey", F.try_element_at("near", F.lit(1))["bin"].alias("nearest"),
                       F.try_element_at("near", F.lit(2))["bin"].alias("second"))


@query("win2_latest_row", """WITH @order_clicks SELECT Customer_ID, clicks_snapshot_date, fe_1, fe_3 FROM (SELECT *, row_number() OVER (PARTITION BY Customer_ID
 ORDER BY clicks_snapshot_date DESC, fe_1 DESC, fe_3 DESC) AS rn FROM order_clicks) WHERE rn = 1""")
def win2(spark, d):
    return latest_per_key(view(spark, d, "order_clicks").select("Customer_ID", "clicks_snapshot_date", "fe_1", "fe_3"), ["Customer_ID"], ["clicks_snapshot_date"])


@query("win3_latest_non_null", """WITH @panel, p AS (SELECT *, struct_pack(label_date := label_date, x3 := x3) AS o3, struct_pack(label_date := label_date, level := level) AS ol FROM panel)
 SELECT Customer_ID, max(o3) FILTER (x3 IS NOT NULL).x3 AS x3, max(ol) FILTER (level IS NOT NULL).level AS level FROM p GROUP BY 1""".replace(
    "max(o3) FILTER (x3 IS NOT NULL).x3", "(max(o3) FILTER (x3 IS NOT NULL)).x3").replace(
    "max(ol) FILTER (level IS NOT NULL).level", "(max(ol) FILTER (level IS NOT NULL)).level"))
def win3(spark, d):
    return latest_non_null(view(spark, d, "panel"), ["Customer_ID"], "label_date", ["x3", "level"])


@query("win4_latest_event", """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
 ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def win4(spark, d):
    return latest_per_key(table(spark, d, "events").select("user_id", "event_type", "ts", "event_id", "value"),
                          ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("win5_latest_training", """WITH @runs, @months SELECT month, (SELECT max(as_of) FROM runs WHERE as_of <= month) AS last_training FROM months""")
def win5(spark, d):
    return latest_training(months(spark, d), runs(spark, d))


@query("win6_role_intervals", """WITH @roles SELECT effective_from, champion, lead(effective_from) OVER (ORDER BY effective_from) AS effective_to FROM roles""")
def win6(spark, d):
    return role_intervals(roles(spark, d)).select("effective_from", "champion", "effective_to")


@query("win7_champion_changed", """WITH @panel, m AS (SELECT month, model, count(*) AS n FROM panel GROUP BY ALL),
 c AS (SELECT month AS effective_from, max(struct_pack(n := n, model := model)).model AS champion FROM m GROUP BY month)
 SELECT effective_from, champion, coalesce(lag(champion) OVER (ORDER BY effective_from) <> champion, true) AS champion_changed FROM c""")
def win7(spark, d):
    counts = view(spark, d, "panel").groupBy("month", "model").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy(F.col("month").alias("effective_from")).agg(F.max_by("model", F.struct("n", "model")).alias("champion"))
    return role_intervals(top).select("effective_from", "champion", "champion_changed")


@query("win8_latest_assessed", """WITH @panel, mon AS (SELECT model, month, avg(label) AS rate, CASE WHEN avg(label) > 0.4 THEN 'alert' WHEN avg(label) > 0.3 THEN 'ok' ELSE 'n/a' END AS status FROM panel GROUP BY ALL)
 SELECT model, max(month) AS last_month, max_by(status, month) AS last_status, max(month) FILTER (status <> 'n/a') AS last_assessed,
 max_by(status, month) FILTER (status <> 'n/a') AS assessed_status FROM mon GROUP BY model""")
def win8(spark, d):
    mon = view(spark, d, "panel").groupBy("model", "month").agg(F.avg("label").alias("rate")).withColumn(
        "status", F.when(F.col("rate") > 0.4, "alert").when(F.col("rate") > 0.3, "ok").otherwise("n/a"))
    last = latest_per_key(mon.select("model", "month", "status"), ["model"], ["month"]).toDF("model", "last_month", "last_status")
    assessed = latest_per_key(mon.filter("status <> 'n/a'").select("model", "month", "status"), ["model"], ["month"]).toDF(
        "model", "last_assessed", "assessed_status")
    return last.join(assessed, "model", "left")


@query("win9_keep_against_peers", """WITH @panel, p AS (SELECT label, x1, x2, x1 * 2 + x2 AS x4 FROM panel),
 r AS (SELECT rank() OVER (ORDER BY x1) + 0e0 AS x1, rank() OVER (ORDER BY x2) + 0e0 AS x2, rank() OVER (ORDER BY x4) + 0e0 AS x4 FROM p),
 c AS (SELECT abs(corr(x1, x4)) > 0.8 AS a14, abs(corr(x1, x2)) > 0.8 AS a12, abs(corr(x2, x4)) > 0.8 AS a24 FROM r)
 SELECT 'x1' AS feature, true AS kept FROM c WHERE a14 AND NOT a12 UNION ALL SELECT 'x2', true FROM c WHERE NOT a24 UNION ALL SELECT 'x4', false FROM c""")
def win9(spark, d):
    names = ["x1", "x2", "x4"]
    rows = view(spark, d, "panel").withColumn("x4", F.col("x1") * 2 + F.col("x2")).select(*names)
    kept, dropped = keep_first(names, spearman_lookup(rows, names))
    return spark.createDataFrame([(n, True) for n in kept] + [(n, False) for n in dropped], "feature string, kept boolean")


@query("win10_cumulative_share", """WITH @panel, c AS (SELECT corr(x1, x2) AS r FROM panel)
 SELECT CAST(1 AS INTEGER) AS component, round((1 + abs(r)) / 2, 6) AS explained_variance, round((1 + abs(r)) / 2, 6) AS cumulative_variance FROM c
 UNION ALL SELECT 2, round((1 - abs(r)) / 2, 6), 1.0 FROM c""")
def win10(spark, d):
    made = explained_variance(view(spark, d, "panel"), ["x1", "x2"])
    return made.select("component", F.round("explained_variance", 6).alias("explained_variance"),
                       F.round("cumulative_variance", 6).alias("cumulative_variance"))


# ---- sorts and sets -------------------------------------------------------------------------------------------------
@query("srt1_ordered_summary", "WITH @panel SELECT label, model, count(*) AS n FROM panel GROUP BY ALL ORDER BY ALL")
def srt1(spark, d):
    return view(spark, d, "panel").groupBy("label", "model").agg(F.count(F.lit(1)).alias("n")).orderBy("label", "model")


@query("srt2_by_absolute_value", "SELECT n_name, round(avg(c_acctbal) - 4500, 6) AS gap FROM customer JOIN nation ON c_nationkey = n_nationkey "
       "GROUP BY 1 ORDER BY abs(gap) DESC")
def srt2(spark, d):
    joined = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return by_strength(joined.groupBy("n_name").agg(F.round(F.avg("c_acctbal") - 4500, 6).alias("gap")), "gap")


@query("srt3_top_n", "SELECT l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1 ORDER BY revenue DESC, l_partkey LIMIT 30")
def srt3(spark, d):
    return (table(spark, d, "lineitem").groupBy("l_partkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
            .orderBy(F.col("revenue").desc(), "l_partkey").limit(30))


@query("srt4_candidate_ranking", """WITH @runs SELECT as_of, max(CASE WHEN p = 1 THEN model_version END) AS model_version, max(CASE WHEN p = 2 THEN model_version END) AS runner_up
 FROM (SELECT *, row_number() OVER (PARTITION BY as_of ORDER BY gini_test DESC, model_version) AS p FROM runs) GROUP BY 1""")
def srt4(spark, d):
    return rank_candidates(runs(spark, d).select("as_of", "model_version", "gini_test")).select("as_of", "model_version", "runner_up")


@query("srt5_worst_offender", """WITH @panel, m AS (SELECT month, model, avg(score) AS s FROM panel GROUP BY ALL)
 SELECT month, max_by(model, s) AS worst, min_by(model, s) AS best FROM m GROUP BY month""")
def srt5(spark, d):
    rates = view(spark, d, "panel").groupBy("month", "model").agg(F.avg("score").alias("s"))
    return rates.groupBy("month").agg(F.max_by("model", "s").alias("worst"), F.min_by("model", "s").alias("best"))


@query("set1_union_by_name", "WITH @split_panel SELECT loan_id, data_split, score FROM split_panel WHERE data_split IN ('test', 'oot')")
def set1(spark, d):
    rows = view(spark, d, "panel").withColumn("data_split", split_of("label_date", split_windows(TRAIN_DATE, DATA_START)))
    a, b = (rows.filter(F.col("data_split") == s) for s in ("test", "oot"))
    return a.select("loan_id", "data_split", "score").unionByName(b.select("score", "loan_id", "data_split"))


@query("set2_union_different_columns", STORES + " SELECT loan_id, x2, CAST(NULL AS VARCHAR) AS data_split FROM inf UNION ALL SELECT loan_id, x2, data_split FROM gold")
def set2(spark, d):
    inference, gold = stores(spark, d)
    return inference.drop("month").unionByName(gold.drop("month"), allowMissingColumns=True)


@query("set3_distinct_value_union", """WITH @panel, a AS (SELECT model, count(*) * 1e0 / sum(count(*)) OVER () AS e FROM panel WHERE month < DATE '1996-01-01' AND model <> '5-LOW' GROUP BY 1),
 b AS (SELECT model, count(*) * 1e0 / sum(count(*)) OVER () AS s FROM panel WHERE month >= DATE '1996-01-01' AND model <> '1-URGENT' GROUP BY 1)
 SELECT model, round(coalesce(e, 0), 9) AS expected, round(coalesce(s, 0), 9) AS actual FROM a FULL JOIN b USING (model)""")
def set3(spark, d):
    panel = view(spark, d, "panel").select(F.lit("model").alias("feature"), F.col("model").alias("bin"), "month")
    e = shares(panel.filter("month < DATE '1996-01-01' AND bin <> '5-LOW'")).select("bin", F.col("share").alias("expected"))
    a = shares(panel.filter("month >= DATE '1996-01-01' AND bin <> '1-URGENT'")).select("bin", F.col("share").alias("actual"))
    return (e.join(a, "bin", "full_outer").fillna(0.0, ["expected", "actual"])
            .select(F.col("bin").alias("model"), F.round("expected", 9).alias("expected"), F.round("actual", 9).alias("actual")))


@query("dq2_one_to_one", "SELECT CAST(o_orderkey AS VARCHAR) AS loan_id, o_totalprice, o_orderstatus FROM orders")
def dq2(spark, d):
    orders = table(spark, d, "orders").withColumn("loan_id", F.col("o_orderkey").cast("string"))
    return one_to_one(orders.select("loan_id", "o_totalprice"), orders.select("loan_id", "o_orderstatus"), ["loan_id"])
