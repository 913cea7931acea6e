"""Sources, sinks, landing and calendar."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.dates import calendar_months, month_spine, month_start, split_of, split_windows
from panelkit.plans.bronze import land, snapshot_slice
from panelkit.plans.monitoring import known_labels
from panelkit.session import fresh_path
from panelkit.sources.readers import availability, read_catalog, read_table, read_text, require_source
from panelkit.sources.schema import LOAN_TYPES, enforce
from panelkit.sources.sinks import append_events, event_row, fill_partitions, write_partitions, write_report, write_table
from panelkit.sources.versions import publish, read_published
from panelkit.streaming.landing import land_new_files
from workload.registry import query
from workload.views import DATA_START, TRAIN_DATE, as_text, runs, view

PANEL_COLUMNS = ["loan_id", "Customer_ID", "label", "label_date", "x1"]
PANEL_TEXT = """SELECT loan_id, Customer_ID, CAST(label AS VARCHAR) AS label, CAST(label_date AS VARCHAR) AS label_date,
 CAST(x1 AS VARCHAR) AS x1 FROM panel"""


@query("src1_csv_scan", "WITH @ledger SELECT * FROM ledger")
def src1(spark, d):
    path = fresh_path(spark, "csv")
    write_table(view(spark, d, "ledger"), path, "csv")
    return enforce(read_text(spark, [path], list(LOAN_TYPES)), LOAN_TYPES)


@query("src2_history_and_increment", f"WITH @panel {PANEL_TEXT}")
def src2(spark, d):
    base = fresh_path(spark, "raw")
    rows = view(spark, d, "panel").select(*PANEL_COLUMNS)
    write_table(rows.filter("label_date < DATE '2000-01-01'"), f"{base}/history", "csv")
    write_table(rows.filter("label_date >= DATE '2000-01-01'"), f"{base}/incoming", "csv")
    return read_text(spark, [f"{base}/history", f"{base}/incoming"], PANEL_COLUMNS)


@query("src3_parquet_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, "
       "o_orderpriority FROM orders")
def src3(spark, d):
    return read_table(spark, f"{d}/orders.parquet").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("src4_partitioned_folder", "WITH @panel SELECT month, count(*) AS n, CAST(sum(label) AS BIGINT) AS bads FROM panel GROUP BY month")
def src4(spark, d):
    path = fresh_path(spark, "by-month")
    write_partitions(view(spark, d, "panel").select("loan_id", "label", "month"), path, ["month"])
    return read_table(spark, path).groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bads"))


@query("src5_pruned_columns", "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL")
def src5(spark, d):
    dates = read_table(spark, f"{d}/orders.parquet", ["o_orderdate"])
    return dates.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("src6_source_catalog", """WITH @attributes_raw, @financials_raw, @ledger SELECT 'attributes' AS source, count(*) AS n, count(DISTINCT Customer_ID) AS customers FROM attributes_raw
 UNION ALL SELECT 'financials', count(*), count(DISTINCT Customer_ID) FROM financials_raw UNION ALL SELECT 'loans', count(*), count(DISTINCT Customer_ID) FROM ledger
 UNION ALL SELECT 'clicks', count(*), count(DISTINCT user_id) FROM events""")
def src6(spark, d):
    """All four sources as folders of text files, read back as one catalog."""
    base, catalog = fresh_path(spark, "catalog"), {}
    raws = {"attributes": view(spark, d, "attributes_raw"), "financials": view(spark, d, "financials_raw"), "loans": as_text(view(spark, d, "ledger")),
            "clicks": as_text(view(spark, d, "clicks"))}
    for name, raw in raws.items():
        write_table(raw, f"{base}/{name}", "csv")
        catalog[name] = (f"{base}/{name}", raw.columns)
    parts = [t.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n"), F.count_distinct("Customer_ID").alias("customers"))
             for name, t in read_catalog(spark, catalog).items()]
    return reduce(DataFrame.unionByName, parts)


@query("src7_required_source", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def src7(spark, d):
    nations, regions = (spark.read.parquet(*require_source(spark, t, [f"{d}/{t}.parquet", f"{d}/{t}_missing.parquet"]))
                        for t in ("nation", "region"))
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select("n_name", "r_name")


@query("src8_availability", """WITH @panel SELECT count(*) FILTER (label_date = DATE '2000-06-01') AS n_to_score,
 count(*) FILTER (label_date = DATE '2000-06-01' AND label = 1) AS n_new_labels,
 count(DISTINCT CASE WHEN label = 1 AND label_date < DATE '2000-06-01' THEN month END) AS labelled_months FROM panel""")
def src8(spark, d):
    panel = view(spark, d, "panel")
    return availability(panel, panel.filter("label = 1"), "label_date", "label_date", "2000-06-01")


@query("snk1_csv_partitions", f"WITH @panel SELECT *, month FROM (SELECT loan_id, Customer_ID, CAST(label AS VARCHAR) AS label, "
       "CAST(x1 AS VARCHAR) AS x1, month FROM panel)".replace("SELECT *, month FROM", "SELECT * FROM"))
def snk1(spark, d):
    path = fresh_path(spark, "csv-parts")
    write_partitions(view(spark, d, "panel").select("loan_id", "Customer_ID", "label", "x1", "month"), path, ["month"], "csv")
    return spark.read.schema("loan_id string, Customer_ID string, label string, x1 string, month date").option("header", "true").csv(path)


@query("snk2_parquet_overwrite", "WITH @panel SELECT loan_id, label, month FROM panel WHERE label = 1")
def snk2(spark, d):
    path = fresh_path(spark, "overwrite")
    rows = view(spark, d, "panel").select("loan_id", "label", "month")
    write_table(rows.filter("label = 0"), path)
    write_table(rows.filter("label = 1"), path)
    return spark.read.parquet(path)


@query("snk3_dynamic_partitions", """WITH @panel, again AS (SELECT * FROM panel WHERE month >= DATE '2000-01-01' AND label = 1)
 SELECT loan_id, month, 'first' AS written FROM panel WHERE month NOT IN (SELECT month FROM again)
 UNION ALL SELECT loan_id, month, 'second' FROM again""")
def snk3(spark, d):
    path = fresh_path(spark, "dynamic")
    rows = view(spark, d, "panel").select("loan_id", "month", "label")
    write_partitions(rows.drop("label").withColumn("written", F.lit("first")), path, ["month"])
    again = rows.filter("month >= DATE '2000-01-01' AND label = 1").drop("label").withColumn("written", F.lit("second"))
    write_partitions(again, path, ["month"])
    return spark.read.parquet(path).select("loan_id", "month", "written")


@query("snk4_metric_partitions", "WITH @panel SELECT model, month, count(*) AS n, round(avg(score), 8) AS mean_score FROM panel GROUP BY ALL")
def snk4(spark, d):
    path = fresh_path(spark, "metrics")
    metrics = view(spark, d, "panel").groupBy("model", F.year("month").alias("year"), "month").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 8).alias("mean_score"))
    write_partitions(metrics, path, ["model", "year"])
    return spark.read.parquet(path).select("model", "month", "n", "mean_score")


@query("snk5_event_log", """WITH @runs SELECT CAST(as_of AS VARCHAR) AS as_of_date, 'training' AS event, CAST(as_of AS VARCHAR) AS logged_at,
 model_version AS best_candidate, CAST(to_json({'n_rows': n_rows, 'model': model_version}) AS VARCHAR) AS detail FROM runs""")
def snk5(spark, d):
    path = fresh_path(spark, "events")
    made = runs(spark, d).select(
        F.col("as_of").alias("day"), F.lit("training").alias("kind"), F.col("as_of").alias("at"),
        F.col("model_version").alias("best_candidate"), F.struct("n_rows", F.col("model_version").alias("model")).alias("detail"))
    log = event_row(made, "day", "kind", "at")
    append_events(log.filter("as_of_date < '1998-01-01'"), path)
    append_events(log.filter("as_of_date >= '1998-01-01'"), path)
    return spark.read.parquet(path)


@query("snk6_missing_partitions", """WITH @panel SELECT loan_id, month, CASE WHEN month < DATE '1998-01-01' THEN 'old' ELSE 'new' END AS written
 FROM panel""")
def snk6(spark, d):
    path = fresh_path(spark, "fill")
    rows = view(spark, d, "panel").select("loan_id", "month")
    write_partitions(rows.filter("month < DATE '1998-01-01'").withColumn("written", F.lit("old")), path, ["month"])
    fill_partitions(rows.withColumn("written", F.lit("new")), path, "month")
    return spark.read.parquet(path).select("loan_id", "month", "written")


@query("snk7_csv_report", "WITH @panel SELECT model, CAST(month AS VARCHAR) AS month, CAST(count(*) AS VARCHAR) AS n FROM panel GROUP BY ALL")
def snk7(spark, d):
    path = fresh_path(spark, "report")
    write_report(view(spark, d, "panel").groupBy("model", "month").agg(F.count(F.lit(1)).alias("n")), path, ["model", "month"])
    return spark.read.schema("model string, month string, n string").option("header", "true").csv(path)


@query("cal1_month_spine", """WITH @panel, b AS (SELECT model, min(label_date) AS s, max(label_date) AS e FROM panel GROUP BY model)
 SELECT model, CAST(unnest(generate_series(CAST(date_trunc('month', s) AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)
 AS month FROM b""")
def cal1(spark, d):
    bounds = view(spark, d, "panel").groupBy("model").agg(F.min("label_date").alias("s"), F.max("label_date").alias("e"))
    return month_spine(bounds, "s", "e")


@query("cal2_snapshot_slice", """WITH @panel, raw AS (SELECT loan_id, CASE WHEN label = 1 THEN CAST(month AS VARCHAR) ELSE 'not a date' END
 AS snapshot_date FROM panel) SELECT * FROM raw WHERE TRY_CAST(snapshot_date AS DATE) = DATE '1999-03-01'""")
def cal2(spark, d):
    raw = view(spark, d, "panel").selectExpr(
        "loan_id", "CASE WHEN label = 1 THEN CAST(month AS STRING) ELSE 'not a date' END AS snapshot_date")
    return snapshot_slice(raw, "1999-03-01")


@query("cal3_backfill", """WITH @ledger, b AS (SELECT min(snapshot_date) AS s, max(snapshot_date) AS e FROM ledger),
 spine AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', s) AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE)
 AS month FROM b), m AS (SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month, count(*) AS n,
 round(sum(overdue_amt), 2) AS overdue FROM ledger GROUP BY 1)
 SELECT spine.month, coalesce(n, 0) AS n, coalesce(overdue, 0) AS overdue FROM spine LEFT JOIN m USING (month)""")
def cal3(spark, d):
    ledger = view(spark, d, "ledger")
    spine = month_spine(ledger.agg(F.min("snapshot_date").alias("s"), F.max("snapshot_date").alias("e")), "s", "e")
    monthly = ledger.groupBy(month_start("snapshot_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("overdue_amt"), 2).alias("overdue"))
    return spine.join(monthly, "month", "left").fillna(0, ["n", "overdue"])


@query("cal4_calendar_months", """WITH @panel SELECT loan_id, CAST((2001 - year(label_date)) * 12 + 6 - month(label_date) AS INTEGER)
 AS months FROM panel""")
def cal4(spark, d):
    return view(spark, d, "panel").select("loan_id", calendar_months(F.lit(TRAIN_DATE).cast("date"), "label_date").alias("months"))


@query("cal5_split_windows", """WITH @split_panel SELECT data_split, count(*) AS n, min(label_date) AS first_date, max(label_date) AS last_date
 FROM split_panel WHERE data_split IS NOT NULL GROUP BY data_split""")
def cal5(spark, d):
    split = split_of("label_date", split_windows(TRAIN_DATE, DATA_START))
    return (view(spark, d, "panel").withColumn("data_split", split).filter("data_split IS NOT NULL").groupBy("data_split")
            .agg(F.count(F.lit(1)).alias("n"), F.min("label_date").alias("first_date"), F.max("label_date").alias("last_date")))


@query("cal6_asof_cutoff", "WITH @panel SELECT month, count(*) AS n FROM panel WHERE label_date <= DATE '1999-06-15' GROUP BY month")
def cal6(spark, d):
    return known_labels(view(spark, d, "panel"), "1999-06-15").groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query("fs1_bronze_landing", """WITH @attributes_raw SELECT Customer_ID, Name, Age, SSN, Occupation, CAST(snapshot_date AS DATE) AS snapshot_date
 FROM attributes_raw""")
def fs1(spark, d):
    raw, base = view(spark, d, "attributes_raw"), fresh_path(spark, "bronze")
    raw.write.option("header", "true").option("nullValue", "\u0000").csv(f"{base}/raw")
    columns = raw.columns
    first = raw.filter("snapshot_date < '1998-01-01'").select(F.col("snapshot_date").cast("date").alias("snapshot_date"))
    land(spark, "features_attributes", [f"{base}/raw"], columns, f"{base}/bronze", days=first)
    land(spark, "features_attributes", [f"{base}/raw"], columns, f"{base}/bronze", force=False)
    landed = spark.read.parquet(f"{base}/bronze").select(*columns)
    return landed.select(*[F.when(F.col(c) != "\u0000", F.col(c)).alias(c) if c != "snapshot_date" else F.col(c) for c in columns])


STREAM_TYPES = {"loan_id": "string", "label": "int", "x1": "double", "snapshot_date": "date"}


@query("stm1_incremental_landing", "WITH @panel SELECT loan_id, label, x1, month AS snapshot_date FROM panel")
def stm1(spark, d):
    base = fresh_path(spark, "stream")
    rows = as_text(view(spark, d, "panel").select("loan_id", "label", "x1", F.col("month").alias("snapshot_date")))
    columns = list(STREAM_TYPES)

    def deliver(part, name):
        part.write.option("header", "true").csv(f"{base}/incoming/{name}")
        land_new_files(spark, f"{base}/incoming", columns, STREAM_TYPES, f"{base}/table", f"{base}/offsets", ["loan_id"])

    late = "snapshot_date >= '1998-06-01' AND label = '1'"
    deliver(rows.filter(f"snapshot_date < '1999-01-01' AND NOT ({late})"), "d1")
    deliver(rows.filter(f"snapshot_date >= '1999-01-01' OR ({late})"), "d2")  # adds to months landed before
    deliver(rows.filter("snapshot_date >= '2001-01-01'"), "d3")  # delivered again
    return spark.read.parquet(f"{base}/table").select(*columns)


@query("snk5_published_versions", """WITH @panel SELECT loan_id, label, CASE WHEN month >= DATE '1999-01-01' AND month < DATE '1999-07-01' THEN round(x1 * 2, 2) ELSE round(x1, 2) END AS x1, month AS snapshot_date FROM panel""")
def snk5_versions(spark, d):
    """A table in versions: a first version, half a year replaced, a run that ends before its pointer moves, and the second run again."""
    root = fresh_path(spark, "versions")
    rows = view(spark, d, "panel").select("loan_id", "label", F.round("x1", 2).alias("x1"), F.col("month").alias("snapshot_date"))
    publish(rows, root, "snapshot_date", "first")
    half = rows.filter("snapshot_date >= DATE '1999-01-01' AND snapshot_date < DATE '1999-07-01'").withColumn("x1", F.round(F.col("x1") * 2, 2))
    publish(half, root, "snapshot_date", "second")
    half.withColumn("x1", F.lit(-1.0)).write.partitionBy("snapshot_date").parquet(f"{root}/data/version=unfinished")  # ended before its manifest
    publish(half.withColumn("x1", F.lit(-2.0)), root, "snapshot_date", "second")  # the run is in already
    return read_published(spark, root).select("loan_id", "label", "x1", "snapshot_date")


@query("stm1_published_landing", "WITH @panel SELECT loan_id, label, x1, month AS snapshot_date FROM panel")
def stm1_published(spark, d):
    """New files landed as versions."""
    base = fresh_path(spark, "stream")
    rows = as_text(view(spark, d, "panel").select("loan_id", "label", "x1", F.col("month").alias("snapshot_date")))
    columns = list(STREAM_TYPES)
    for name, part in (("d1", rows.filter("snapshot_date < '1999-01-01'")), ("d2", rows.filter("snapshot_date >= '1998-10-01'"))):
        part.write.option("header", "true").csv(f"{base}/incoming/{name}")
        land_new_files(spark, f"{base}/incoming", columns, STREAM_TYPES, f"{base}/table", f"{base}/offsets", ["loan_id"], versioned=True)
    return read_published(spark, f"{base}/table").select(*columns)
