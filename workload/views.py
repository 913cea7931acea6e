"""Credit-style views derived from the driver's tables, for Spark and as SQL text.

The expressions are plain SQL that both engines read alike; they are the inputs of the queries, not their logic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.plans.governance import rank_candidates

TRAIN_DATE = "2001-06-01"
DATA_START = "1995-01-01"

SPLIT_SQL = """CASE WHEN {d} BETWEEN DATE '1995-01-01' AND DATE '2000-12-31' THEN 'train'
 WHEN {d} BETWEEN DATE '2001-01-01' AND DATE '2001-01-31' THEN 'validation'
 WHEN {d} BETWEEN DATE '2001-02-01' AND DATE '2001-03-31' THEN 'test'
 WHEN {d} BETWEEN DATE '2001-04-01' AND DATE '2001-05-31' THEN 'oot' END"""

APPLIED = ("make_date(CAST(1995 + floor((c_custkey % 80) / 12) AS INT), "
           "CAST(1 + (c_custkey % 80) % 12 AS INT), 1)")

# view -> (source table, {column: expression})
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    # one row per loan with a score, an outcome and its date
    "panel": ("orders", {
        "loan_id": "CAST(o_orderkey AS STRING)", "Customer_ID": "CAST(o_custkey AS STRING)",
        "score": "o_totalprice / 500000", "label": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END",
        "label_date": "CAST(o_orderdate AS DATE)", "month": "make_date(year(o_orderdate), month(o_orderdate), 1)",
        "model": "o_orderpriority", "x1": "o_totalprice", "x2": "CAST(o_custkey % 101 AS DOUBLE)",
        "x3": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST((o_orderkey * 7) % 53 AS DOUBLE) END",
        "level": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END"}),
    # instalment ledger
    "ledger": ("lineitem", {
        "loan_id": "CAST(l_orderkey AS STRING)", "Customer_ID": "CAST(l_suppkey AS STRING)",
        "loan_start_date": "CAST(l_shipdate AS DATE) - 30 * l_linenumber", "tenure": "10",
        "installment_num": "l_linenumber", "loan_amt": "l_extendedprice * 10",
        "due_amt": "CASE WHEN l_linenumber = 7 THEN 0e0 ELSE l_extendedprice END",
        "paid_amt": "CASE WHEN l_returnflag = 'R' THEN 0e0 ELSE l_extendedprice END",
        "overdue_amt": "CASE WHEN l_returnflag = 'R' THEN l_extendedprice * (CAST(l_quantity AS INT) % 4) ELSE 0e0 END",
        "balance": "l_extendedprice * (10 - l_linenumber)", "snapshot_date": "CAST(l_shipdate AS DATE)"}),
    # raw customer attributes, noisy text
    "attributes_raw": ("customer", {
        "Customer_ID": "CAST(c_custkey AS STRING)", "Name": "c_name",
        "Age": "CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN '-500' "
               "WHEN c_custkey % 19 = 0 THEN '8000' WHEN c_custkey % 7 = 0 "
               "THEN concat(CAST(18 + c_custkey % 60 AS STRING), '_') ELSE CAST(18 + c_custkey % 60 AS STRING) END",
        "SSN": "concat('900-', CAST(c_custkey % 1000 AS STRING))",
        "Occupation": "CASE WHEN c_custkey % 37 = 0 THEN '_______' WHEN c_custkey % 41 = 0 THEN NULL ELSE c_mktsegment END",
        "snapshot_date": f"CAST({APPLIED} AS STRING)"}),
    # raw customer financials, noisy text
    "financials_raw": ("customer", {
        "Customer_ID": "CAST(c_custkey AS STRING)",
        "Annual_Income": "CASE WHEN c_custkey % 43 = 0 THEN NULL WHEN c_custkey % 11 = 0 "
                         "THEN concat(CAST(c_acctbal AS STRING), '_') ELSE CAST(c_acctbal AS STRING) END",
        "Monthly_Inhand_Salary": "CAST((c_custkey % 977) / 8e0 AS STRING)",
        "Num_Bank_Accounts": "CASE WHEN c_custkey % 47 = 0 THEN '900' WHEN c_custkey % 29 = 0 THEN '-1' "
                             "WHEN c_custkey % 27 = 0 THEN NULL ELSE CAST(c_custkey % 12 AS STRING) END",
        "Num_Credit_Card": "CASE WHEN c_custkey % 53 = 0 THEN '500' WHEN c_custkey % 28 = 0 THEN NULL "
                           "ELSE CAST((c_custkey * 7) % 11 AS STRING) END",
        "Interest_Rate": "CAST(c_custkey % 60 AS STRING)",
        "Num_of_Loan": "CASE WHEN c_custkey % 9 = 0 THEN concat(CAST(c_custkey % 8 AS STRING), '_') "
                       "ELSE CAST(c_custkey % 8 AS STRING) END",
        "Type_of_Loan": "CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Auto Loan' WHEN 2 THEN 'Auto Loan, and Home Loan' "
                        "WHEN 3 THEN 'Payday Loan, Auto Loan, and Student Loan' "
                        "WHEN 4 THEN 'Debt-Consolidation Loan , Not Specified' ELSE 'Personal Loan and Auto Loan' END",
        "Delay_from_due_date": "CAST(c_custkey % 65 AS STRING)",
        "Num_of_Delayed_Payment": "CASE WHEN c_custkey % 9 = 0 THEN concat(CAST(c_custkey % 70 - 3 AS STRING), '_') "
                                  "ELSE CAST(c_custkey % 70 - 3 AS STRING) END",
        "Changed_Credit_Limit": "CASE WHEN c_custkey % 10 = 0 THEN '_' ELSE CAST((c_custkey % 200) / 8e0 AS STRING) END",
        "Num_Credit_Inquiries": "CAST(c_custkey % 40 - 2 AS STRING)",
        "Credit_Mix": "CASE c_nationkey % 4 WHEN 0 THEN 'Good' WHEN 1 THEN 'Standard' WHEN 2 THEN 'Bad' ELSE '_' END",
        "Outstanding_Debt": "CASE WHEN c_custkey % 13 = 0 THEN concat(CAST(abs(c_acctbal) AS STRING), '_') "
                            "ELSE CAST(abs(c_acctbal) AS STRING) END",
        "Credit_Utilization_Ratio": "CAST((c_custkey % 1000) / 16e0 AS STRING)",
        "Credit_History_Age": "CASE WHEN c_custkey % 26 = 0 THEN NULL WHEN c_custkey % 14 = 0 THEN '7 Years' "
                              "ELSE concat(CAST(c_custkey % 34 AS STRING), ' Years and ', CAST(c_custkey % 12 AS STRING), "
                              "' Months') END",
        "Payment_of_Min_Amount": "CASE c_nationkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END",
        "Total_EMI_per_month": "CAST((c_custkey % 500) / 4e0 AS STRING)",
        "Amount_invested_monthly": "CASE WHEN c_custkey % 15 = 0 THEN '__10000__' "
                                   "ELSE CAST((c_custkey % 800) / 2e0 AS STRING) END",
        "Payment_Behaviour": "CASE WHEN c_custkey % 16 = 0 THEN '!@9#%8' WHEN c_custkey % 2 = 0 "
                             "THEN 'High_spent_Large_value_payments' ELSE 'Low_spent_Small_value_payments' END",
        "Monthly_Balance": "CASE WHEN c_custkey % 70 = 0 THEN '__-333333333333333333333333333__' "
                           "ELSE CAST((c_custkey % 900) / 4e0 AS STRING) END",
        "snapshot_date": f"CAST({APPLIED} AS STRING)"}),
    # clickstream of the event users
    "clicks": ("events", {
        "Customer_ID": "CAST(user_id AS STRING)", "clicks_snapshot_date": "CAST(ts AS DATE)", "fe_1": "value",
        "fe_2": "CAST(event_id % 97 AS DOUBLE)",
        "fe_3": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 31 AS DOUBLE) END"}),
    # orders seen as the clickstream of the panel's customers
    "order_clicks": ("orders", {
        "Customer_ID": "CAST(o_custkey AS STRING)", "clicks_snapshot_date": "CAST(o_orderdate AS DATE)",
        "fe_1": "o_totalprice", "fe_3": "CAST(o_orderkey % 41 AS DOUBLE)", "fe_4": "CAST(o_orderkey % 17 AS DOUBLE)",
        **{f"fe_{k}": f"CAST((o_orderkey * {k}) % {30 + k} AS DOUBLE)" for k in (5, 8, 9, 10, 14, 16)}}),
}

# further views in SQL; the Spark side gets them from the package
DERIVED: dict[str, str] = {
    "label_keys": "label_keys AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS Customer_ID, "
                  "CAST(ts AS DATE) AS labels_snapshot_date FROM events WHERE event_type = 'purchase')",
    "split_panel": "@panel, split_panel AS (SELECT * FROM (SELECT *, "
                   + SPLIT_SQL.format(d="label_date") + " AS data_split FROM panel))",
    "attributes": """@attributes_raw, attributes AS (SELECT Customer_ID, Name, TRY_CAST(replace(Age, '_', '') AS INTEGER) AS Age,
 SSN, replace(Occupation, '_', '') AS Occupation, TRY_CAST(snapshot_date AS DATE) AS snapshot_date FROM attributes_raw)""",
    "financials": """@financials_raw, financials_list AS (SELECT *, trim(regexp_replace(regexp_replace(
 coalesce(Type_of_Loan, 'Not Specified'), '\\s+and\\s+', '', 'g'), '\\s*,\\s*', ',', 'g')) AS Type_of_Loan_Cleaned FROM financials_raw),
financials AS (SELECT Customer_ID, TRY_CAST(replace(Annual_Income, '_', '') AS DOUBLE) AS Annual_Income,
 TRY_CAST(Monthly_Inhand_Salary AS DOUBLE) AS Monthly_Inhand_Salary, TRY_CAST(Num_Bank_Accounts AS INTEGER) AS Num_Bank_Accounts,
 TRY_CAST(Num_Credit_Card AS INTEGER) AS Num_Credit_Card, TRY_CAST(Interest_Rate AS INTEGER) AS Interest_Rate,
 TRY_CAST(replace(Num_of_Loan, '_', '') AS INTEGER) AS Num_of_Loan, Type_of_Loan,
 TRY_CAST(Delay_from_due_date AS INTEGER) AS Delay_from_due_date,
 TRY_CAST(replace(Num_of_Delayed_Payment, '_', '') AS INTEGER) AS Num_of_Delayed_Payment,
 TRY_CAST(replace(Changed_Credit_Limit, '_', '') AS DOUBLE) AS Changed_Credit_Limit,
 TRY_CAST(Num_Credit_Inquiries AS INTEGER) AS Num_Credit_Inquiries, replace(Credit_Mix, '_', 'Not Defined') AS Credit_Mix,
 TRY_CAST(replace(Outstanding_Debt, '_', '') AS DOUBLE) AS Outstanding_Debt,
 TRY_CAST(Credit_Utilization_Ratio AS DOUBLE) AS Credit_Utilization_Ratio, Credit_History_Age, Payment_of_Min_Amount,
 TRY_CAST(Total_EMI_per_month AS DOUBLE) AS Total_EMI_per_month,
 TRY_CAST(replace(Amount_invested_monthly, '_', '') AS DOUBLE) AS Amount_invested_monthly, Payment_Behaviour,
 TRY_CAST(replace(Monthly_Balance, '_', '') AS DOUBLE) AS Monthly_Balance, TRY_CAST(snapshot_date AS DATE) AS snapshot_date,
 Type_of_Loan_Cleaned, CAST(len(string_split(Type_of_Loan_Cleaned, ',')) AS INTEGER) AS Num_of_Loan_Cleaned,
 TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s+Years?', 1) AS DOUBLE)
 + TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s+Months?', 1) AS DOUBLE) / 12 AS Credit_History_Age_Years,
 CASE WHEN Payment_Behaviour = '!@9#%8' THEN 'High_spent_Small_value_payments' ELSE Payment_Behaviour END AS Payment_Behaviour_Imputed
 FROM financials_list)""",
    "silver_loans": """@ledger, missed AS (SELECT *, installment_num AS mob,
 coalesce(CAST(ceil(overdue_amt / nullif(due_amt, 0)) AS INTEGER), 0) AS installments_missed FROM ledger),
first_missed AS (SELECT *, CASE WHEN installments_missed > 0 THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END
 AS first_missed_date FROM missed),
silver_loans AS (SELECT *, CASE WHEN overdue_amt > 0 THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INTEGER)
 ELSE 0 END AS dpd FROM first_missed)""",
    "runs": """@panel, half AS (SELECT CAST(make_date(year(label_date), CASE WHEN month(label_date) <= 6 THEN 1 ELSE 7 END, 1) AS DATE) AS as_of,
 concat('credit_model_', replace(model, ' ', '_'), '_', CAST(year(label_date) AS VARCHAR), CASE WHEN month(label_date) <= 6 THEN 'a' ELSE 'b' END)
 AS model_version, CASE WHEN month(label_date) <= 6 THEN 1e0 ELSE 0.9e0 END AS w, score, label FROM panel),
runs AS (SELECT as_of, model_version, avg(score) * w AS gini_test, avg(CASE WHEN label = 1 THEN score END) AS gini_oot,
 count(*) AS n_rows FROM half GROUP BY as_of, model_version, w)""",
    "roles": """@runs, placed AS (SELECT *, row_number() OVER (PARTITION BY as_of ORDER BY gini_test DESC, model_version) AS place FROM runs),
roles AS (SELECT as_of AS effective_from, max(CASE WHEN place = 1 THEN model_version END) AS champion,
 max(CASE WHEN place = 2 THEN model_version END) AS challenger, 'scheduled refresh' AS reason FROM placed GROUP BY as_of)""",
    "months": "@panel, months AS (SELECT DISTINCT month FROM panel)",
}


def cte(*names: str) -> str:
    """The common table expressions of views, with those they need, each once."""
    seen: dict[str, str] = {}
    for name in names:
        _collect(name, seen)
    return ", ".join(seen.values())


def _collect(name: str, seen: dict[str, str]) -> None:
    if name in seen:
        return
    if name in VIEWS:
        table, columns = VIEWS[name]
        body = ", ".join(f"{e} AS {c}" for c, e in columns.items())
        seen[name] = f"{name} AS (SELECT {body} FROM {table})"
        return
    text = DERIVED[name]
    while text.startswith("@"):
        needed, text = text[1:].split(", ", 1)
        _collect(needed, seen)
    seen[name] = text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view."""
    source, columns = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, as a raw file delivers it."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def label_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label dates of the event users: days with a purchase."""
    return (table(spark, sf_dir, "events").filter("event_type = 'purchase'")
            .selectExpr("CAST(user_id AS STRING) AS Customer_ID", "CAST(ts AS DATE) AS labels_snapshot_date").distinct())


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training runs: one candidate per priority and half-year, its metrics taken from the orders."""
    half = "CASE WHEN month(label_date) <= 6 THEN {} ELSE {} END"
    return (view(spark, sf_dir, "panel")
            .groupBy(F.expr(f"make_date(year(label_date), {half.format(1, 7)}, 1)").alias("as_of"),
                     F.expr("concat('credit_model_', replace(model, ' ', '_'), '_', CAST(year(label_date) AS STRING), "
                            f"{half.format(chr(39) + 'a' + chr(39), chr(39) + 'b' + chr(39))})").alias("model_version"),
                     F.expr(half.format("1e0", "0.9e0")).alias("w"))
            .agg(F.avg("score").alias("g"), F.avg(F.expr("CASE WHEN label = 1 THEN score END")).alias("gini_oot"),
                 F.count(F.lit(1)).alias("n_rows"))
            .select("as_of", "model_version", (F.col("g") * F.col("w")).alias("gini_test"), "gini_oot", "n_rows"))


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role history: the best two candidates of each run."""
    ranked = rank_candidates(runs(spark, sf_dir).select("as_of", "model_version", "gini_test"))
    return ranked.select(F.col("as_of").alias("effective_from"), F.col("model_version").alias("champion"),
                         F.col("runner_up").alias("challenger"), F.lit("scheduled refresh").alias("reason"))


#: Every month of the years that the orders cover; a pivot names its columns beforehand.
ALL_MONTHS = [f"{year}-{month:02d}" for year in range(1995, 2002) for month in range(1, 13)]


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months with data."""
    return view(spark, sf_dir, "panel").select("month").distinct()
