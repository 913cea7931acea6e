"""Whole builds: training and scoring paths agree, sinks are idempotent, models round-trip."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelkit.functions.dates import split_windows
from panelkit.plans.gold import feature_store, join_sources
from panelkit.plans.governance import promotion, rank_candidates, upsert_roles
from panelkit.plans.inference import inference_features, rows_to_monitor, rows_to_score
from panelkit.plans.modelling import expanding_folds, fit_linear_prep, fit_tree_prep, monotonicity, train_logreg
from panelkit.plans.params import load_params
from panelkit.session import fresh_path, shared_dir
from panelkit.sources.readers import read_text, require_source
from panelkit.sources.sinks import fill_partitions, write_partitions, write_table
from panelkit.streaming.landing import land_new_files
from workload.q_joins import financials, labels, people
from workload.views import DATA_START, TRAIN_DATE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark):
    windows = split_windows(TRAIN_DATE, DATA_START)
    made, params = feature_store(labels(spark, SF), people(spark, SF), financials(spark, SF), windows, train_date=TRAIN_DATE)
    return made, params


def test_store_has_one_row_per_label_and_no_label(spark, built):
    made, _ = built
    inside = labels(spark, SF).filter("snapshot_date < DATE '2001-06-01'").count()
    assert made.count() == inside == made.select("loan_id").distinct().count()
    assert "label" not in made.columns and "Name" not in made.columns and "SSN" not in made.columns


def test_training_and_scoring_paths_agree(spark, built):
    made, params = built
    path = fresh_path(spark, "params")
    params.save(spark, path)
    again = load_params(spark, path, TRAIN_DATE)
    assert again.scalars == params.scalars and again.edges == params.edges
    scored = inference_features(financials(spark, SF), people(spark, SF), again)
    common = ["Age_imputed", "Bank_Accounts_imputed", "Credit_Cards_imputed", "Age_Bin", "Changed_Credit_Limit", "Debt_per_Credit_Account"]
    left = made.select("Customer_ID", *[F.col(c).cast("string").alias(c) if c == "Age_Bin" else F.col(c).cast("double").alias(c) for c in common]).distinct()
    right = scored.select("Customer_ID", *common).distinct()
    both = left.alias("a").join(right.alias("b"), "Customer_ID")
    differ = F.lit(False)
    for c in common:
        differ = differ | ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    assert both.count() > 100 and both.filter(differ).count() == 0


def test_point_in_time_never_looks_ahead(spark):
    rows = join_sources(labels(spark, SF), people(spark, SF), financials(spark, SF), point_in_time=True)
    assert rows.count() == labels(spark, SF).count()
    assert rows.filter("attributes_snapshot_date > labels_snapshot_date OR financials_snapshot_date > labels_snapshot_date").count() == 0


def test_rewriting_a_partition_keeps_the_others(spark):
    path = fresh_path(spark, "idempotent")
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "v string, p string")
    for _ in range(2):
        write_partitions(df, path, ["p"])
    write_partitions(df.filter("p = 'y'").withColumn("v", F.lit("new")), path, ["p"])
    fill_partitions(spark.createDataFrame([("z", "x"), ("c", "w")], "v string, p string"), path, "p")
    assert sorted(map(tuple, spark.read.parquet(path).select("p", "v").collect())) == [("w", "c"), ("x", "a"), ("y", "new")]


def test_source_check(spark):
    path = fresh_path(spark, "src")
    write_table(spark.createDataFrame([("", "1"), (None, "2")], "a string, b string"), path, "csv")
    assert require_source(spark, "t", [path, path + "-gone"]) == [path]
    with pytest.raises(FileNotFoundError):
        require_source(spark, "t", [path + "-gone"])
    assert {r["b"] for r in read_text(spark, [path], ["a", "b"]).collect()} == {"1", "2"}


def test_stream_merges_late_rows_and_ignores_replays(spark):
    base = fresh_path(spark, "stream")
    types = {"id": "string", "v": "int", "snapshot_date": "date"}

    def deliver(name, rows):
        spark.createDataFrame(rows, "id string, v string, snapshot_date string").write.option("header", "true").csv(f"{base}/in/{name}")
        land_new_files(spark, f"{base}/in", list(types), types, f"{base}/table", f"{base}/offsets", ["id"])
        return sorted(map(tuple, spark.read.parquet(f"{base}/table").select("id", "v", "snapshot_date").collect()))

    a, b = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    deliver("d1", [("1", "1", "2024-01-01"), ("2", "x", "2024-01-01"), ("3", "3", "no date")])
    assert deliver("d2", [("4", "4", "2024-01-01"), ("5", "5", "2024-02-01")]) == [("1", 1, a), ("2", None, a), ("4", 4, a), ("5", 5, b)]
    assert deliver("d3", [("1", "9", "2024-01-01")]) == [("1", 9, a), ("2", None, a), ("4", 4, a), ("5", 5, b)]
    rejected = spark.read.parquet(f"{base}/table_rejected").collect()
    assert [(r["id"], r["v"], r["snapshot_date"]) for r in rejected] == [("3", "3", "no date")] and "d1" in rejected[0]["source_file"]
    twice = spark.createDataFrame([("1", "3", "2024-01-01"), ("1", "7", "2024-01-01")], "id string, v string, snapshot_date string").coalesce(1)
    twice.write.option("header", "true").csv(f"{base}/in/d4")
    land_new_files(spark, f"{base}/in", list(types), types, f"{base}/table", f"{base}/offsets", ["id"])
    assert [r["v"] for r in spark.read.parquet(f"{base}/table").filter("id = '1'").collect()] == [7]


def test_landed_null_partition_stays(spark):
    path = fresh_path(spark, "nulls")
    write_partitions(spark.createDataFrame([("a", None), ("b", "x")], "v string, p string"), path, ["p"])
    fill_partitions(spark.createDataFrame([("c", None), ("d", "y")], "v string, p string"), path, "p")
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == ["a", "b", "d"]


def test_last_feature_with_the_wrong_sign_raises(spark):
    rows = spark.createDataFrame([(float(k), int(k > 20)) for k in range(40)], "x double, label int")
    with pytest.raises(ValueError, match="wrong sign"):
        train_logreg(rows, ["x"], [], {}, 1.0, 0.0, directions={"x": -1})


def test_monotonicity_of_a_linear_card(spark):
    rows = spark.createDataFrame([(k, float(k), int(k % 7 > 3 or k > 150)) for k in range(200)], "loan_id int, x double, label int")
    card = train_logreg(rows, ["x"], [], {}, 1.0, 0.0, directions={"x": 1})
    found = monotonicity(card, rows, rows, {"x": 1}).first()
    assert found["rows_violating"] == 0 and found["logodds_effect_min_to_max"] > 0


def test_rows_to_score_and_monitor(spark):
    inf = spark.createDataFrame([("a", "m1", 1.0)], "loan_id string, month string, x double")
    gold = spark.createDataFrame([("b", "m1", 2.0, "oot"), ("c", "m2", 3.0, "test"), ("a", "m1", 9.0, "train")],
                                 "loan_id string, month string, x double, data_split string")
    assert sorted((r["loan_id"], r["feature_source"]) for r in rows_to_score(inf, gold, "month").collect()) == [
        ("a", "inference_feature_store"), ("c", "gold_feature_store")]
    found = {r["loan_id"]: r["data_split"] for r in rows_to_monitor(inf, gold).collect()}
    assert found == {"a": "train", "b": "oot", "c": "test"}


def test_folds_of_short_and_long_histories(spark):
    def months(n):
        return spark.createDataFrame([(dt.date(2023 + i // 12, 1 + i % 12, 1),) for i in range(n)], "d date")
    long = expanding_folds(months(18), "d").groupBy("fold", "part").count().collect()
    assert {(r["fold"], r["part"]): r["count"] for r in long} == {
        (1, "fit"): 10, (1, "score"): 2, (2, "fit"): 12, (2, "score"): 2, (3, "fit"): 14, (3, "score"): 2, (4, "fit"): 16, (4, "score"): 2}
    short = expanding_folds(months(6), "d").groupBy("fold", "part").count().collect()
    assert {(r["fold"], r["part"]): r["count"] for r in short} == {
        (1, "fit"): 3, (1, "score"): 1, (2, "fit"): 4, (2, "score"): 1, (3, "fit"): 5, (3, "score"): 1}


def test_promotion_needs_a_verified_model(spark):
    runs = spark.createDataFrame([(dt.date(2024, 1, 1), "a", 0.5, 0.5), (dt.date(2024, 1, 1), "b", 0.4, 0.6)],
                                 "as_of date, model_version string, gini_test double, gini_oot double")
    none = spark.createDataFrame([], "as_of date, champion string, champion_gini_oot double")
    ranked = rank_candidates(runs)
    verified = spark.createDataFrame([("a", True)], "model_version string, verified boolean")
    assert promotion(ranked, none, verified).first()["champion_after"] == "a"
    assert not promotion(ranked, none, verified.filter("false")).first()["promoted"]  # not checked
    failed = promotion(ranked, none, spark.createDataFrame([("a", False)], "model_version string, verified boolean")).first()
    assert not failed["promoted"] and failed["reason"] == "initial candidate failed quality gates"
    better = spark.createDataFrame([(dt.date(2024, 1, 1), "old", 0.55)], "as_of date, champion string, champion_gini_oot double")
    kept = promotion(ranked, better, verified).first()
    assert (kept["champion_after"], kept["challenger_after"]) == ("old", "a")


def test_role_upsert_is_idempotent(spark):
    day = dt.date(2024, 1, 1)
    schema = "effective_from date, champion string, challenger string, reason string"
    old = spark.createDataFrame([(day, "m0", None, "manual override / rollback"), (day, "m1", None, "scheduled refresh - x")], schema)
    new = spark.createDataFrame([(day, "m2", "m1", "triggered refresh - y")], schema)
    once = upsert_roles(old, new)
    assert sorted(r["champion"] for r in upsert_roles(once, new).collect()) == ["m0", "m2"] == sorted(r["champion"] for r in once.collect())


def test_preprocessing_of_unseen_values(spark):
    train = spark.createDataFrame([(float(i), "ab"[i % 2], i % 2 if i % 5 else 1 - i % 2) for i in range(40)] + [(None, None, 1)],
                                  "x double, c string, label int")
    new = spark.createDataFrame([(1e9, "never", 0), (None, "a", 0)], "x double, c string, label int")
    tree = fit_tree_prep(train, ["x"], ["c"])
    vectors = [r["features"].toArray().tolist() for r in tree.transform(new).collect()]
    assert vectors[0][1:] == [0.0] * (len(vectors[0]) - 1) and vectors[0][0] <= 39
    linear = fit_linear_prep(train, ["x"], ["c"])
    assert linear.indicators == ["x"]
    assert {r["x_c_woe"] for r in linear.unscaled(new.limit(1)).collect()} == {0.0}


def test_wrong_signs_are_dropped(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=600), rng.normal(size=600)
    y = (rng.random(600) < 1 / (1 + np.exp(-(a - b)))).astype(int)
    train = spark.createDataFrame([(float(i), float(j), int(k)) for i, j, k in zip(a, b, y)], "a double, b double, label int")
    card = train_logreg(train, ["a", "b"], [], {"a": 0.5, "b": 0.1}, 1.0, 0.0, directions={"a": 1, "b": 1})
    assert card.dropped == ["b"] and card.prep.inputs == ["a"]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named.rstrip("/")


def test_from_raw_text_to_a_scored_month(spark):
    """Raw text to silver, labels, features, cleaning, training, saving and scoring."""
    from panelkit.plans.cleaning import clean_rows
    from panelkit.plans.gold import label_store
    from panelkit.plans.modelling import evaluate, load_card, save_card, score_rows
    from panelkit.plans.silver import silver_all
    from workload.q_features import raw_clicks
    from workload.views import as_text, view

    silver = silver_all({"attributes": view(spark, SF, "attributes_raw"), "financials": view(spark, SF, "financials_raw"),
                         "loans": as_text(view(spark, SF, "ledger")), "clicks": raw_clicks(spark, SF)})
    labels_ = label_store(silver["loans"])
    windows = split_windows(TRAIN_DATE, DATA_START)
    made, params = feature_store(labels_, silver["attributes"], silver["financials"], windows, silver["clicks"], TRAIN_DATE, point_in_time=False)
    assert made.count() == labels_.filter("snapshot_date BETWEEN DATE '1995-01-01' AND DATE '2001-05-31'").count()
    assert "fe_10_mean_90d" in made.columns and params.scalars["overall_age_median"] is not None
    rows = clean_rows(made.join(labels_.select("loan_id", F.col("snapshot_date").alias("labels_snapshot_date"), "label")
                                .dropDuplicates(["loan_id", "labels_snapshot_date"]), ["loan_id", "labels_snapshot_date"]))
    assert {"Credit_Mix", "Payment_of_Min_Amount", "Num_Fin_Pdts"} <= set(rows.columns) and "Age_Bin" not in rows.columns
    train = rows.filter("data_split = 'train'")
    card = train_logreg(train, ["Age_imputed", "Num_Fin_Pdts"], ["Credit_Mix"], {}, 1.0, 0.0, directions={})
    path = fresh_path(spark, "card")
    save_card(card, spark, path)
    again = load_card(spark, path)
    a, b = (score_rows(c, rows, "labels_snapshot_date", "champion").select("loan_id", "model_predictions") for c in (card, again))
    assert a.count() == rows.count() and a.exceptAll(b).isEmpty()
    assert evaluate(card, rows).count() >= 1


def test_tree_search_and_monotonicity(spark):
    import numpy as np
    from panelkit.operators.boosting import TreeSetting
    from panelkit.plans.modelling import load_card, save_card, train_trees
    rng = np.random.default_rng(4)
    n = 1200
    x, z = rng.random(n), rng.random(n)
    y = (rng.random(n) < np.where(x < 0.5, 0.2, 0.7)).astype(int)
    day = [dt.date(2023, 1 + i % 8, 1) for i in range(n)]
    df = spark.createDataFrame([(str(i), float(x[i]), float(z[i]), "ab"[i % 2], int(y[i]), day[i]) for i in range(n)],
                               "loan_id string, x double, z double, c string, label int, d date")
    card = train_trees(df, df.filter("loan_id < '3'"), ["x", "z"], ["c"], "d", expanding_folds(df, "d", n_splits=2), rounds=5,
                       settings=[TreeSetting(max_depth=1, rounds=2), TreeSetting(max_depth=3, rounds=5)])
    right = {r["model_input"]: r for r in monotonicity(card, df, df, {"x": 1}, n_rows=50, n_grid=8).collect()}
    wrong = {r["model_input"]: r for r in monotonicity(card, df, df, {"x": -1}, n_rows=50, n_grid=8).collect()}
    assert right["x"]["logodds_effect_min_to_max"] > 0 and wrong["x"]["rows_violating"] > right["x"]["rows_violating"]
    path = fresh_path(spark, "card")
    save_card(card, spark, path)
    again = load_card(spark, path)
    assert again.transform(df).select("model_predictions").exceptAll(card.transform(df).select("model_predictions")).isEmpty()


def test_baseline_round_trip_and_drift(spark):
    from panelkit.plans.monitoring import build_baseline, load_baseline, monitoring_summary
    rows = spark.range(4000).selectExpr(
        "CAST(id AS STRING) AS loan_id", "'m' AS model_version", "CASE WHEN id < 2000 THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS snapshot_date",
        "'champion' AS model_role", "IF(id < 2000, 'train', 'production') AS data_split", "(id % 100) / 100 AS model_predictions",
        "CAST((id % 100) >= 50 AS INT) AS predicted_default", "CAST((id * 7) % 100 < id % 100 AS INT) AS label",
        "IF(id < 2000, CAST(id % 50 AS DOUBLE), CAST(id % 50 + 30 AS DOUBLE)) AS f", "IF(id % 10 = 0, NULL, 'k') AS g")
    base = build_baseline(rows.filter("data_split = 'train'"), ["f"], ["g"], 0.9)
    path = fresh_path(spark, "baseline")
    base.save(spark, path, "m")
    again = load_baseline(spark, path, "m")
    assert again.edges == base.edges and again.levels == base.levels and again.reference_auc == 0.9
    summary, drift = monitoring_summary(rows, {"m": again})
    months = {r["snapshot_date"].month: r for r in summary.collect()}
    assert months[1]["score_psi"] == pytest.approx(0.0) and months[1]["max_feature_psi"] == pytest.approx(0.0)
    assert months[2]["stability_status"] == "alert" and months[2]["max_feature_psi_name"] == "f" and months[2]["n_features_psi_alert"] == 1
    assert months[1]["label_period"] == "train" and months[2]["n_scored"] == 2000
    few = monitoring_summary(rows.withColumn("label", F.expr("IF(CAST(loan_id AS INT) < 99, label, NULL)")), {"m": again})[0]
    assert {(r["snapshot_date"].month, r["auc"], r["performance_status"]) for r in few.collect()} == {
        (1, None, "no labels yet"), (2, None, "no labels yet")}
    assert {r["missing_rate"] for r in drift.filter("feature = 'g'").collect()} == {0.1}
    # a second model that learned from the later month, without the category, and a third without a baseline
    later = build_baseline(rows.filter("data_split = 'production'"), ["f"], [], 0.7)
    three = rows.withColumn("model_version", F.explode(F.array(*map(F.lit, "mno"))))
    summary, drift = monitoring_summary(three, {"m": again, "n": later}, as_of="2024-03-01")
    found = {(r["model_version"], r["snapshot_date"].month): r for r in summary.collect()}
    assert [found[m, t]["max_feature_psi"] < 1e-9 for m, t in (("m", 1), ("m", 2), ("n", 1), ("n", 2))] == [True, False, False, True]
    assert (found["m", 1]["reference_auc"], found["n", 1]["reference_auc"], found["o", 1]["reference_auc"]) == (0.9, 0.7, None)
    assert found["o", 1]["score_psi"] is None and found["o", 1]["n_scored"] == 2000 and found["o", 1]["as_of_date"] == dt.date(2024, 3, 1)
    assert {(r["model_version"], r["feature"]) for r in drift.collect()} == {("m", "f"), ("m", "g"), ("n", "f")}


def monitored_panel(spark, n=3000):
    return spark.range(n).selectExpr(
        "CAST(id AS STRING) AS loan_id", "IF(id % 2 = 0, 'a', 'b') AS model_version", "add_months(DATE '2024-01-01', CAST(id % 5 AS INT)) AS snapshot_date",
        "'champion' AS model_role", "IF(id % 5 < 2, 'train', 'production') AS data_split", "((id * 37) % 101) / 101e0 AS model_predictions",
        "CAST((id * 37) % 101 >= 50 AS INT) AS predicted_default", "CAST((id * 7) % 100 < id % 100 AS INT) AS label",
        "IF(id % 11 = 0, NULL, CAST((id * (1 + id % 2)) % 50 AS DOUBLE)) AS f", "IF(id % 10 = 0, NULL, IF(id % 3 = 0, 'k', 'm')) AS g", "IF(id % 2 = 0, 1e0, NULL) AS one")


def alike(found, expected):
    """Summaries and drift tables that hold the same, but for rounding."""
    for a, b in zip(found, expected):
        keys = ["model_version", "snapshot_date"] + (["feature"] if "feature" in a.columns else [])
        left, right = a.orderBy(*keys).collect(), b.orderBy(*keys).collect()
        assert len(left) == len(right) > 9
        for one, other in zip(left, right):
            for c in a.columns:
                assert one[c] == other[c] or one[c] == pytest.approx(other[c]), (c, one, other)


def test_baselines_of_all_models_equal_single_ones(spark):
    from panelkit.plans.monitoring import build_baseline, build_baselines, load_baselines, monitoring_summary
    rows = monitored_panel(spark)
    train = rows.filter("data_split = 'train'")
    reference = spark.createDataFrame([("a", 0.8), ("b", 0.7)], "model_version string, reference_auc double")
    all_ = build_baselines(train, ["f", "one"], ["g"], reference)
    single = {m: build_baseline(train.filter(F.col("model_version") == m), ["f", "one"], ["g"], auc) for m, auc in (("a", 0.8), ("b", 0.7))}
    path = fresh_path(spark, "baselines")
    all_.save(path)
    again = load_baselines(spark, path, ["f", "one"], ["g"])
    expected = monitoring_summary(rows, single)
    for bases in (all_, again):
        alike(monitoring_summary(rows, bases), expected)
    only = load_baselines(spark, path, ["f", "one"], ["g"], ["b"])
    assert {r["model_version"] for r in only.cuts.collect()} == {"b"}


def test_stored_state_reads_the_new_month_only(spark):
    from panelkit.plans.monitoring import build_baselines, load_state, month_state, monitoring_summary, months_touched, summarise, update_state
    from panelkit.sources.sinks import write_partitions
    rows = monitored_panel(spark)
    reference = spark.createDataFrame([("a", 0.8), ("b", 0.7)], "model_version string, reference_auc double")
    bases = build_baselines(rows.filter("data_split = 'train'"), ["f", "one"], ["g"], reference)
    path, table = fresh_path(spark, "state"), fresh_path(spark, "predictions")
    write_partitions(rows.select("loan_id", "model_version", "snapshot_date", "model_role", "data_split", "model_predictions", "predicted_default"), table, ["snapshot_date"])
    made = spark.read.parquet(table)
    labels = rows.selectExpr("loan_id", "label", "add_months(snapshot_date, 2) AS label_date")
    features = rows.select("loan_id", "f", "one", "g")
    update_state(path, made, labels, features, bases, ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"], "2024-04-01")
    before = {r["snapshot_date"]: r["n_y"] for r in load_state(spark, path).cells.groupBy("snapshot_date").agg(F.sum("n_y").alias("n_y")).collect()}
    assert before[dt.date(2024, 2, 1)] > 0 and before[dt.date(2024, 3, 1)] == 0
    touched = months_touched(made, labels, "2024-04-01", "2024-05-01")
    assert touched == ["2024-03-01", "2024-05-01"]  # labels of March came, May is new
    wanted = made.filter(F.col("snapshot_date").isin([F.lit(m).cast("date") for m in touched]))
    assert wanted.select(F.input_file_name()).distinct().count() == 2 and "PartitionFilters: [snapshot_date" in wanted._jdf.queryExecution().toString()
    update_state(path, made, labels, features, bases, touched, "2024-05-01")
    stored = summarise(load_state(spark, path), bases, as_of="2024-05-01")
    known = labels.filter("label_date <= DATE '2024-05-01'").drop("label_date")
    whole = monitoring_summary(made.join(known, "loan_id", "left").join(features, "loan_id", "left"), bases, as_of="2024-05-01")
    alike(stored, whole)
    update_state(path, made, labels, features, bases, touched, "2024-05-01")  # again: nothing changes
    assert load_state(spark, path).cells.count() == month_state(made.join(known, "loan_id", "left").join(features, "loan_id", "left"), bases).cells.count()
