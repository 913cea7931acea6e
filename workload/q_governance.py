"""Monitoring, drift, roles, refresh decisions and promotion."""

from pyspark.sql import functions as F

from panelkit.operators.asof import role_intervals
from panelkit.operators.metrics import discrimination
from panelkit.plans.governance import (champion_on_window, current_roles, manual_promotion, promotion, promotion_roles, rank_candidates,
                                       refresh_decisions, roles_asof, upsert_roles, upsert_runs, verified_models)
from panelkit.plans.monitoring import (build_baselines, drift_heatmap, governance_timeline, known_labels, load_baselines, load_state,
                                       monitor_as_of, monitor_targets, monitored_rows, monitoring_summary, months_touched, production_and_shadow,
                                       summarise, update_state)
from panelkit.session import fresh_path, materialize
from workload.q_statistics import _bin_sql, _edge_sql
from workload.registry import query
from workload.views import ALL_MONTHS, months, roles, runs, view

NUMERIC, LEVELS = ["x2", "x3"], ["level"]
AS_OF = "2001-06-30"


def predictions(spark, d):
    """Predictions of two models on every loan."""
    models = F.explode(F.array(F.struct(F.lit("credit_model_a").alias("model_version"), F.lit(1.0).alias("w")),
                               F.struct(F.lit("credit_model_b").alias("model_version"), F.lit(0.5).alias("w"))))
    return (view(spark, d, "panel").select("loan_id", "month", "score", models.alias("m"))
            .select("loan_id", F.col("month").alias("snapshot_date"), F.col("m.model_version"), (F.col("score") * F.col("m.w")).alias("model_predictions"))
            .withColumns({"predicted_default": (F.col("model_predictions") >= 0.4).cast("int"),
                          "model_role": F.when(F.col("model_version") == "credit_model_a", "champion").otherwise("challenger"),
                          "data_split": F.when(F.col("snapshot_date") < F.expr("IF(model_version = 'credit_model_a', DATE '1999-01-01', DATE '1997-01-01')"),
                                               "train").otherwise("production")}))


def scored(spark, d):
    """Predictions with the labels known up to a date and the features; model b learned from fewer years than model a."""
    panel = view(spark, d, "panel")
    labels = known_labels(panel.select("loan_id", "label", "label_date"), AS_OF).drop("label_date")
    return monitored_rows(predictions(spark, d), labels, panel.select("loan_id", *NUMERIC, *LEVELS))


def monitored(spark, d):
    """Monitored rows, written once, and the baselines of both models from their training rows, with their AUC of the year 1999 as reference."""
    rows = materialize(scored(spark, d), "scored")
    later = rows.filter("snapshot_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-01'")
    reference = discrimination(later, "model_predictions", "label", ["model_version"]).select("model_version", F.col("auc").alias("reference_auc"))
    return rows, build_baselines(rows.filter("data_split = 'train'"), NUMERIC, LEVELS, reference)


SCORED = """WITH @panel, mv(model_version, w, model_role, train_end) AS (VALUES ('credit_model_a', 1e0, 'champion', DATE '1999-01-01'), ('credit_model_b', 0.5e0, 'challenger', DATE '1997-01-01')),
 s AS (SELECT loan_id, month AS snapshot_date, model_version, model_role, score * w AS p, CASE WHEN score * w >= 0.4 THEN 1 ELSE 0 END AS predicted_default,
 CASE WHEN label_date <= DATE '2001-06-30' THEN label END AS label, x2, x3, level, CASE WHEN month < train_end THEN 'train' ELSE 'production' END AS data_split FROM panel, mv),
 t AS (SELECT * FROM s WHERE data_split = 'train')"""


def _edges_by_model(column):
    """Edges of a column, a row per model."""
    return _edge_sql(column, "t", "GROUP BY model_version").replace("SELECT ", "SELECT model_version, ", 1)


DRIFT = f"""{SCORED}, ep AS ({_edges_by_model('p')}), e2 AS ({_edges_by_model('x2')}), e3 AS ({_edges_by_model('x3')}),
 b AS (SELECT model_version, snapshot_date, data_split, 'model_predictions' AS feature, {_bin_sql('p')} AS bin, false AS gone FROM s JOIN ep USING (model_version)
 UNION ALL SELECT model_version, snapshot_date, data_split, 'x2', {_bin_sql('x2')}, x2 IS NULL FROM s JOIN e2 USING (model_version)
 UNION ALL SELECT model_version, snapshot_date, data_split, 'x3', {_bin_sql('x3')}, x3 IS NULL FROM s JOIN e3 USING (model_version)
 UNION ALL SELECT model_version, snapshot_date, data_split, 'level', coalesce(level, '__MISSING__'), level IS NULL FROM s),
 tb AS (SELECT * FROM b WHERE data_split = 'train'),
 ex AS (SELECT model_version, feature, bin, count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY model_version, feature) AS e FROM tb GROUP BY model_version, feature, bin),
 base_missing AS (SELECT model_version, feature, avg(CASE WHEN gone THEN 1e0 ELSE 0 END) AS baseline_missing_rate FROM tb GROUP BY ALL),
 act AS (SELECT model_version, snapshot_date, feature, bin, count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY model_version, snapshot_date, feature) AS a FROM b GROUP BY model_version, snapshot_date, feature, bin),
 grid AS (SELECT DISTINCT model_version, snapshot_date, feature FROM act),
 fb AS (SELECT model_version, snapshot_date, feature, bin FROM grid JOIN ex USING (model_version, feature) UNION SELECT model_version, snapshot_date, feature, bin FROM act),
 ps AS (SELECT model_version, snapshot_date, feature, sum((coalesce(a, 0) - coalesce(e, 0)) * ln((coalesce(a, 0) + 1e-4) / (coalesce(e, 0) + 1e-4))) AS psi FROM fb
 LEFT JOIN act USING (model_version, snapshot_date, feature, bin) LEFT JOIN ex USING (model_version, feature, bin) GROUP BY ALL),
 mi AS (SELECT model_version, snapshot_date, feature, avg(CASE WHEN gone THEN 1e0 ELSE 0 END) AS missing_rate FROM b GROUP BY ALL),
 dr AS (SELECT model_version, snapshot_date, feature, psi, missing_rate, baseline_missing_rate, CASE WHEN psi > 0.25 THEN 'alert' WHEN psi > 0.1 THEN 'watch' ELSE 'ok' END AS status
 FROM ps JOIN mi USING (model_version, snapshot_date, feature) JOIN base_missing USING (model_version, feature) WHERE feature <> 'model_predictions')"""


@query("mon1_baseline", f"{DRIFT} SELECT model_version, feature, bin, round(e, 9) AS share FROM ex")
def mon1(spark, d):
    return monitored(spark, d)[1].shares.select("model_version", "feature", "bin", F.round("share", 9).alias("share"))


SUMMARY = f"""{DRIFT}, worst AS (SELECT model_version, snapshot_date, max(psi) AS max_feature_psi, max(struct_pack(psi := psi, feature := feature)).feature AS max_feature_psi_name,
 count(*) FILTER (status = 'alert') AS n_features_psi_alert FROM dr GROUP BY ALL),
 size AS (SELECT model_version, snapshot_date, any_value(model_role) AS model_role, count(*) AS n_scored, count(label) AS n_labelled, avg(p) AS mean_predicted_pd, avg(predicted_default) AS predicted_default_rate,
 avg(label) AS observed_default_rate, avg((p - label) * (p - label)) AS brier, sum(label) * 1e0 AS nb, sum(1 - label) * 1e0 AS ng, max(data_split) AS one_split FROM s GROUP BY ALL),
 periods AS (SELECT snapshot_date, model_version, data_split AS label_period FROM (SELECT *, row_number() OVER (PARTITION BY model_version, snapshot_date ORDER BY n DESC, data_split) AS rn
 FROM (SELECT model_version, snapshot_date, data_split, count(*) AS n FROM s GROUP BY ALL)) WHERE rn = 1),
 rk AS (SELECT model_version, snapshot_date, label, rank() OVER w + (count(*) OVER (PARTITION BY model_version, snapshot_date, p) - 1) / 2e0 AS r FROM s WHERE label IS NOT NULL WINDOW w AS (PARTITION BY model_version, snapshot_date ORDER BY p)),
 au AS (SELECT model_version, snapshot_date, sum(CASE WHEN label = 1 THEN r END) AS sr FROM rk GROUP BY ALL),
 ref AS (SELECT model_version, (sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2e0) / (sum(label) * 1e0 * sum(1 - label)) AS reference_auc FROM
 (SELECT model_version, label, rank() OVER (PARTITION BY model_version ORDER BY p) + (count(*) OVER (PARTITION BY model_version, p) - 1) / 2e0 AS r FROM s
 WHERE label IS NOT NULL AND snapshot_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-01') GROUP BY model_version),
 cv AS (SELECT model_version, snapshot_date, p, sum(label) AS b, sum(1 - label) AS g FROM s WHERE label IS NOT NULL GROUP BY ALL),
 cu AS (SELECT model_version, snapshot_date, sum(b) OVER w AS tp, sum(g) OVER w AS fp, sum(b) OVER (PARTITION BY model_version, snapshot_date) * 1e0 AS nb, sum(g) OVER (PARTITION BY model_version, snapshot_date) * 1e0 AS ng FROM cv WINDOW w AS (PARTITION BY model_version, snapshot_date ORDER BY p DESC)),
 ks AS (SELECT model_version, snapshot_date, greatest(max(tp / nb - fp / ng), 0) AS ks FROM cu WHERE nb > 0 AND ng > 0 GROUP BY ALL),
 j AS (SELECT z.*, label_period, max_feature_psi, max_feature_psi_name, n_features_psi_alert, psi AS score_psi, reference_auc, n_labelled >= 100 AND nb > 0 AND ng > 0 AS enough,
 (sr - nb * (nb + 1) / 2) / nullif(nb * ng, 0) AS auc0, ks AS ks0 FROM size z JOIN worst USING (model_version, snapshot_date) JOIN (SELECT * FROM ps WHERE feature = 'model_predictions') USING (model_version, snapshot_date)
 LEFT JOIN au USING (model_version, snapshot_date) LEFT JOIN ks USING (model_version, snapshot_date) JOIN periods USING (model_version, snapshot_date) JOIN ref USING (model_version)),
 k AS (SELECT *, CASE WHEN enough THEN auc0 END AS auc, CASE WHEN NOT enough THEN 'no labels yet' WHEN reference_auc - auc0 > 0.05 THEN 'alert' WHEN reference_auc - auc0 > 0.03 THEN 'watch' ELSE 'ok' END AS performance_status,
 CASE WHEN greatest(score_psi, max_feature_psi) > 0.25 THEN 'alert' WHEN greatest(score_psi, max_feature_psi) > 0.1 THEN 'watch' ELSE 'ok' END AS stability_status FROM j),
 ord(state, place) AS (VALUES ('ok', 1), ('n/a', 2), ('no labels yet', 3), ('watch', 4), ('alert', 5))
 SELECT model_version, snapshot_date, DATE '2001-06-30' AS as_of_date, model_role, n_scored, n_labelled, label_period, round(mean_predicted_pd, 8) AS mean_predicted_pd, round(predicted_default_rate, 8) AS predicted_default_rate,
 round(observed_default_rate, 8) AS observed_default_rate, round(auc, 8) AS auc, round(2 * auc - 1, 8) AS gini, CASE WHEN enough THEN round(ks0, 8) END AS ks, CASE WHEN enough THEN round(brier, 8) END AS brier,
 round(reference_auc, 8) AS reference_auc, round(reference_auc - auc, 8) AS auc_drop_vs_reference, round(score_psi, 7) AS score_psi, round(max_feature_psi, 7) AS max_feature_psi, max_feature_psi_name, n_features_psi_alert,
 performance_status, stability_status, CASE WHEN a.place >= b.place THEN performance_status ELSE stability_status END AS overall_status FROM k JOIN ord a ON a.state = performance_status JOIN ord b ON b.state = stability_status"""


def rounded(summary):
    digits = dict.fromkeys(["mean_predicted_pd", "predicted_default_rate", "observed_default_rate", "auc", "gini", "ks", "brier", "reference_auc",
                            "auc_drop_vs_reference"], 8) | {"score_psi": 7, "max_feature_psi": 7}
    return summary.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("mon2_monthly_summary", SUMMARY)
def mon2(spark, d):
    return rounded(monitoring_summary(*monitored(spark, d), as_of=AS_OF)[0])


@query("mon2_from_stored_state", SUMMARY)
def mon2_state(spark, d):
    """The same from a state that was stored a year before the date and brought up to it: only months that are new or have new labels
    are read again."""
    path, bases, before = fresh_path(spark, "state"), monitored(spark, d)[1], "2000-06-30"
    panel, made = view(spark, d, "panel"), materialize(predictions(spark, d), "predictions")
    labels, features = panel.select("loan_id", "label", "label_date"), panel.select("loan_id", *NUMERIC, *LEVELS)
    old = [str(r[0]) for r in made.filter(F.col("snapshot_date") <= before).select("snapshot_date").distinct().collect()]
    update_state(path, made, labels, features, bases, old, before)
    upto = "2001-08-01"  # months are scored before their labels come
    known = labels.filter(F.col("label_date") <= AS_OF)
    update_state(path, made, known, features, bases, months_touched(made, known, before, upto), upto)
    return rounded(summarise(load_state(spark, path), bases, as_of=AS_OF)[0])


@query("mon1_baseline_reloaded", f"""{DRIFT} SELECT model_version, feature, count(*) AS n_bins, round(sum(e), 9) AS total, any_value(round(baseline_missing_rate, 9)) AS missing, any_value(round(reference_auc, 8)) AS reference_auc
 FROM ex LEFT JOIN base_missing USING (model_version, feature) JOIN (SELECT model_version, (sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2e0) / (sum(label) * 1e0 * sum(1 - label)) AS reference_auc FROM
 (SELECT model_version, label, rank() OVER (PARTITION BY model_version ORDER BY p) + (count(*) OVER (PARTITION BY model_version, p) - 1) / 2e0 AS r FROM s
 WHERE label IS NOT NULL AND snapshot_date BETWEEN DATE '1999-01-01' AND DATE '1999-12-01') GROUP BY model_version) USING (model_version) WHERE feature <> 'model_predictions' GROUP BY model_version, feature""")
def mon1_reloaded(spark, d):
    path = fresh_path(spark, "baseline")
    monitored(spark, d)[1].save(path)
    base = load_baselines(spark, path, NUMERIC, LEVELS)
    totals = base.shares.filter("feature <> 'model_predictions'").groupBy("model_version", "feature").agg(
        F.count(F.lit(1)).alias("n_bins"), F.round(F.sum("share"), 9).alias("total"))
    return totals.join(base.missing, ["model_version", "feature"]).join(base.cuts, "model_version").select(
        "model_version", "feature", "n_bins", "total", F.round("baseline_missing_rate", 9).alias("missing"), F.round("reference_auc", 8).alias("reference_auc"))


@query("mon3_feature_drift", f"{DRIFT} SELECT model_version, snapshot_date, feature, round(psi, 7) AS psi, round(missing_rate, 9) AS missing_rate, round(baseline_missing_rate, 9) AS baseline_missing_rate, status FROM dr")
def mon3(spark, d):
    _, drift = monitoring_summary(*monitored(spark, d))
    return drift.withColumns({"psi": F.round("psi", 7), "missing_rate": F.round("missing_rate", 9), "baseline_missing_rate": F.round("baseline_missing_rate", 9)})


@query("mon4_targets_as_of", """WITH @roles, known AS (SELECT * FROM roles WHERE effective_from <= DATE '1999-08-01'), now AS (SELECT champion FROM known ORDER BY effective_from DESC LIMIT 1)
 SELECT DISTINCT model_version, 'champion' AS role FROM runs WHERE model_version IN (SELECT champion FROM now)
 UNION ALL SELECT DISTINCT model_version, 'challenger' FROM runs WHERE as_of <= DATE '1999-08-01' AND model_version NOT IN (SELECT champion FROM now)""")
def mon4(spark, d):
    models, day = runs(spark, d), "1999-08-01"
    now = current_roles(roles(spark, d).filter(F.col("effective_from") <= day))
    predicted = models.filter(F.col("as_of") <= day)
    parts = [monitor_targets(models, now, predicted, r).withColumn("role", F.lit(r)) for r in ("champion", "challenger")]
    return parts[0].unionByName(parts[1])


@query("mon4_monitored_as_of", f"""{DRIFT.replace("label_date <= DATE '2001-06-30'", "label_date <= DATE '2000-03-31'")}
 SELECT DATE '2000-03-31' AS as_of_date, model_version, snapshot_date, count(*) AS n_scored, count(label) AS n_labelled, round(any_value(psi), 7) AS score_psi
 FROM s JOIN (SELECT * FROM ps WHERE feature = 'model_predictions') USING (model_version, snapshot_date)
 WHERE snapshot_date <= DATE '2000-03-31' AND model_role = 'challenger' GROUP BY model_version, snapshot_date""")
def mon4_as_of(spark, d):
    panel, made, day = view(spark, d, "panel"), predictions(spark, d), "2000-03-31"
    now = spark.createDataFrame([("credit_model_a",)], "champion string")
    targets = monitor_targets(made, now, made, "challenger")
    summary, _ = monitor_as_of(made, panel.select("loan_id", "label", "label_date"), panel.select("loan_id", *NUMERIC, *LEVELS), monitored(spark, d)[1], targets, day)
    return summary.select("as_of_date", "model_version", "snapshot_date", "n_scored", "n_labelled", F.round("score_psi", 7).alias("score_psi"))


DRIFT_BY_MONTH = ", ".join(f"round(avg(psi) FILTER (strftime(snapshot_date, '%Y-%m') = '{m}'), 7) AS \"{m}\"" for m in ALL_MONTHS)


@query("mon5_drift_by_month", f"{DRIFT} SELECT feature, {DRIFT_BY_MONTH} FROM dr WHERE model_version = 'credit_model_a' GROUP BY 1")
def mon5(spark, d):
    rows, bases = monitored(spark, d)
    _, drift = monitoring_summary(rows, bases)
    in_force = rows.filter("model_role = 'champion'").select("snapshot_date", "model_version")
    made = drift_heatmap(drift, in_force, ALL_MONTHS)
    return made.select("feature", *[F.round(m, 7).alias(m) for m in ALL_MONTHS])


@query("mon5_production_and_shadow", f"""{DRIFT}, pm AS (SELECT snapshot_date, max(psi) FILTER (feature = 'model_predictions') AS score_psi, max(psi) FILTER (feature <> 'model_predictions') AS max_feature_psi
 FROM ps WHERE model_version = 'credit_model_a' GROUP BY 1), rk AS (SELECT model_version, model_role, snapshot_date, label, rank() OVER w + (count(*) OVER (PARTITION BY model_version, snapshot_date, p) - 1) / 2e0 AS r FROM s
 WHERE label IS NOT NULL WINDOW w AS (PARTITION BY model_version, snapshot_date ORDER BY p)),
 au AS (SELECT model_role, snapshot_date, count(*) AS n, sum(label) AS nb, (sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2e0) / nullif(sum(label) * 1e0 * sum(1 - label), 0) AS auc FROM rk GROUP BY ALL),
 z AS (SELECT snapshot_date, model_role, model_version, count(*) AS n_scored, avg(p) AS pd, avg(label) AS rate FROM s GROUP BY ALL),
 j AS (SELECT z.*, CASE WHEN n >= 100 AND nb > 0 AND nb < n THEN 2 * auc - 1 END AS gini FROM z LEFT JOIN au USING (model_role, snapshot_date))
 SELECT snapshot_date, max(CASE WHEN model_role = 'champion' THEN model_version END) AS champion, round(max(CASE WHEN model_role = 'champion' THEN gini END), 8) AS champion_gini,
 max(CASE WHEN model_role = 'challenger' THEN model_version END) AS challenger, round(max(CASE WHEN model_role = 'challenger' THEN gini END), 8) AS challenger_gini,
 round(max(CASE WHEN model_role = 'champion' THEN pd END), 8) AS mean_predicted_pd, round(max(CASE WHEN model_role = 'champion' THEN rate END), 8) AS observed_default_rate,
 CAST(sum(CASE WHEN model_role = 'champion' THEN n_scored END) AS BIGINT) AS n_scored,
 round(any_value(score_psi), 7) AS score_psi, round(any_value(max_feature_psi), 7) AS max_feature_psi FROM j JOIN pm USING (snapshot_date) GROUP BY 1""")
def mon5_shadow(spark, d):
    summary, _ = monitoring_summary(*monitored(spark, d))
    digits = dict.fromkeys(["champion_gini", "challenger_gini", "mean_predicted_pd", "observed_default_rate"], 8) | {"score_psi": 7, "max_feature_psi": 7}
    return production_and_shadow(summary).withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("mon5_governance_timeline", """WITH @runs, e AS (SELECT CAST(as_of AS VARCHAR) AS as_of_date, CASE WHEN n_rows % 2 = 0 THEN 'decision' ELSE 'training' END AS event, model_version AS logged_at, n_rows FROM runs)
 SELECT as_of_date, event, max(logged_at) AS logged_at, max_by(n_rows, logged_at) AS n_rows FROM e WHERE CAST(as_of_date AS DATE) <= DATE '2000-07-01' GROUP BY ALL""")
def mon5_timeline(spark, d):
    log = runs(spark, d).selectExpr("CAST(as_of AS STRING) AS as_of_date", "CASE WHEN n_rows % 2 = 0 THEN 'decision' ELSE 'training' END AS event",
                                    "model_version AS logged_at", "n_rows")
    return governance_timeline(log, "2000-07-01")


@query("mon5_role_timeline", """WITH @roles SELECT champion, effective_from, coalesce(lead(effective_from) OVER (ORDER BY effective_from), DATE '2001-08-01') AS effective_to,
 CAST(date_diff('day', effective_from, coalesce(lead(effective_from) OVER (ORDER BY effective_from), DATE '2001-08-01')) AS INTEGER) AS days,
 coalesce(lag(champion) OVER (ORDER BY effective_from) <> champion, true) AS champion_changed FROM roles""")
def mon5_roles(spark, d):
    end = F.coalesce("effective_to", F.lit("2001-08-01").cast("date"))
    return role_intervals(roles(spark, d)).select("champion", "effective_from", end.alias("effective_to"),
                                                  F.datediff(end, "effective_from").alias("days"), "champion_changed")


def gov_monitoring(spark, d):
    """Monitoring rows of each champion, one per quarter, with statuses taken from the panel."""
    champions = roles_asof(months(spark, d), roles(spark, d)).select("month", F.col("champion").alias("model_version"))
    rates = view(spark, d, "panel").groupBy("month").agg(F.avg("label").alias("rate"), F.avg("x2").alias("level"))
    joined = champions.join(rates, "month").filter("model_version IS NOT NULL")
    return joined.select("model_version", F.col("month").alias("snapshot_date"),
                         F.when(F.col("level") > 54, "alert").otherwise("ok").alias("stability_status"),
                         F.when(F.col("rate") > 0.37, "alert").when(F.col("rate") > 0.31, "ok").otherwise("no labels yet").alias("performance_status"),
                         (F.col("level") / 200).alias("score_psi"), (F.col("level") / 100).alias("max_feature_psi"), (1 - F.col("rate")).alias("auc"),
                         F.lit(0.75).alias("reference_auc"))


GOV_STATE = """WITH @roles, @months, known_roles AS (SELECT * FROM roles WHERE effective_from <> DATE '1997-07-01' AND effective_from >= DATE '1996-07-01'),
 known_runs AS (SELECT * FROM runs WHERE as_of >= DATE '1996-01-01' AND year(as_of) <> 1999),
 r AS (SELECT month, champion FROM months ASOF LEFT JOIN known_roles ON month >= effective_from),
 rates AS (SELECT month, avg(label) AS rate, avg(x2) AS level FROM panel GROUP BY 1),
 mon AS (SELECT r.champion, r.month, level, rate, CASE WHEN level > 54 THEN 'alert' ELSE 'ok' END AS stab, CASE WHEN rate > 0.37 THEN 'alert' WHEN rate > 0.31 THEN 'ok' ELSE 'no labels yet' END AS perf
 FROM (SELECT month, champion FROM months ASOF LEFT JOIN roles ON month >= effective_from) r JOIN rates USING (month) WHERE champion IS NOT NULL),
 st AS (SELECT m.month, r.champion, (SELECT max(as_of) FROM known_runs k WHERE k.as_of <= m.month) AS lt, (SELECT count(*) FROM months p WHERE p.month < m.month) AS labelled_months,
 (SELECT min(as_of) FROM runs WHERE model_version = r.champion) AS td,
 (SELECT max_by(stab, month) FROM mon WHERE mon.champion = r.champion AND mon.month < m.month) AS stab,
 (SELECT max(month) FROM mon WHERE mon.champion = r.champion AND mon.month < m.month) AS stab_month, (SELECT max_by(level, month) FROM mon WHERE mon.champion = r.champion AND mon.month < m.month) AS stab_level,
 (SELECT max(month) FROM mon WHERE mon.champion = r.champion AND mon.month < m.month AND perf <> 'no labels yet') AS perf_month,
 (SELECT max_by(rate, month) FROM mon WHERE mon.champion = r.champion AND mon.month < m.month AND perf <> 'no labels yet') AS perf_rate,
 (SELECT max_by(perf, month) FROM mon WHERE mon.champion = r.champion AND mon.month < m.month AND perf <> 'no labels yet') AS perf
 FROM months m JOIN r USING (month)),
 ag AS (SELECT *, CAST((year(month) - year(td)) * 12 + month(month) - month(td) AS INTEGER) AS age, CAST(coalesce((year(month) - year(lt)) * 12 + month(month) - month(lt), 999) AS INTEGER) AS since,
 coalesce(stab = 'alert', false) OR coalesce(perf = 'alert', false) AS alert FROM st),
 tr AS (SELECT *, CASE WHEN champion IS NULL AND since < 2 THEN 'cooldown' WHEN champion IS NULL AND labelled_months >= 11 THEN 'initial' WHEN champion IS NULL THEN 'cold_start'
 WHEN since >= 6 AND age >= 6 THEN 'scheduled' WHEN alert AND since >= 2 THEN 'triggered' WHEN alert THEN 'cooldown' ELSE 'healthy' END AS trigger FROM ag)"""


@query("gov1_refresh_decisions", f"""{GOV_STATE} SELECT month, champion, CAST(labelled_months AS BIGINT) AS labelled_months, age AS champion_age, since AS months_since_training, alert,
 CASE WHEN trigger IN ('initial', 'scheduled', 'triggered') THEN 'train' ELSE 'skip' END AS decision, trigger,
 CASE WHEN champion IS NULL AND trigger = 'cooldown' THEN concat('last attempt ', CAST(lt AS VARCHAR), ' failed gates') WHEN trigger = 'initial' THEN concat(CAST(labelled_months AS VARCHAR), ' labelled months available')
 WHEN trigger = 'cold_start' THEN concat(CAST(labelled_months AS VARCHAR), '/11 labelled months') WHEN trigger = 'scheduled' THEN concat('champion trained ', CAST(age AS VARCHAR), ' months ago')
 WHEN trigger = 'triggered' THEN alerts WHEN trigger = 'cooldown' THEN concat(alerts, ' (trained ', CAST(since AS VARCHAR), 'm ago)') ELSE concat('champion ', champion, ' age ', CAST(age AS VARCHAR), 'm, no alerts') END AS detail
 FROM (SELECT *, concat_ws('; ', CASE WHEN stab = 'alert' THEN concat('stability alert ', strftime(stab_month, '%Y-%m'), printf(' (score PSI %.3f, max feature PSI %.3f)', stab_level / 200, stab_level / 100)) END,
 CASE WHEN perf = 'alert' THEN concat('performance alert ', strftime(perf_month, '%Y-%m'), printf(' (AUC %.3f vs ref %.3f)', 1 - perf_rate, 0.75)) END) AS alerts FROM tr)""")
def gov1(spark, d):
    all_runs, all_roles = runs(spark, d), roles(spark, d)
    models = all_runs.select("model_version", F.col("as_of").alias("model_train_date"))
    made = refresh_decisions(months(spark, d), all_roles.filter("effective_from <> DATE '1997-07-01' AND effective_from >= DATE '1996-07-01'"),
                             all_runs.filter("as_of >= DATE '1996-01-01' AND year(as_of) <> 1999"), models, view(spark, d, "panel"),
                             gov_monitoring(spark, d), label_date="label_date")
    return made.withColumn("labelled_months", F.col("labelled_months").cast("long"))


def gate(spark, d):
    """Gate of every run: the champion of half a year before scores the run's own rows; two of three models were found monotone."""
    all_runs, panel = runs(spark, d), view(spark, d, "panel")
    champions = roles(spark, d).select(F.add_months("effective_from", 6).alias("as_of"), "champion")
    window = panel.selectExpr("make_date(year(label_date), IF(month(label_date) <= 6, 1, 7), 1) AS as_of", "loan_id", "label")
    # a champion of a first half-year ranks by the score, one of a second by its rest modulo a seventh
    scores = window.join(champions, "as_of").join(panel.select("loan_id", "score"), "loan_id").selectExpr(
        "champion AS model_version", "loan_id", "IF(endswith(champion, 'a'), score, score % 0.14e0) AS model_predictions")
    checks = all_runs.select("model_version", F.lit("x2").alias("model_input"), (F.col("n_rows") % 3 == 0).cast("double").alias("rows_violating"))
    return promotion(rank_candidates(all_runs.drop("n_rows")), champion_on_window(champions, window, scores), verified_models(checks))


GATE = """WITH @roles, cw AS (SELECT h.as_of, champion, label, CASE WHEN champion LIKE '%a' THEN score ELSE score % 0.14e0 END AS p FROM half h JOIN roles r ON h.as_of = CAST(r.effective_from + to_months(6) AS DATE)),
 cr AS (SELECT *, rank() OVER (PARTITION BY as_of, champion ORDER BY p) + (count(*) OVER (PARTITION BY as_of, champion, p) - 1) / 2e0 AS r FROM cw WHERE label IS NOT NULL AND p IS NOT NULL),
 inc AS (SELECT as_of, champion, 2 * (sum(CASE WHEN label = 1 THEN r END) - sum(label) * (sum(label) + 1) / 2e0) / nullif(sum(label) * 1e0 * sum(1 - label), 0) - 1 AS champion_gini_oot FROM cr GROUP BY ALL),
 c AS (SELECT as_of, max(CASE WHEN place = 1 THEN model_version END) AS model_version, max(CASE WHEN place = 1 THEN gini_test END) AS gini_test, max(CASE WHEN place = 1 THEN gini_oot END) AS gini_oot,
 max(CASE WHEN place = 1 THEN n_rows END) % 3 <> 0 AS monotonicity_verified, max(CASE WHEN place = 2 THEN model_version END) AS runner_up FROM placed WHERE place <= 2 GROUP BY 1),
 g AS (SELECT *, gini_test >= 0.3 AS min_gini_test, gini_oot >= 0.3 AS min_gini_oot, abs(gini_test - gini_oot) <= 0.1 AS test_oot_gap,
 gini_test >= 0.3 AND gini_oot >= 0.3 AND abs(gini_test - gini_oot) <= 0.1 AND monotonicity_verified AS passed FROM c LEFT JOIN inc USING (as_of)),
 p AS (SELECT *, passed AND (champion IS NULL OR coalesce(gini_oot >= champion_gini_oot, false)) AS promoted, CASE WHEN champion IS NULL AND passed THEN 'initial deployment' WHEN champion IS NULL THEN 'initial candidate failed quality gates'
 WHEN promoted THEN 'promoted: passes gates and OOT Gini >= champion' WHEN NOT passed THEN 'kept champion: candidate failed quality gates' ELSE 'kept champion: candidate not better on the same OOT window' END AS reason FROM g)"""


@query("gov2_promotion_gate", f"""{GATE} SELECT as_of, model_version, champion, min_gini_test, min_gini_oot, test_oot_gap, monotonicity_verified, passed, promoted, round(champion_gini_oot, 8) AS champion_gini_oot,
 round(gini_oot - champion_gini_oot, 8) AS uplift, reason, CASE WHEN promoted THEN model_version ELSE champion END AS champion_after,
 CASE WHEN promoted THEN runner_up WHEN champion IS NOT NULL THEN model_version END AS challenger_after FROM p""")
def gov2(spark, d):
    return gate(spark, d).select(
        "as_of", "model_version", "champion", "min_gini_test", "min_gini_oot", "test_oot_gap", "monotonicity_verified", "passed", "promoted",
        F.round("champion_gini_oot", 8).alias("champion_gini_oot"), F.round("uplift", 8).alias("uplift"), "reason", "champion_after", "challenger_after")


@query("gov2_role_rows", f"""{GATE} SELECT as_of AS effective_from, CASE WHEN promoted THEN model_version ELSE p.champion END AS champion, CASE WHEN promoted THEN runner_up ELSE model_version END AS challenger,
 concat('scheduled refresh - ', reason) AS reason FROM p WHERE promoted OR p.champion IS NOT NULL""")
def gov2_rows(spark, d):
    return promotion_roles(gate(spark, d), "scheduled")


@query("gov3_run_upsert", """WITH @runs SELECT as_of, model_version, n_rows FROM runs WHERE as_of < DATE '2000-01-01'
 UNION ALL SELECT as_of, 'again', CAST(sum(n_rows) AS BIGINT) FROM runs WHERE as_of >= DATE '2000-01-01' GROUP BY as_of""")
def gov3_runs(spark, d):
    known = runs(spark, d).select("as_of", "model_version", "n_rows")
    again = known.filter("as_of >= DATE '2000-01-01'").groupBy("as_of").agg(F.lit("again").alias("model_version"), F.sum("n_rows").alias("n_rows"))
    return upsert_runs(upsert_runs(known, again), again)


@query("gov3_role_upsert", """WITH @roles SELECT effective_from, champion, challenger, reason FROM roles WHERE effective_from < DATE '2000-01-01'
 UNION ALL SELECT effective_from, 'credit_model_new', champion, 'triggered refresh' FROM roles WHERE effective_from >= DATE '2000-01-01'""")
def gov3(spark, d):
    history = roles(spark, d)
    again = history.filter("effective_from >= DATE '2000-01-01'").select(
        "effective_from", F.lit("credit_model_new").alias("champion"), F.col("champion").alias("challenger"), F.lit("triggered refresh").alias("reason"))
    return upsert_roles(upsert_roles(history, again), again)


@query("gov3_manual_promotion", """WITH @roles SELECT * FROM roles UNION ALL SELECT DATE '1999-03-15', 'credit_model_old', (SELECT champion FROM roles WHERE effective_from <= DATE '1999-03-15'
 ORDER BY effective_from DESC LIMIT 1), 'manual override / rollback'""")
def gov3_manual(spark, d):
    return manual_promotion(roles(spark, d), "credit_model_old", "1999-03-15")


@query("gov4_roles_by_month", """WITH @roles, @months SELECT month, champion AS model_version, 'champion' AS model_role FROM months ASOF JOIN roles ON month >= effective_from
 UNION ALL SELECT month, challenger, 'challenger' FROM months ASOF JOIN roles ON month >= effective_from WHERE challenger IS NOT NULL""")
def gov4(spark, d):
    wide = roles_asof(months(spark, d), roles(spark, d)).select("month", "champion", "challenger")
    return wide.unpivot(["month"], ["champion", "challenger"], "model_role", "model_version").filter("model_version IS NOT NULL")


@query("gov5_current_state", "WITH @roles SELECT effective_from, champion, challenger FROM roles ORDER BY effective_from DESC LIMIT 1")
def gov5(spark, d):
    return current_roles(roles(spark, d))
