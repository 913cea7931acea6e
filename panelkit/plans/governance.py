"""Roles in force, refresh decisions and the promotion gate, for all dates at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.dates import calendar_months, month_start
from panelkit.operators.asof import asof_join
from panelkit.operators.metrics import discrimination

# Refresh and promotion policy.
MIN_LABEL_MONTHS = 11
REFRESH_MONTHS = 6
COOLDOWN_MONTHS = 2
MIN_GINI = 0.30
MAX_GINI_GAP = 0.10
MIN_UPLIFT = 0.0
# Outcome texts of the gate.
FIRST, FIRST_FAILED = "initial deployment", "initial candidate failed quality gates"
PROMOTED = "promoted: passes gates and OOT Gini >= champion"
KEPT_FAILED = "kept champion: candidate failed quality gates"
KEPT_NOT_BETTER = "kept champion: candidate not better on the same OOT window"


def roles_asof(dates: DataFrame, roles: DataFrame, date: str = "month") -> DataFrame:
    """Champion and challenger in force on each date (latest row effective on or before it)."""
    return asof_join(dates, roles, [], date, "effective_from", ["effective_from", "champion", "challenger"], slices=1)


def current_roles(roles: DataFrame) -> DataFrame:
    """The latest role row."""
    order = F.col("effective_from")
    return roles.agg(F.max("effective_from").alias("effective_from"), F.max_by("champion", order).alias("champion"),
                     F.max_by("challenger", order).alias("challenger"))


def upsert_roles(roles: DataFrame, new: DataFrame) -> DataFrame:
    """Append role rows; an earlier refresh row of the same effective date is replaced (idempotent re-run)."""
    again = new.select("effective_from").distinct().withColumn("__again", F.lit(True))
    kept = (roles.join(again, "effective_from", "left")
            .filter(F.col("__again").isNull() | ~F.coalesce(F.col("reason"), F.lit("")).contains("refresh"))
            .drop("__again"))
    return kept.unionByName(new, allowMissingColumns=True)


def rank_candidates(runs: DataFrame, metric: str = "gini_test") -> DataFrame:
    """Per training date the best and second candidate on a metric; ties go to the smaller name.

    A training date has a handful of candidates.
    """
    order = Window.partitionBy("as_of").orderBy(F.col(metric).desc(), "model_version")
    ranked = runs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= 2)
    pick = [F.max(F.when(F.col("place") == 1, F.col(c))).alias(c) for c in runs.columns if c != "as_of"]
    return ranked.groupBy("as_of").agg(*pick, F.max(F.when(F.col("place") == 2, F.col("model_version"))).alias("runner_up"))


def champion_on_window(champions: DataFrame, window: DataFrame, predictions: DataFrame, key: str = "loan_id", label: str = "label",
                       score: str = "model_predictions") -> DataFrame:
    """Gini of each champion on the out-of-time rows of the run that challenges it.

    ``champions`` has as_of and champion; ``window`` as_of, key and label; ``predictions`` model_version, key and score.
    """
    rows = (window.join(champions.select("as_of", "champion"), "as_of")
            .join(predictions.select(F.col("model_version").alias("champion"), key, score), ["champion", key]))
    made = discrimination(rows, score, label, ["as_of", "champion"])
    return made.select("as_of", "champion", F.col("gini").alias("champion_gini_oot"))


def verified_models(checks: DataFrame) -> DataFrame:
    """Models whose monotonicity check (model_version, model_input, rows_violating) found no violation in any input."""
    return checks.groupBy("model_version").agg((F.max("rows_violating") <= 0).alias("verified"))


def promotion(ranked: DataFrame, incumbent: DataFrame, monotone: DataFrame) -> DataFrame:
    """Gate result and resulting roles per training date.

    ``incumbent`` has as_of, champion and its Gini on the candidate's out-of-time rows (no row before the first
    champion; see ``champion_on_window``). ``monotone`` has model_version and verified, from the monotonicity check; a model without
    a check does not pass.
    """
    checked = monotone.select("model_version", F.col("verified").alias("monotonicity_verified"))
    rows = (ranked.join(incumbent, "as_of", "left").join(checked, "model_version", "left")
            .withColumn("monotonicity_verified", F.coalesce("monotonicity_verified", F.lit(False))))
    gates = {"min_gini_test": F.col("gini_test") >= MIN_GINI, "min_gini_oot": F.col("gini_oot") >= MIN_GINI,
             "test_oot_gap": F.abs(F.col("gini_test") - F.col("gini_oot")) <= MAX_GINI_GAP}
    rows = rows.withColumns(gates)
    passed = F.col("min_gini_test") & F.col("min_gini_oot") & F.col("test_oot_gap") & F.col("monotonicity_verified")
    first = F.col("champion").isNull()
    better = F.col("gini_oot") >= F.col("champion_gini_oot") + MIN_UPLIFT
    rows = rows.withColumns({"passed": passed, "promoted": passed & (first | F.coalesce(better, F.lit(False)))})
    reason = (F.when(first, F.when(F.col("promoted"), FIRST).otherwise(FIRST_FAILED))
              .when(F.col("promoted"), PROMOTED).when(F.col("passed"), KEPT_NOT_BETTER).otherwise(KEPT_FAILED))
    return rows.withColumns({
        "uplift": F.col("gini_oot") - F.col("champion_gini_oot"), "reason": reason,
        "champion_after": F.when(F.col("promoted"), F.col("model_version")).otherwise(F.col("champion")),
        "challenger_after": F.when(F.col("promoted"), F.col("runner_up"))
                             .when(~first, F.col("model_version"))})


def promotion_roles(gated: DataFrame, trigger: str, effective_from: str | None = None) -> DataFrame:
    """Role rows a gate result adds: the new champion, or the old one with the candidate as challenger.

    Before the first champion a failed gate adds none. ``effective_from`` back-dates the roles, so that a first champion
    trained on the whole history can score it.
    """
    start = F.lit(effective_from).cast("date") if effective_from else F.col("as_of")
    return gated.filter(F.col("champion_after").isNotNull()).select(
        start.alias("effective_from"), F.col("champion_after").alias("champion"), F.col("challenger_after").alias("challenger"),
        F.concat(F.lit(f"{trigger} refresh - "), F.col("reason")).alias("reason"))


def upsert_runs(runs: DataFrame, new: DataFrame) -> DataFrame:
    """Append training records; a record of the same date is replaced."""
    return runs.join(new.select("as_of").distinct(), "as_of", "left_anti").unionByName(new, allowMissingColumns=True)


def manual_promotion(roles: DataFrame, model: str, as_of: str, reason: str = "manual override / rollback") -> DataFrame:
    """Role history with a manual promotion; the champion in force becomes the challenger."""
    day = F.lit(as_of).cast("date")
    row = (roles.agg(F.max_by("champion", F.when(F.col("effective_from") <= day, F.col("effective_from"))).alias("challenger"))
           .select(day.alias("effective_from"), F.lit(model).alias("champion"), "challenger", F.lit(reason).alias("reason")))
    return roles.unionByName(row, allowMissingColumns=True)


def latest_training(dates: DataFrame, runs: DataFrame, date: str = "month") -> DataFrame:
    """Date of the latest training run on or before each date."""
    trained = runs.select(F.col("as_of").alias("last_training")).distinct()
    return asof_join(dates, trained, [], date, "last_training", ["last_training"], slices=1)


def labelled_months(dates: DataFrame, labels: DataFrame, label_date: str, date: str = "month") -> DataFrame:
    """Distinct labelled months before each date; both sides are reduced to months before they meet."""
    months = labels.select(month_start(label_date).alias("m")).filter(F.col("m").isNotNull()).distinct()
    probes = dates.select(F.col(date).alias("m")).distinct()
    both = months.withColumn("k", F.lit(1)).unionByName(probes.withColumn("k", F.lit(0)))
    per = both.groupBy("m").agg(F.max("k").alias("labelled"))
    before = Window.partitionBy(F.lit(0)).orderBy("m").rowsBetween(Window.unboundedPreceding, -1)  # one row per month
    counted = per.select(F.col("m").alias(date), F.coalesce(F.sum("labelled").over(before), F.lit(0)).alias("labelled_months"))
    return dates.join(counted, date, "left")


STABILITY = ["stability_status", "score_psi", "max_feature_psi"]
PERFORMANCE = ["performance_status", "auc", "reference_auc"]


def monitoring_asof(state: DataFrame, monitoring: DataFrame, date: str = "month") -> DataFrame:
    """Per date the champion's last monitoring row before it, and its last row whose performance was assessed: statuses, figures (null if the
    monitoring has none) and the months of both."""
    mon = monitoring.withColumnRenamed("model_version", "champion")
    mon = mon.withColumns({c: F.lit(None).cast("double") for c in [*STABILITY[1:], *PERFORMANCE[1:]] if c not in mon.columns})
    mon = mon.withColumns({"stability_month": F.col("snapshot_date"), "performance_month": F.col("snapshot_date")})
    latest = asof_join(state, mon, ["champion"], date, "snapshot_date", [*STABILITY, "stability_month"], strict=True, slices=1)
    assessed = mon.filter(F.col("performance_status").isin("ok", "watch", "alert"))
    return asof_join(latest, assessed, ["champion"], date, "snapshot_date", [*PERFORMANCE, "performance_month"], strict=True, slices=1)


def _alert_text(kind: str, first: tuple[str, str], second: tuple[str, str]) -> Column:
    """An alert with its month, and its two figures if both are known."""
    month = F.date_format(f"{kind}_month", "yyyy-MM")
    figures = F.format_string(f" ({first[0]} %.3f, {second[0]} %.3f)" if kind == "stability" else f" ({first[0]} %.3f vs {second[0]} %.3f)",
                              F.col(first[1]).cast("double"), F.col(second[1]).cast("double"))
    known = F.col(first[1]).isNotNull() & F.col(second[1]).isNotNull()
    return F.when(F.col(f"{kind}_status") == "alert", F.concat(F.lit(f"{kind} alert "), month, F.when(known, figures).otherwise("")))


def decision_detail() -> Column:
    """Why a date's decision was made, in words."""
    alerts = F.concat_ws("; ", _alert_text("stability", ("score PSI", "score_psi"), ("max feature PSI", "max_feature_psi")),
                         _alert_text("performance", ("AUC", "auc"), ("ref", "reference_auc")))
    months = F.col("labelled_months").cast("string")
    cold = F.col("champion").isNull()
    return (F.when(cold & (F.col("trigger") == "cooldown"), F.concat(F.lit("last attempt "), F.col("last_training").cast("string"), F.lit(" failed gates")))
            .when(F.col("trigger") == "initial", F.concat(months, F.lit(" labelled months available")))
            .when(F.col("trigger") == "cold_start", F.concat(months, F.lit(f"/{MIN_LABEL_MONTHS} labelled months")))
            .when(F.col("trigger") == "scheduled", F.concat(F.lit("champion trained "), F.col("champion_age").cast("string"), F.lit(" months ago")))
            .when(F.col("trigger") == "triggered", alerts)
            .when(F.col("trigger") == "cooldown", F.concat(alerts, F.lit(" (trained "), F.col("months_since_training").cast("string"), F.lit("m ago)")))
            .otherwise(F.concat(F.lit("champion "), F.col("champion"), F.lit(" age "), F.col("champion_age").cast("string"), F.lit("m, no alerts"))))


def refresh_decisions(dates: DataFrame, roles: DataFrame, runs: DataFrame, models: DataFrame, labels: DataFrame,
                      monitoring: DataFrame, label_date: str = "snapshot_date", date: str = "month") -> DataFrame:
    """Train or skip, with the trigger and the reason in words, for every date."""
    state = roles_asof(dates, roles, date)
    state = latest_training(state, runs, date)
    state = labelled_months(state, labels, label_date, date)
    state = state.join(models.select(F.col("model_version").alias("champion"), "model_train_date"), "champion", "left")
    state = monitoring_asof(state, monitoring, date)
    age = calendar_months(date, "model_train_date")
    since = F.coalesce(calendar_months(date, "last_training"), F.lit(999))
    alert = (F.coalesce(F.col("stability_status") == "alert", F.lit(False))
             | F.coalesce(F.col("performance_status") == "alert", F.lit(False)))
    cold = F.col("champion").isNull()
    trigger = (F.when(cold & (since < COOLDOWN_MONTHS), "cooldown")
               .when(cold & (F.col("labelled_months") >= MIN_LABEL_MONTHS), "initial")
               .when(cold, "cold_start")
               .when((since >= REFRESH_MONTHS) & (age >= REFRESH_MONTHS), "scheduled")
               .when(alert & (since >= COOLDOWN_MONTHS), "triggered")
               .when(alert, "cooldown").otherwise("healthy"))
    decision = F.when(F.col("trigger").isin("initial", "scheduled", "triggered"), "train").otherwise("skip")
    return (state.withColumns({"trigger": trigger, "champion_age": age, "months_since_training": since, "alert": alert})
            .withColumns({"decision": decision, "detail": decision_detail()})
            .select(date, "champion", "labelled_months", "champion_age", "months_since_training", "alert", "decision",
                    "trigger", "detail"))
