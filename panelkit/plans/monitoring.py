"""Monitoring baseline, monthly summary and feature drift for all models and months in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.binning import level_bin, open_bin_by
from panelkit.functions.numeric import status, worst_status
from panelkit.operators.asof import latest_per_key
from panelkit.operators.drift import binned, decile_edges, psi, shares
from panelkit.operators.metrics import discrimination
from panelkit.operators.profile import mode_of
from panelkit.operators.quality import missing_shares
from panelkit.operators.quantiles import exact_quantiles
from panelkit.session import materialize
from panelkit.sources.sinks import write_partitions

# Monitoring thresholds.
PSI_WATCH, PSI_ALERT = 0.10, 0.25
AUC_DROP_WATCH, AUC_DROP_ALERT = 0.03, 0.05
MIN_LABELLED = 100
SCORE = "model_predictions"
#: Inner decile edges of a feature at most.
EDGES = 9


class Baseline:
    """Training distributions of one model: bin edges, bin shares, missing rates and the reference AUC."""

    def __init__(self, edges: Mapping[str, list[float] | None], levels: Sequence[str], table: DataFrame,
                 missing: DataFrame, reference_auc: float):
        self.edges, self.levels, self.table = dict(edges), list(levels), table
        self.missing, self.reference_auc = missing, reference_auc

    @property
    def features(self) -> list[str]:
        return [f for f in self.edges if f != SCORE] + self.levels


    def save(self, spark: SparkSession, path: str, model_version: str) -> None:
        """Shares, edges and missing rates, one partition per model."""
        tag = F.lit(model_version).alias("model_version")
        write_partitions(self.table.select("*", tag), f"{path}/shares", ["model_version"])
        write_partitions(self.missing.select("*", tag), f"{path}/missing", ["model_version"])
        rows = [(f, -1, None) for f in self.levels] + [(f, -2, None) for f, e in self.edges.items() if e is None]
        rows += [(f, i, float(v)) for f, e in self.edges.items() if e is not None for i, v in [(0, self.reference_auc), *enumerate(e, 1)]]
        write_partitions(spark.createDataFrame(rows, "feature string, pos int, edge double").select("*", tag),
                         f"{path}/edges", ["model_version"])


def load_baseline(spark: SparkSession, path: str, model_version: str) -> Baseline:
    """The baseline saved for a model."""
    def part(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}").filter(F.col("model_version") == model_version).drop("model_version")

    edges: dict[str, list[float] | None] = {}
    levels, reference = [], None
    for r in part("edges").orderBy("feature", "pos").collect():  # edges of one model
        if r["pos"] == -1:
            levels.append(r["feature"])
        elif r["pos"] == -2:
            edges[r["feature"]] = None
        elif r["pos"] == 0:
            reference = r["edge"]
            edges[r["feature"]] = []
        else:
            edges[r["feature"]].append(r["edge"])
    return Baseline(edges, levels, part("shares"), part("missing"), reference)


def build_baseline(train: DataFrame, numeric: Sequence[str], levels: Sequence[str], reference_auc: float) -> Baseline:
    """Decile edges of the score and each numeric feature, shares per bin, missing rates of the features.

    The scored training rows are written once with the columns needed, the small results once more, as every monitoring
    run reads them.
    """
    train = materialize(train.select(SCORE, *numeric, *levels), "baseline-rows")
    edges = decile_edges(train, [SCORE, *numeric])
    edges = {f: edges.get(f) for f in [SCORE, *numeric]}
    table = materialize(shares(binned(train, edges, levels)).select("feature", "bin", "share"), "baseline-shares")
    missing = materialize(missing_shares(train, [*numeric, *levels]).withColumnRenamed("missing_rate", "baseline_missing_rate"),
                          "baseline-missing")
    return Baseline(edges, levels, table, missing, reference_auc)


@dataclass
class Baselines:
    """Training distributions of several models as tables keyed by ``model_version``: cuts (features, inner edges by feature, reference
    AUC; a row each), bin shares and missing rates."""

    cuts: DataFrame
    shares: DataFrame
    missing: DataFrame
    numeric: list[str]
    levels: list[str]
    alike: bool = True  # whether all models have all features

    def save(self, path: str) -> None:
        """One partition per model; a re-run replaces its own."""
        for name, table in (("cuts", self.cuts), ("shares", self.shares), ("missing", self.missing)):
            write_partitions(table, f"{path}/{name}", ["model_version"])


def load_baselines(spark: SparkSession, path: str, numeric: Sequence[str], levels: Sequence[str], models: Sequence[str] | None = None) -> Baselines:
    """Saved baselines, of the given models only if any are given; all of them have the features named."""
    def part(name: str) -> DataFrame:
        table = spark.read.parquet(f"{path}/{name}")
        return table if models is None else table.filter(F.col("model_version").isin(list(models)))
    return Baselines(part("cuts"), part("shares"), part("missing"), list(numeric), list(levels))


def build_baselines(train: DataFrame, numeric: Sequence[str], levels: Sequence[str], reference: DataFrame) -> Baselines:
    """Baselines of all models in ``train`` (the training rows of each, with ``model_version``), in as many jobs for fifty models as for one.

    Decile edges of the score and each number come from one keyed selection, shares and missing rates from one keyed count each.
    ``reference`` holds ``model_version`` and ``reference_auc``; a model without has none.
    """
    features = [SCORE, *numeric]
    train = materialize(train.select("model_version", *features, *levels), "baseline-rows")
    cuts = exact_quantiles(train, features, [i / 10 for i in range(11)], ["model_version"])
    edge = F.sort_array(F.collect_set("value"))
    edges = cuts.groupBy("model_version", "feature").agg(edge.alias("e")).filter(F.size("e") >= 2).select(
        "model_version", F.struct("feature", F.slice("e", F.lit(2), F.size("e") - 2).alias("inner")).alias("entry"))
    by_model = edges.groupBy("model_version").agg(F.map_from_entries(F.collect_list("entry")).alias("__edges"))
    known = train.select("model_version").distinct().join(by_model, "model_version", "left").join(
        reference.select("model_version", "reference_auc"), "model_version", "left")
    names = F.array(*[F.lit(f) for f in [*features, *levels]])
    empty = F.create_map().cast("map<string,array<double>>")
    table = materialize(known.select("model_version", names.alias("__features"), F.coalesce("__edges", empty).alias("__edges"), "reference_auc"), "baseline-cuts")
    rates = missing_shares(train, [*numeric, *levels], ["model_version"]).withColumnRenamed("missing_rate", "baseline_missing_rate")
    made = Baselines(table, table.select("model_version"), materialize(rates, "baseline-missing"), list(numeric), list(levels))
    counts = _own_bins(train, made, ["model_version"]).groupBy("model_version", "feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "baseline-counts")
    made.shares = materialize(shares(counts, ["model_version"], weight="n").select("model_version", "feature", "bin", "share"), "baseline-shares")
    return made


def as_baselines(spark: SparkSession, bases: Baselines | Mapping[str, Baseline]) -> Baselines:
    """Single baselines as keyed tables."""
    if isinstance(bases, Baselines):
        return bases
    cuts = [(m, [SCORE, *b.features], {f: e for f, e in b.edges.items() if e is not None}, float(b.reference_auc)) for m, b in bases.items()]
    table = spark.createDataFrame(cuts, "model_version string, __features array<string>, __edges map<string,array<double>>, reference_auc double")
    tagged = [(b.table.withColumn("model_version", F.lit(m)), b.missing.withColumn("model_version", F.lit(m))) for m, b in bases.items()]
    shares_, missing = (reduce(DataFrame.unionByName, parts) for parts in zip(*tagged))
    numeric = list(dict.fromkeys(f for b in bases.values() for f in b.edges if f != SCORE))
    levels = list(dict.fromkeys(f for b in bases.values() for f in b.levels))
    alike = all(set(b.features) == {*numeric, *levels} for b in bases.values())
    return Baselines(table, shares_, missing, numeric, levels, alike)


def _own_bins(rows: DataFrame, bases: Baselines, keys: Sequence[str]) -> DataFrame:
    """Long form (keys, feature, bin) of each row's features by the cuts of its model; rows of models without cuts yield none."""
    numeric = [SCORE, *bases.numeric]
    edges = [F.try_element_at("__edges", F.lit(f)).alias(f"__e{i}") for i, f in enumerate(numeric)]
    cuts = bases.cuts.select("model_version", "__features", *edges)
    bins = {f: open_bin_by(f, F.col(f"__e{i}"), EDGES) for i, f in enumerate(numeric)} | {f: level_bin(f) for f in bases.levels}
    items = F.array(*[F.struct(F.lit(f).alias("feature"), c.alias("bin")) for f, c in bins.items()])
    own = items if bases.alike else F.filter(items, lambda x: F.array_contains("__features", x["feature"]))
    return rows.join(cuts, "model_version").select(*keys, F.inline(own))


def feature_drift(rows: DataFrame, bases: Baselines | Mapping[str, Baseline], keys: Sequence[str]) -> DataFrame:
    """PSI per key group and feature, the score among them, each model against its own baseline.

    The cuts, one row per model, are joined on the model; a row without a baseline for its model yields no feature. ``keys`` hold
    ``model_version``.
    """
    bases = as_baselines(rows.sparkSession, bases)
    long = _own_bins(rows, bases, keys)
    return _drift(long.groupBy(*keys, "feature", "bin").agg(F.count(F.lit(1)).alias("n")), bases, keys)


def _drift(counts: DataFrame, bases: Baselines, keys: Sequence[str]) -> DataFrame:
    return psi(bases.shares, shares(counts, keys, weight="n"), [k for k in keys if k != "model_version"], ["model_version", "feature"])


@dataclass
class MonitoringState:
    """What a summary needs of scored rows, per key group: counts per feature and bin, counts and sums per role and split, and
    ranking metrics. Groups (months) are independent, so a run adds or replaces its own months only."""

    bins: DataFrame
    cells: DataFrame
    metrics: DataFrame

    def save(self, path: str, by: str = "snapshot_date") -> None:
        """Replace the months present in this state and leave the others as they are."""
        for name, table in vars(self).items():
            write_partitions(table, f"{path}/{name}", [by])


def load_state(spark: SparkSession, path: str) -> MonitoringState:
    """A stored state of all months."""
    return MonitoringState(*[spark.read.parquet(f"{path}/{name}") for name in ("bins", "cells", "metrics")])


def month_state(rows: DataFrame, bases: Baselines | Mapping[str, Baseline], keys: Sequence[str] = ("model_version", "snapshot_date"),
                label: str = "label") -> MonitoringState:
    """The state of the key groups in ``rows`` (predictions with label, split and features). The columns read are written once, as
    counts, sums and metrics read them."""
    keys, bases = list(keys), as_baselines(rows.sparkSession, bases)
    features = [*bases.numeric, *bases.levels]
    rows = materialize(rows.select(*keys, "model_role", "data_split", label, SCORE, "predicted_default", *features), "monitored")
    y = F.col(label).cast("double")
    cells = rows.groupBy(*keys, "model_role", "data_split").agg(
        F.count(F.lit(1)).alias("n"), F.count(label).alias("n_y"), F.sum(SCORE).alias("s"), F.sum(y).alias("y"),
        F.sum("predicted_default").alias("p"), *[F.count(F.when(F.col(f).isNull(), 1)).alias(f"null_{f}") for f in features])
    bins = _own_bins(rows, bases, keys).groupBy(*keys, "feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    metrics = discrimination(rows, SCORE, label, keys).select(*keys, "n_bad", "n_good", "auc", "gini", "ks", "brier")
    return MonitoringState(bins, cells, metrics)


def update_state(path: str, predictions: DataFrame, labels: DataFrame, features: DataFrame, bases: Baselines | Mapping[str, Baseline], months: Sequence[str],
                 as_of: str, key: str = "loan_id") -> None:
    """Recompute the listed months of a stored state as known on a date; only their predictions are read.

    The months to list are the new ones and those whose labels have come since (see ``months_touched``).
    """
    wanted = predictions.filter(F.col("snapshot_date").isin([F.lit(m).cast("date") for m in months]) & (F.col("snapshot_date") <= F.lit(as_of).cast("date")))
    month_state(monitored_rows(wanted, known_labels(labels, as_of).drop("label_date"), features, key), bases).save(path)


def months_touched(predictions: DataFrame, labels: DataFrame, since: str, as_of: str, key: str = "loan_id") -> list[str]:
    """Months that differ between two dates: scored after the first, or with labels observed after it."""
    low, high = F.lit(since).cast("date"), F.lit(as_of).cast("date")
    fresh = labels.filter((F.col("label_date") > low) & (F.col("label_date") <= high)).select(key).distinct()
    old = predictions.filter(F.col("snapshot_date") <= low).join(fresh, key, "left_semi").select("snapshot_date")
    new = predictions.filter((F.col("snapshot_date") > low) & (F.col("snapshot_date") <= high)).select("snapshot_date")
    return sorted(str(r[0]) for r in old.unionByName(new).distinct().collect())  # one a month


def monitoring_summary(rows: DataFrame, bases: Baselines | Mapping[str, Baseline], keys: Sequence[str] = ("model_version", "snapshot_date"),
                       label: str = "label", as_of: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Summary per model and month, and the feature drift behind it; every model is held against its own baseline.

    ``rows`` are predictions with their label (null until matured), split and features; ``keys`` hold ``model_version``. A model without
    a baseline has counts, rates and AUC, but no PSI, reference or drop. With ``as_of`` both tables tell the date.
    """
    bases = as_baselines(rows.sparkSession, bases)
    state = month_state(rows, bases, keys, label)
    return summarise(MonitoringState(materialize(state.bins, "bins"), materialize(state.cells, "cells"), state.metrics), bases, keys, as_of)


def summarise(state: MonitoringState, bases: Baselines | Mapping[str, Baseline], keys: Sequence[str] = ("model_version", "snapshot_date"),
              as_of: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Summary and drift (see ``monitoring_summary``) from a state, which holds a few rows per key group."""
    keys, bases = list(keys), as_baselines(state.cells.sparkSession, bases)
    features, cells = [*bases.numeric, *bases.levels], state.cells
    both = materialize(_drift(state.bins, bases, keys), "drift")
    drift = both.filter(F.col("feature") != SCORE)
    score_psi = both.filter(F.col("feature") == SCORE).select(*keys, F.col("psi").alias("score_psi"))
    total = F.sum("n")
    missing = (cells.groupBy(*keys).agg(*[(F.sum(f"null_{f}") / total).alias(f) for f in features])
               .unpivot(keys, features, "feature", "missing_rate"))
    drift = (drift.join(missing, [*keys, "feature"], "left").join(bases.missing, ["model_version", "feature"], "left")
             .withColumn("status", status("psi", PSI_WATCH, PSI_ALERT)))
    worst = drift.groupBy(*keys).agg(
        F.max("psi").alias("max_feature_psi"), F.max_by("feature", F.struct("psi", "feature")).alias("max_feature_psi_name"),
        F.count(F.when(F.col("status") == "alert", 1)).alias("n_features_psi_alert"))
    size = cells.groupBy(*keys).agg(
        total.alias("n_scored"), F.sum("n_y").alias("n_labelled"), (F.sum("s") / total).alias("mean_predicted_pd"),
        (F.sum("p") / total).alias("predicted_default_rate"), F.try_divide(F.sum("y"), F.sum("n_y")).alias("observed_default_rate"))
    metrics = state.metrics.select(*keys, "n_bad", "n_good", *[F.col(c).alias(f"__{c}") for c in ("auc", "gini", "ks", "brier")])
    out = size
    for table in (metrics, score_psi, worst, mode_of(cells, keys, "model_role", "model_role", "n"),
                  mode_of(cells, keys, "data_split", "label_period", "n")):
        out = out.join(table, keys, "left")
    enough = F.coalesce((F.col("n_labelled") >= MIN_LABELLED) & (F.col("n_bad") > 0) & (F.col("n_good") > 0), F.lit(False))
    out = out.withColumns({c: F.when(enough, F.col(f"__{c}")) for c in ("auc", "gini", "ks", "brier")})
    out = out.join(bases.cuts.select("model_version", "reference_auc"), "model_version", "left")
    out = out.withColumn("auc_drop_vs_reference", F.col("reference_auc") - F.col("auc"))
    out = out.withColumns({
        "performance_status": status("auc_drop_vs_reference", AUC_DROP_WATCH, AUC_DROP_ALERT, "no labels yet"),
        "stability_status": status(F.greatest("score_psi", "max_feature_psi"), PSI_WATCH, PSI_ALERT)})
    out = out.withColumn("overall_status", worst_status("performance_status", "stability_status"))
    out = out.drop("n_bad", "n_good", "__auc", "__gini", "__ks", "__brier")
    if as_of is not None:
        out, drift = (t.withColumn("as_of_date", F.lit(as_of).cast("date")) for t in (out, drift))
    return out, drift


def monitor_as_of(predictions: DataFrame, labels: DataFrame, features: DataFrame, bases: Baselines | Mapping[str, Baseline], targets: DataFrame,
                  as_of: str, key: str = "loan_id") -> tuple[DataFrame, DataFrame]:
    """Monitoring of the target models with what was known on a date: months up to it and labels observed by then, all targets in one job."""
    seen = predictions.filter(F.col("snapshot_date") <= F.lit(as_of).cast("date"))
    wanted = seen.join(targets.select("model_version").distinct(), "model_version", "left_semi")
    rows = monitored_rows(wanted, known_labels(labels, as_of).drop("label_date"), features, key)
    return monitoring_summary(rows, bases, as_of=as_of)


def known_labels(labels: DataFrame, as_of, date: str = "label_date") -> DataFrame:
    """Labels observed on or before a date."""
    return labels.filter(F.col(date) <= F.lit(as_of).cast("date"))


def monitored_rows(predictions: DataFrame, labels: DataFrame, features: DataFrame, key: str = "loan_id") -> DataFrame:
    """Predictions with their matured label and their features."""
    return predictions.join(labels, key, "left").join(features, key, "left")


def monitor_targets(models: DataFrame, roles: DataFrame, predicted: DataFrame, role: str | None = None) -> DataFrame:
    """Models to monitor: the champion, every other model that has predictions, or all of them."""
    scored = models.select("model_version").distinct().join(predicted.select("model_version").distinct(),
                                                            "model_version", "left_semi")
    champion = roles.select(F.col("champion").alias("model_version"))
    if role == "champion":
        return scored.join(champion, "model_version", "left_semi")
    if role == "challenger":
        return scored.join(champion, "model_version", "left_anti")
    return scored


def drift_heatmap(drift: DataFrame, in_force: DataFrame, months: Sequence[str]) -> DataFrame:
    """Feature by month PSI of the model in force each month, one column per listed month (yyyy-MM)."""
    rows = drift.join(in_force.select("snapshot_date", "model_version").distinct(), ["snapshot_date", "model_version"],
                      "left_semi")
    return (rows.withColumn("month", F.date_format("snapshot_date", "yyyy-MM"))
            .groupBy("feature").pivot("month", list(months)).agg(F.avg("psi")))


def production_and_shadow(summary: DataFrame) -> DataFrame:
    """Per month the champion's and the best challenger's figures side by side."""
    champion, challenger = F.col("model_role") == "champion", F.col("model_role") == "challenger"
    best = F.struct(F.coalesce("gini", F.lit(-2.0)), "model_version")
    return summary.groupBy("snapshot_date").agg(
        F.max(F.when(champion, F.col("model_version"))).alias("champion"), F.max(F.when(champion, F.col("gini"))).alias("champion_gini"),
        F.max_by("model_version", F.when(challenger, best)).alias("challenger"),
        F.max(F.when(challenger, F.col("gini"))).alias("challenger_gini"),
        F.max(F.when(champion, F.col("score_psi"))).alias("score_psi"), F.max(F.when(champion, F.col("max_feature_psi"))).alias("max_feature_psi"),
        F.max(F.when(champion, F.col("mean_predicted_pd"))).alias("mean_predicted_pd"),
        F.max(F.when(champion, F.col("observed_default_rate"))).alias("observed_default_rate"),
        F.sum(F.when(champion, F.col("n_scored"))).alias("n_scored"))


def governance_timeline(events: DataFrame, as_of) -> DataFrame:
    """Decisions and trainings up to a date, one row each, with the last record of a decision logged twice."""
    known = events.filter(F.col("as_of_date").cast("date") <= F.lit(as_of).cast("date"))
    return latest_per_key(known, ["as_of_date", "event"], ["logged_at"])
