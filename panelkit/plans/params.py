"""Fitted feature parameters as versioned tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.binning import edge_labels, labelled_bin
from panelkit.operators.impute import apply_age, apply_counts, fit_age, fit_counts, fit_group_medians, integer_quartiles
from panelkit.session import materialize
from panelkit.sources.sinks import write_partitions

# key and value columns of each group table
GROUP_TABLES = {
    "changed_credit_limit": (["Credit_Mix", "Payment_of_Min_Amount"], ["Changed_Credit_Limit_Median"]),
    "age_income_lookup": (["Occupation", "Age_Bin"], ["log_income_median", "age_median", "count"]),
    "occupation_age_median": (["Occupation"], ["occupation_age_median"]),
    "bank_group_stats": (["Occupation", "Age_Bin"], ["median"]),
    "bank_occupation_median": (["Occupation"], ["occupation_median"]),
    "card_group_stats": (["Occupation", "Age_Bin"], ["median"]),
    "card_occupation_median": (["Occupation"], ["occupation_median"]),
}


@dataclass
class FeatureParams:
    """Group tables, single numbers and bin edges fitted on one training window."""

    train_date: str
    tables: dict[str, DataFrame] = field(default_factory=dict)
    scalars: dict[str, float | None] = field(default_factory=dict)
    edges: dict[str, list[float]] = field(default_factory=dict)

    def group_rows(self) -> DataFrame:
        """All group tables as one long table."""
        parts = []
        for name, table in self.tables.items():
            keys, values = GROUP_TABLES[name]
            slots = [F.col(k) for k in keys] + [F.lit(None).cast("string")] * (2 - len(keys))
            items = F.array(*[F.struct(F.lit(v).alias("field"), F.col(v).cast("double").alias("value")) for v in values])
            parts.append(table.select(F.lit(name).alias("param"), slots[0].alias("key1"), slots[1].alias("key2"),
                                      F.inline(items)))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.withColumn("params_date", F.lit(self.train_date))

    def scalar_rows(self, spark: SparkSession) -> DataFrame:
        """Single numbers as a table."""
        rows = [(self.train_date, k, None if v is None else float(v)) for k, v in self.scalars.items()]
        return spark.createDataFrame(rows, "params_date string, name string, value double")

    def edge_rows(self, spark: SparkSession) -> DataFrame:
        """Bin edges with the label of the bin that ends at each edge."""
        rows = [(self.train_date, name, i, float(e), ([None] + edge_labels(edges))[i])
                for name, edges in self.edges.items() for i, e in enumerate(edges)]
        return spark.createDataFrame(rows, "params_date string, param string, pos int, edge double, label string")

    def save(self, spark: SparkSession, path: str) -> None:
        """One partition per training date; a re-run replaces its own."""
        write_partitions(self.group_rows(), f"{path}/params_group", ["params_date", "param"])
        write_partitions(self.scalar_rows(spark), f"{path}/params_scalar", ["params_date"])
        write_partitions(self.edge_rows(spark), f"{path}/params_edges", ["params_date"])


def load_params(spark: SparkSession, path: str, train_date: str) -> FeatureParams:
    """Parameters of one training date."""
    def part(name: str) -> DataFrame:
        return (spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")
                .withColumn("params_date", F.col("params_date").cast("string"))
                .filter(F.col("params_date") == train_date))

    group = part("params_group")
    present = {r["param"] for r in group.select("param").distinct().collect()}  # at most the seven names above
    tables = {}
    for name, (keys, values) in GROUP_TABLES.items():
        if name in present:
            wide = group.filter(F.col("param") == name).groupBy("key1", "key2").agg(
                *[F.max(F.when(F.col("field") == v, F.col("value"))).alias(v) for v in values])
            tables[name] = wide.select(*[F.col(f"key{i + 1}").alias(k) for i, k in enumerate(keys)], *values)
    scalars = {r["name"]: r["value"] for r in part("params_scalar").collect()}
    edges: dict[str, list[float]] = {}
    for r in part("params_edges").orderBy("param", "pos").collect():
        edges.setdefault(r["param"], []).append(r["edge"])
    return FeatureParams(train_date, tables, scalars, edges)


@dataclass
class DatedParams:
    """Parameters of several training dates as data: group tables keyed by ``params_date``, and one row a date with the single numbers and
    the edges as arrays (``<name>_edges``, distinct, in order, at most ``most_edges``) with the labels between them (``<name>_labels``)."""

    tables: dict[str, DataFrame]
    numbers: DataFrame
    most_edges: int


def load_dated_params(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DatedParams:
    """Saved parameters of the given dates, or of all."""
    def part(name: str) -> DataFrame:
        table = (spark.read.option("basePath", f"{path}/{name}").parquet(f"{path}/{name}")
                 .withColumn("params_date", F.col("params_date").cast("string")))
        return table if dates is None else table.filter(F.col("params_date").isin(list(dates)))

    group = part("params_group")
    present = {r["param"] for r in group.select("param").distinct().collect()}  # at most the seven names above
    tables = {}
    for name, (keys, values) in GROUP_TABLES.items():
        if name in present:
            wide = group.filter(F.col("param") == name).groupBy("params_date", "key1", "key2").agg(
                *[F.max(F.when(F.col("field") == v, F.col("value"))).alias(v) for v in values])
            tables[name] = wide.select("params_date", *[F.col(f"key{i + 1}").alias(k) for i, k in enumerate(keys)], *values)
    scalars = part("params_scalar").groupBy("params_date").agg(
        *[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in SCALARS])
    names, saved = ("age", *COUNTS), part("params_edges")
    edges = saved.groupBy("params_date").agg(
        *[F.sort_array(F.collect_set(F.when(F.col("param") == n, F.struct("edge", "label")))).alias(n) for n in names])
    edges = edges.select("params_date", *[F.transform(n, lambda e: e["edge"]).alias(f"{n}_edges") for n in names],
                         *[F.expr(f"transform(filter({n}, (e, i) -> i > 0), e -> e.label)").alias(f"{n}_labels") for n in names])
    most = saved.groupBy("params_date", "param").count().agg(F.max("count")).first()[0] or 0  # as many as quartiles have
    return DatedParams(tables, scalars.join(edges, "params_date", "left"), most)


# count columns: raw column, stem of the made columns, least rows of a group
COUNTS = {"bank": ("Num_Bank_Accounts", "Bank_Accounts", 30), "card": ("Num_Credit_Card", "Credit_Cards", 10)}
SCALARS = ["overall_age_median", *[f"{kind}_{n}" for kind in COUNTS for n in ("p95", "overall_median")]]
# columns the fits read
FIT_COLUMNS = ["Credit_Mix", "Payment_of_Min_Amount", "Changed_Credit_Limit", "Age", "Occupation", "Annual_Income",
               "Credit_History_Age_Years", "Num_Bank_Accounts", "Num_Credit_Card"]


def fit_params(train: DataFrame, train_date: str, with_limit: bool = True) -> FeatureParams:
    """Fit every imputation step on the training rows, each step on the output of the one before.

    Only the columns the fits need are written once and read by each step.
    """
    params = FeatureParams(train_date)
    train = materialize(train.select(*FIT_COLUMNS), "fit-rows")
    if with_limit:
        params.tables["changed_credit_limit"] = materialize(fit_group_medians(
            train, "Changed_Credit_Limit", ["Credit_Mix", "Payment_of_Min_Amount"], "Changed_Credit_Limit_Median"))
    age = fit_age(train)
    params.tables["age_income_lookup"] = materialize(age["age_income_lookup"])
    params.tables["occupation_age_median"] = materialize(age["occupation_age_median"])
    params.scalars["overall_age_median"] = age["overall_age_median"]
    args = (params.tables["age_income_lookup"], params.tables["occupation_age_median"], age["overall_age_median"])
    aged = materialize(apply_age(train, *args).select("Occupation", "Age_imputed", "Num_Bank_Accounts",
                                                      "Num_Credit_Card"), "aged")
    params.edges["age"] = integer_quartiles(aged, ["Age_imputed"])["Age_imputed"]
    filled = aged.withColumn("Age_Bin", labelled_bin("Age_imputed", params.edges["age"]))
    fitted = fit_counts(filled, {c: least for c, _, least in COUNTS.values()})
    for kind, (column, stem, _) in COUNTS.items():
        found = fitted[column]
        params.tables[f"{kind}_group_stats"] = found["group_stats"]
        params.tables[f"{kind}_occupation_median"] = found["occupation_median"]
        params.scalars[f"{kind}_p95"] = found["p95"]
        params.scalars[f"{kind}_overall_median"] = found["overall_median"]
        filled = apply_counts(filled, column, stem, **found)
    stems = {kind: f"{stem}_imputed" for kind, (_, stem, _) in COUNTS.items()}
    edges = integer_quartiles(filled, list(stems.values()))
    params.edges.update({kind: edges[column] for kind, column in stems.items()})
    return params
