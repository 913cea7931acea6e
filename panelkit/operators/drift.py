"""Binned distributions, information value, population stability, weight of evidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.binning import inner_edges, level_bin, open_bin
from panelkit.operators.quantiles import collect_quantiles
from panelkit.operators.ranking import same_keys

DECILES = [i / 10 for i in range(11)]


def decile_edges(df: DataFrame, features: Sequence[str], bins: int = 10) -> dict[str, list[float] | None]:
    """Inner decile edges per numeric feature; None where the feature has fewer than two distinct edges."""
    cuts = collect_quantiles(df, features, [i / bins for i in range(bins + 1)])
    return {f: inner_edges(e) for f, e in cuts.items()}


def binned(df: DataFrame, edges: Mapping[str, list[float] | None], levels: Sequence[str] = (),
           keep: Sequence[str | Column] = ()) -> DataFrame:
    """Long form (kept columns, feature, bin); stays inside the scan stage, so only counts are shuffled after it."""
    bins = {**{f: open_bin(f, e) for f, e in edges.items()}, **{f: level_bin(f) for f in levels}}
    items = F.array(*[F.struct(F.lit(f).alias("feature"), b.alias("bin")) for f, b in bins.items()])
    return df.select(*keep, F.inline(items))


def shares(long: DataFrame, keys: Sequence[str] = (), feature: str = "feature", bin_col: str = "bin", weight: str | None = None) -> DataFrame:
    """Row count and share of each bin within its keys and feature; ``weight`` names the counts of rows already counted."""
    group = [*keys, feature]
    counted = long.groupBy(*group, bin_col).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("n"))
    totals = counted.groupBy(*group).agg(F.sum("n").alias("total"))
    return (same_keys(counted, totals, group, "inner")
            .withColumn("share", F.col("n") / F.col("total")).drop("total"))


def psi_term(expected: Column, actual: Column, eps: float = 1e-4) -> Column:
    """One bin's contribution to the population stability index."""
    e, a = expected + eps, actual + eps
    return (a - e) * F.log(a / e)


def psi(expected: DataFrame, actual: DataFrame, keys: Sequence[str] = (), shared: Sequence[str] = ("feature",),
        eps: float = 1e-4) -> DataFrame:
    """PSI per actual keys and shared keys; bins on one side only count as zero on the other.

    ``expected`` has shared keys, bin and share; ``actual`` also has ``keys`` (such as the month). The baseline is
    repeated per actual key group by an equi-join on the shared keys: groups times bins, never rows.
    """
    groups = actual.select(*keys, *shared).distinct()
    base = groups.join(expected.select(*shared, "bin", F.col("share").alias("expected")), list(shared))
    seen = actual.select(*keys, *shared, "bin", F.col("share").alias("actual"))
    both = base.join(seen, [*keys, *shared, "bin"], "full_outer")
    zero = F.lit(0.0)
    term = psi_term(F.coalesce("expected", zero), F.coalesce("actual", zero), eps)
    return both.groupBy(*keys, *shared).agg(F.sum(term).alias("psi"))


def contingency(long: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Goods and bads per feature and bin; a class without rows counts zero."""
    y = F.col(label).cast("long")
    return long.groupBy(*keys, "feature", "bin").agg(F.sum(1 - y).alias("goods"), F.sum(y).alias("bads"))


def evidence(table: DataFrame, keys: Sequence[str] = (), eps: float = 0.5) -> DataFrame:
    """Smoothed good and bad shares per bin and their log ratio (weight of evidence)."""
    group = [*keys, "feature"]
    totals = table.groupBy(*group).agg(F.sum("goods").alias("tg"), F.sum("bads").alias("tb"))
    bad = (F.col("bads") + eps) / (F.col("tb") + eps)
    good = (F.col("goods") + eps) / (F.col("tg") + eps)
    return (same_keys(table, totals, group, "inner")
            .withColumns({"bad_share": bad, "good_share": good, "woe": F.log(bad / good)}).drop("tg", "tb"))


def information_value(table: DataFrame, keys: Sequence[str] = (), eps: float = 0.5) -> DataFrame:
    """Information value per feature of a contingency table."""
    return (evidence(table, keys, eps).groupBy(*keys, "feature")
            .agg(F.sum((F.col("bad_share") - F.col("good_share")) * F.col("woe")).alias("iv")))


def apply_woe(df: DataFrame, woe: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds ``<feature>_woe``; an unseen level is neutral (0)."""
    for f in features:
        lookup = woe.filter(F.col("feature") == f).select(F.col("bin").alias("__bin"), F.col("woe").alias(f"{f}_woe"))
        df = (df.join(lookup, level_bin(f) == F.col("__bin"), "left").drop("__bin")
              .fillna(0.0, [f"{f}_woe"]))
    return df
