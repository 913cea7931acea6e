"""Feature selection report."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.numeric import clip
from panelkit.operators.drift import binned, contingency, decile_edges, information_value, psi, shares
from panelkit.operators.profile import spearman_lookup, top_value_share, vif, vif_elimination
from panelkit.operators.quality import missing_shares
from panelkit.operators.quantiles import collect_quantiles


def capped_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns winsorised to p01..p99, nulls set to the median."""
    cuts = collect_quantiles(df, columns, [0.01, 0.5, 0.99])
    return df.select(*[F.coalesce(clip(F.col(c).cast("double"), v[0], v[2]), F.lit(v[1])).alias(c)
                       for c, v in cuts.items() if len(v) == 3])


def stability_and_value(train: DataFrame, later: DataFrame, roles: Mapping[str, str], label: str) -> DataFrame:
    """Information value on training rows and PSI from training to later rows, per feature."""
    numeric = [f for f, r in roles.items() if r == "numeric"]
    levels = [f for f in roles if f not in numeric]
    edges = decile_edges(train, numeric) if numeric else {}
    edges = {f: edges.get(f) for f in numeric}
    dead = [f for f, e in edges.items() if e is None]  # no values at all: nothing to bin
    edges = {f: e for f, e in edges.items() if e is not None}
    iv = information_value(contingency(binned(train, edges, levels, keep=[label]), label))
    drift = psi(shares(binned(train, edges, levels)), shares(binned(later, edges, levels)))
    out = iv.join(drift.withColumnRenamed("psi", "psi_train_vs_valtest"), "feature", "left")
    if dead:
        zero = train.sparkSession.createDataFrame([(f,) for f in dead], "feature string")
        out = out.unionByName(zero.withColumn("iv", F.lit(0.0)), allowMissingColumns=True)
    return out


def iv_strength(column: str) -> Column:
    """Band of an information value."""
    c = F.col(column)
    return (F.when(c <= 0.02, "useless").when(c <= 0.1, "weak").when(c <= 0.3, "medium")
            .when(c <= 0.5, "strong").otherwise("very strong - check leakage"))


def selection_base(df: DataFrame, roles: Mapping[str, str], label: str = "label", split: str = "data_split",
                   max_missing: float = 0.5, max_top: float = 0.99, min_iv: float = 0.02, max_psi: float = 0.25) -> DataFrame:
    """Per feature: missing shares, top value share, IV, PSI, strength band and the first reason to drop it."""
    train = df.filter(F.col(split) == "train")
    later = df.filter(F.col(split).isin("validation", "test"))
    features = list(roles)
    kinds = df.sparkSession.createDataFrame(list(roles.items()), "feature string, type string")
    table = (kinds.join(missing_shares(train, features).withColumnRenamed("missing_rate", "missing_train"), "feature")
             .join(missing_shares(later, features).withColumnRenamed("missing_rate", "missing_val_test"), "feature")
             .join(top_value_share(train, features), "feature")
             .join(stability_and_value(train, later, roles, label), "feature", "left"))
    reason = (F.when((F.col("missing_train") > max_missing) | (F.col("missing_val_test") > max_missing), "1 missing")
              .when(F.col("top_value_share") > max_top, "2 near-constant")
              .when(F.col("iv") < min_iv, "3 IV")
              .when(F.col("psi_train_vs_valtest") > max_psi, "4 PSI").otherwise(""))
    return table.withColumns({"drop_reason": reason, "iv_strength": iv_strength("iv")})


def keep_first(names: Sequence[str], correlation: Callable[[str, str], float], limit: float = 0.8
               ) -> tuple[list[str], dict[str, str]]:
    """Walk features in order and keep one unless it correlates with a kept one: kept names, dropped -> peer."""
    kept, dropped = [], {}
    for n in names:
        peer = next((k for k in kept if abs(correlation(n, k)) > limit), None)
        if peer is None:
            kept.append(n)
        else:
            dropped[n] = peer
    return kept, dropped


def selection_report(df: DataFrame, roles: Mapping[str, str], label: str = "label", split: str = "data_split",
                     max_corr: float = 0.8, max_vif: float = 10.0) -> DataFrame:
    """Full report: the base checks, then correlation with a stronger feature, then collinearity for the linear model.

    Only the report itself (one row per feature) and a correlation matrix reach the driver.
    """
    spark = df.sparkSession
    rows = {r["feature"]: r.asDict() for r in selection_base(df, roles, label, split).collect()}
    train = df.filter(F.col(split) == "train")
    # equal up to summation order counts as equal, so that a re-run keeps the same feature
    ordered = sorted((f for f, r in rows.items() if not r["drop_reason"] and r["type"] != "categorical"),
                     key=lambda f: (-round(rows[f]["iv"], 10), f))
    if len(ordered) > 1:
        dropped = keep_first(ordered, spearman_lookup(train, ordered), max_corr)[1]
        for f, peer in dropped.items():
            rows[f]["drop_reason"] = f"5 |rho| with {peer}"
    linear = [f for f, r in rows.items() if not r["drop_reason"] and r["type"] == "numeric"]
    last: dict[str, float] = {}
    kept_linear = linear
    if len(linear) > 1:
        kept_linear, last = vif_elimination(capped_filled(train, linear), linear, max_vif)
    out = []
    for f, r in sorted(rows.items()):
        tree = not r["drop_reason"]
        lr_reason = "6 VIF" if f in linear and f not in kept_linear else ""
        out.append((f, r["type"], r["missing_train"], r["missing_val_test"], r["top_value_share"], r["iv"],
                    r["psi_train_vs_valtest"], r["drop_reason"], last.get(f), lr_reason, r["iv_strength"], tree,
                    tree and not lr_reason))
    return spark.createDataFrame(out, "feature string, type string, missing_train double, missing_val_test double, "
                                 "top_value_share double, iv double, psi_train_vs_valtest double, drop_reason string, "
                                 "vif double, lr_drop_reason string, iv_strength string, selected_xgb boolean, "
                                 "selected_lr boolean")


def recheck(df: DataFrame, roles: Mapping[str, str], label: str = "label", split: str = "data_split") -> DataFrame:
    """Curated features on current data with a warning text each: missing, weak, unstable, collinear."""
    train = df.filter(F.col(split) == "train")
    numeric = [f for f, r in roles.items() if r == "numeric"]
    factors = vif(capped_filled(train, numeric), numeric) if len(numeric) > 1 else {}
    table = df.sparkSession.createDataFrame([(k, float(v)) for k, v in factors.items()], "feature string, vif double")
    base = selection_base(df, roles, label, split).drop("drop_reason", "iv_strength", "top_value_share")
    checks = F.filter(F.array(
        F.when(F.greatest("missing_train", "missing_val_test") > 0.5, "missing"), F.when(F.col("iv") < 0.02, "weak"),
        F.when(F.col("psi_train_vs_valtest") > 0.25, "unstable"), F.when(F.col("vif") > 10, "collinear")),
        lambda x: x.isNotNull())
    return base.join(table, "feature", "left").withColumn("warnings", F.array_join(checks, ", "))
