"""Grouped model metrics from one row per distinct score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.quantiles import exact_quantiles
from panelkit.operators.ranking import distinct_values, running_totals, same_keys

TINY = 2.220446049250313e-16  # double precision step, the clip bound of log loss


def score_table(df: DataFrame, score: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per keys and distinct score the goods and bads at it, below it and in all; unlabelled rows are left out."""
    rows = (df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
            .select(*keys, F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("bads"))
            .withColumn("goods", 1 - F.col("bads")))
    base = distinct_values(rows, ["score"], keys, sums=["bads", "goods"]).withColumnRenamed("value", "score")
    return running_totals(base.drop("feature"), keys, "score", ["bads", "goods"], "slice")


def discrimination(df: DataFrame, score: str, label: str, keys: Sequence[str] = (),
                   threshold: float | None = None) -> DataFrame:
    """One row per key group: counts, AUC, Gini, KS, Youden threshold, average precision, Brier, log loss.

    Ranking metrics are null for a group with one class. With ``threshold``, precision, recall and F1 of
    ``score >= threshold`` are added.
    """
    rows = score_table(df, score, label, keys).withColumnsRenamed({"bads_total": "n_bad", "goods_total": "n_good"})
    bad, good = F.col("n_bad").cast("double"), F.col("n_good").cast("double")
    caught = F.col("n_bad") - F.col("bads_before")        # bads scored at this value or above
    false = F.col("n_good") - F.col("goods_before")
    gap = F.try_divide(caught.cast("double"), bad) - F.try_divide(false.cast("double"), good)
    s = F.col("score")
    clipped = F.greatest(F.least(s, F.lit(1 - TINY)), F.lit(TINY))
    aggs = [
        F.max("n_bad").alias("n_bad"), F.max("n_good").alias("n_good"),
        F.sum(F.col("bads") * (F.col("goods_before") + F.col("goods") / F.lit(2.0))).alias("__wins"),
        F.max(gap).alias("__ks"), F.max_by(s, F.struct(gap, s)).alias("__cut"),
        F.sum(F.col("bads") * F.try_divide(caught.cast("double"), (caught + false).cast("double"))).alias("__ap"),
        F.sum(F.col("bads") * F.pow(1 - s, 2) + F.col("goods") * F.pow(s, 2)).alias("__brier"),
        F.sum(-F.col("bads") * F.log(clipped) - F.col("goods") * F.log(1 - clipped)).alias("__loss"),
        F.sum(s * (F.col("bads") + F.col("goods"))).alias("__score"),
    ]
    if threshold is not None:
        above = s >= F.lit(float(threshold))
        aggs += [F.coalesce(F.sum(F.when(above, F.col("bads"))), F.lit(0)).alias("__tp"),
                 F.coalesce(F.sum(F.when(above, F.col("goods"))), F.lit(0)).alias("__fp")]
    made = rows.groupBy(*keys).agg(*aggs)
    n = (F.col("n_bad") + F.col("n_good")).cast("double")
    both = (F.col("n_bad") > 0) & (F.col("n_good") > 0)
    auc = F.when(both, F.col("__wins") / (F.col("n_bad").cast("double") * F.col("n_good")))
    out = [*keys, (F.col("n_bad") + F.col("n_good")).alias("n"), "n_bad", "n_good",
           (F.col("n_bad") / n).alias("default_rate"), (F.col("__score") / n).alias("mean_score"),
           auc.alias("auc"), (2 * auc - 1).alias("gini"),
           F.when(both, F.greatest(F.col("__ks"), F.lit(0.0))).alias("ks"),
           F.when(both & (F.col("__ks") > 0), F.col("__cut")).alias("youden_threshold"),
           F.when(F.col("n_bad") > 0, F.col("__ap") / F.col("n_bad")).alias("average_precision"),
           (F.col("__brier") / n).alias("brier"), (F.col("__loss") / n).alias("log_loss")]
    if threshold is not None:
        tp, fp = F.col("__tp").cast("double"), F.col("__fp").cast("double")
        out += [F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
                F.coalesce(F.try_divide(tp, F.col("n_bad")), F.lit(0.0)).alias("recall"),
                F.coalesce(F.try_divide(2 * tp, tp + fp + F.col("n_bad")), F.lit(0.0)).alias("f1")]
    return made.select(*out)


def calibration(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean score and observed rate per quantile bin; bins are closed above on inner edges, empty bins omitted."""
    rows = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    cuts = exact_quantiles(rows, [score], [i / bins for i in range(bins + 1)]).collect()
    inner = sorted(r["value"] for r in cuts)[1:-1]
    number = F.lit(0)
    for edge in inner:
        number = number + (F.col(score) > F.lit(edge)).cast("int")
    return (rows.groupBy(number.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_predicted"),
                 F.avg(F.col(label).cast("double")).alias("observed_rate")))


def score_summary(df: DataFrame, score: str, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """Mean, 10th, 50th and 90th percentile and share at or above the threshold."""
    base = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
                                 F.avg((F.col(score) >= threshold).cast("double")).alias("predicted_default_rate"))
    long = exact_quantiles(df, [score], [0.1, 0.5, 0.9], keys)
    wide = long.groupBy(*keys).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
                                     for p, name in [(0.1, "p10"), (0.5, "p50"), (0.9, "p90")]])
    if keys:
        return same_keys(base, wide, keys, "left")
    one = F.lit(1).alias("__one")
    return base.select("*", one).join(wide.select("*", one), "__one").drop("__one")
