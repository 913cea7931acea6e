"""Column profiles, correlations, collinearity and components."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.quantiles import exact_quantiles
from panelkit.operators.rankcorr import pairwise_spearman
from panelkit.operators.ranking import average_ranks


def sample_skewness(column: str) -> Column:
    """Bias-corrected skewness; null below three rows or without spread."""
    n = F.count(column).cast("double")
    return F.when((n > 2) & (F.var_pop(column) > 0), F.skewness(column) * F.sqrt(n * (n - 1)) / (n - 2))


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quantiles, extremes, missing share, skewness, share outside p01..p99 and maximum over p99 per column."""
    cuts = (exact_quantiles(df, columns, [0.01, 0.5, 0.99]).groupBy("feature").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
          for p, name in [(0.01, "p01"), (0.5, "median"), (0.99, "p99")]]))
    pinned = {r["feature"]: r for r in cuts.collect()}  # one row per column
    stats = []
    for c in columns:
        low, high = (pinned[c]["p01"], pinned[c]["p99"]) if c in pinned else (None, None)
        value = F.col(c).cast("double")
        outside = F.coalesce((value < F.lit(low)) | (value > F.lit(high)), F.lit(False)).cast("double")
        stats.append(F.struct(
            F.lit(c).alias("feature"), F.lit(low).cast("double").alias("p01"),
            F.lit(pinned[c]["median"] if c in pinned else None).cast("double").alias("median"),
            F.lit(high).cast("double").alias("p99"), F.min(value).alias("min"), F.max(value).alias("max"),
            F.avg(value.isNull().cast("double")).alias("missing"), sample_skewness(c).alias("skew"),
            F.avg(outside).alias("share_outside_p01_p99"),
            F.max(value) / F.lit(high or None).cast("double"))  .alias(c))
    wide = df.agg(*stats)
    names = ["feature", "p01", "median", "p99", "min", "max", "missing", "skew", "share_outside_p01_p99",
             "max_over_p99"]
    return wide.select(F.inline(F.array(*[F.col(c) for c in columns]))).toDF(*names)


#: Values that the summary of a column tracks, and those whose counts are taken again.
TRACKED, CANDIDATES = 8192, 32


def top_value_share(df: DataFrame, columns: Sequence[str], tracked: int = TRACKED, candidates: int = CANDIDATES) -> DataFrame:
    """Share of the most frequent value per column, null counted as a value; exact.

    One pass keeps a mergeable summary of frequent items for each column, of ``tracked`` values whatever the column holds; its first
    ``candidates`` are counted again exactly in a second pass. A value outside the summary occurs in at most 4 / ``tracked`` of the
    rows, and one below the candidates at most as often as the last of them was estimated. Where that leaves a doubt (nearly
    unique columns), the column's values are all counted, as only then.
    """
    text = lambda c: F.col(c).cast("string")
    found = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)], *[
        F.call_function("approx_top_k", text(c), F.lit(candidates), F.lit(tracked)).alias(f"t{i}") for i, c in enumerate(columns)]).first()
    rows = found["rows"]
    tops = [[e for e in (found[f"t{i}"] or []) if e["item"] is not None] for i in range(len(columns))]  # nulls are counted apart
    again = df.agg(*[F.count(F.when(text(c) == e["item"], 1)).alias(f"c{i}_{j}") for i, c in enumerate(columns) for j, e in enumerate(tops[i])] or [F.lit(0)]).first()
    known, open_ = [], []
    for i, c in enumerate(columns):
        best = max([again[f"c{i}_{j}"] for j in range(len(tops[i]))], default=0)
        nulls = rows - found[f"n{i}"]
        least = tops[i][-1]["count"] if len(tops[i]) >= candidates - 1 else 0
        if max(best, nulls) >= max(least, 4 * rows / tracked) or best + nulls == rows:
            known.append((c, max(best, nulls) / rows if rows else None))
        else:
            open_.append(c)
    made = df.sparkSession.createDataFrame(known, "feature string, top_value_share double")
    if not open_:
        return made
    items = F.array(*[F.struct(F.lit(c).alias("feature"), text(c).alias("value")) for c in open_])
    counts = df.select(F.inline(items)).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return made.unionByName(counts.groupBy("feature").agg((F.max("n") / F.sum("n")).alias("top_value_share")))


def mode_of(df: DataFrame, keys: Sequence[str], column: str, out: str = "mode", weight: str | None = None) -> DataFrame:
    """Most frequent non-null value per key group, the smallest on a tie; ``weight`` counts pre-counted rows."""
    size = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(size.alias("n"))
    top = counts.groupBy(*keys).agg(F.max("n").alias("__top"))
    return (counts.join(top, list(keys)).filter(F.col("n") == F.col("__top"))
            .groupBy(*keys).agg(F.min(column).alias(out)))


def pair_correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both values are present; null when either does not vary."""
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    varies = (F.max(x) > F.min(x)) & (F.max(y) > F.min(y))
    return F.when(varies, F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y))))


def label_correlations(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Pearson correlation of each column with the label over complete pairs, all columns in one pass."""
    stats = []
    for c in columns:
        x = F.col(c).cast("double")
        x = F.when(~(F.isnan(x) | (F.abs(x) == float("inf"))), x)
        y = F.when(x.isNotNull(), F.col(label).cast("double"))
        x = F.when(y.isNotNull(), x)
        stats.append(F.struct(F.lit(c).alias("feature"), pair_correlation(x, y).alias("correlation"),
                              F.count(x).alias("valid_rows")).alias(c))
    return df.agg(*stats).select(F.inline(F.array(*[F.col(c) for c in columns])))


def by_strength(df: DataFrame, column: str) -> DataFrame:
    """Largest absolute value first, nulls last."""
    return df.orderBy(F.abs(column).desc_nulls_last())


def spearman_with_label(df: DataFrame, columns: Sequence[str], label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rank correlation of each column with a 0/1 label.

    Ranking a two-valued label only rescales it, so it is the correlation of the column's average ranks
    with the label itself, computed from one row per distinct value.
    """
    rows = df.filter(F.col(label).isNotNull()).withColumn("__y", F.col(label).cast("long"))
    ranks = average_ranks(rows, columns, keys, sums=["__y"])
    r, n, y = F.col("avg_rank"), F.col("n").cast("double"), F.col("__y").cast("double")
    m = ranks.groupBy(*keys, "feature").agg(
        F.max("n_total").cast("double").alias("c"), F.sum(n * r).alias("sr"), F.sum(n * r * r).alias("srr"),
        F.max("__y_total").cast("double").alias("sy"), F.sum(y * r).alias("sry"))
    cov = F.col("sry") / F.col("c") - (F.col("sr") / F.col("c")) * (F.col("sy") / F.col("c"))
    vr = F.col("srr") / F.col("c") - F.pow(F.col("sr") / F.col("c"), 2)
    vy = F.col("sy") / F.col("c") - F.pow(F.col("sy") / F.col("c"), 2)
    return m.select(*keys, "feature", F.when((vr > 0) & (vy > 0), cov / F.sqrt(vr * vy)).alias("spearman"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Pearson correlation matrix over complete rows: one number per column pair reaches the driver."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows).select("features")
    return Correlation.corr(vectors, "features", "pearson").first()[0].toArray()


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Rank correlation matrix over complete rows."""
    return pairwise_spearman(df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna(), columns)


def spearman_lookup(df: DataFrame, columns: Sequence[str]) -> Callable[[str, str], float]:
    """Function (a, b) -> rank correlation over the rows where both are present; all pairs come from the same few jobs."""
    matrix, at = pairwise_spearman(df, columns), {c: i for i, c in enumerate(columns)}
    return lambda a, b: float(matrix[at[a], at[b]])


def correlation_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over complete pairs, in long form, one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    stats = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                      pair_correlation(F.col(a).cast("double"), F.col(b).cast("double")).alias("correlation")).alias(f"p{i}")
             for i, (a, b) in enumerate(pairs)]
    return df.agg(*stats).select(F.inline(F.array(*[F.col(f"p{i}") for i in range(len(pairs))])))


def inflation(matrix: np.ndarray) -> np.ndarray:
    """Variance inflation of each column of a correlation matrix; infinite for a constant or fully explained column."""
    out = np.full(len(matrix), np.inf)
    varies = ~np.isnan(matrix).all(axis=1) & ~np.isnan(np.diag(matrix))
    flat = np.array([np.isnan(np.delete(matrix[i], i)).all() and len(matrix) > 1 for i in range(len(matrix))])
    use = np.flatnonzero(varies & ~flat)
    if len(use):
        block = matrix[np.ix_(use, use)]
        values = np.diag(np.linalg.inv(block + np.eye(len(use)) * 1e-12))
        out[use] = np.where(values > 1e10, np.inf, values)
    return out


def vif(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Variance inflation per column: the diagonal of the inverse correlation matrix."""
    return dict(zip(columns, (float(v) for v in inflation(correlation_matrix(df, columns)))))


def vif_elimination(df: DataFrame, columns: Sequence[str], limit: float = 10.0) -> tuple[list[str], dict[str, float]]:
    """Drop the worst column until none is above the limit: kept columns and the last value of every column."""
    kept, last = list(columns), {}
    matrix = correlation_matrix(df, columns)
    while len(kept) > 1:
        at = [columns.index(c) for c in kept]
        values = inflation(matrix[np.ix_(at, at)])
        last.update(zip(kept, (float(v) for v in values)))
        worst = int(np.argmax(values))
        if values[worst] <= limit:
            break
        kept.pop(worst)
    return kept, last


def explained_variance(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance share and cumulative share of every principal component of the standardised columns."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    vectors = VectorAssembler(inputCols=list(columns), outputCol="raw").transform(rows)
    scaled = StandardScaler(withMean=True, withStd=True, inputCol="raw", outputCol="scaled").fit(vectors).transform(vectors)
    ratios = PCA(k=len(columns), inputCol="scaled", outputCol="out").fit(scaled).explainedVariance.toArray()
    table = df.sparkSession.createDataFrame([(i + 1, float(v)) for i, v in enumerate(ratios)],
                                            "component int, explained_variance double")
    order = Window.partitionBy(F.lit(0)).orderBy("component")  # one row per column
    return table.withColumn("cumulative_variance", F.sum("explained_variance").over(order))


def components_for(table: DataFrame, shares: Sequence[float] = (0.7, 0.8, 0.85, 0.9, 0.95, 0.99)) -> DataFrame:
    """Fewest components that reach each variance share."""
    return table.agg(*[F.min(F.when(F.col("cumulative_variance") >= s, F.col("component"))).alias(f"share_{int(s * 100)}")
                       for s in shares])


def ranked_pivot(df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Mapping[str, str], places: Sequence[str]) -> DataFrame:
    """One row per key with values of its first rows as columns ``<place>_<name>``: ``values`` maps a name to a column, ``places`` names the ranks.

    Only the wanted ranks of a key are kept before the shuffle, so a busy key sends a few rows a task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    top = df.withColumn("__place", rank).filter(F.col("__place") <= len(places))
    return top.groupBy(*keys).agg(*[F.max(F.when(F.col("__place") == i, F.col(c))).alias(f"{place}_{name}")
                                    for i, place in enumerate(places, 1) for name, c in values.items()])


def method_counts(df: DataFrame, suffix: str = "_imputation_method") -> DataFrame:
    """How often each imputation method was used for each feature: ``feature``, ``method``, ``n``, ``share``; one pass."""
    stems = [c for c in df.columns if c.endswith(suffix)]
    items = F.array(*[F.struct(F.lit(c.removesuffix(suffix)).alias("feature"), F.col(c).alias("method")) for c in stems])
    counted = df.select(F.inline(items)).groupBy("feature", "method").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("feature")))  # a few methods a feature
