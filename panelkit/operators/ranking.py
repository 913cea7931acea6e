"""Running totals over an ordered value without sorting a whole group in one task.

A plain window ``partitionBy(month).orderBy(score)`` puts a month into one task. Here rows are first
reduced to one per distinct value, the value range is cut at pinned quantile edges, and a group is
ordered slice by slice; totals of earlier slices are added from a table of a few rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


SMALL = 1_000_000  # rows a single task orders without effort


def slice_count(df: DataFrame) -> int:
    """Slices per ordered column: the session's shuffle width within fixed limits."""
    return min(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8), 4096)


def slice_edges(df: DataFrame, columns: Sequence[str], slices: int | None = None) -> dict[str, list[float]]:
    """Cut points giving slices of similar size, for all columns in one pass; none where the rows are few.

    The cut points only balance the work; any set of them gives the same result. They are
    fixed here, before use, so that a re-run task slices exactly as the first run did.
    """
    n = slices or slice_count(df)
    cuts = F.array(*[F.lit(i / n) for i in range(1, n)])
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.percentile_approx(F.when(~F.isnan(c), F.col(c)), cuts, 4 * n).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    if row["rows"] <= SMALL:
        return {c: [] for c in columns}
    return {c: sorted(set(row[f"c{i}"] or [])) for i, c in enumerate(columns)}


def with_slices(df: DataFrame, edges: dict[str, list[float]], suffix: str = "__slice") -> DataFrame:
    """Adds the slice number of each column."""
    cut = {c: e for c, e in edges.items() if e}
    flat = [c for c in edges if c not in cut]
    df = df.withColumns({c + suffix: F.lit(0) for c in flat})
    if not cut:
        return df
    inf = float("inf")
    made = Bucketizer(splitsArray=[[-inf, *e, inf] for e in cut.values()], inputCols=list(cut),
                      outputCols=[c + suffix for c in cut], handleInvalid="keep").transform(df)
    return made.withColumns({c + suffix: F.col(c + suffix).cast("int") for c in cut})


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on keys where null matches null; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def packed(keys: Sequence[str]):
    """Keys as one struct: equal also where a field is null, and one partitioning serves grouping, window and join."""
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))


def running_totals(df: DataFrame, keys: Sequence[str], order: str, measures: Sequence[str], slice_col: str) -> DataFrame:
    """Adds ``<m>_before`` and ``<m>_total``: totals of ``m`` over smaller ``order`` values and over all rows of the same keys.

    ``df`` holds one row per keys and order value; ``slice_col`` never decreases with ``order``. The table of
    slice totals reads the same shuffled rows as the ordered pass, and joins on the partitioning that pass has.
    """
    rows, part = df.withColumn("__k", packed(keys)), ["__k", slice_col]
    whole = Window.partitionBy("__k")
    earlier = whole.orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    per_slice = rows.groupBy(*part).agg(*[F.sum(m).alias(f"__{m}") for m in measures])
    offsets = per_slice.select(*part, *[F.coalesce(F.sum(f"__{m}").over(earlier), F.lit(0)).alias(f"__{m}_offset") for m in measures],
                               *[F.sum(f"__{m}").over(whole).alias(f"{m}_total") for m in measures])
    inside = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumns({f"__{m}_in": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures})
    return (inner.join(offsets, part)
            .withColumns({f"{m}_before": F.col(f"__{m}_in") + F.col(f"__{m}_offset") for m in measures})
            .drop("__k", *[f"__{m}_in" for m in measures], *[f"__{m}_offset" for m in measures]))


def sliced_values(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), sums: Sequence[str] = (),
                  edges: dict[str, list[float]] | None = None) -> DataFrame:
    """Long form (keys, summed columns, feature, value, slice) without missing values (null or NaN); part of the scan stage."""
    numbers = df.select(*keys, *sums, *[F.col(c).cast("double").alias(c) for c in columns])
    sliced = with_slices(numbers, slice_edges(numbers, columns) if edges is None else edges)
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"),
                               F.col(f"{c}__slice").alias("slice")) for c in columns])
    # a slice that can not be null keeps join conditions from adding a filter to one branch only, so that
    # branches reading these rows share one shuffle
    return (sliced.select(*keys, *sums, F.inline(items)).filter(F.col("value").isNotNull() & ~F.isnan("value"))
            .withColumn("slice", F.coalesce("slice", F.lit(0))))


def distinct_values(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
                    sums: Sequence[str] = (), edges: dict[str, list[float]] | None = None) -> DataFrame:
    """One row per keys, feature, slice and distinct value, with its row count ``n`` and summed columns."""
    return (sliced_values(df, columns, keys, sums, edges).groupBy(*keys, "feature", "slice", "value")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(s).alias(s) for s in sums]))


def average_ranks(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), sums: Sequence[str] = (),
                  edges: dict[str, list[float]] | None = None) -> DataFrame:
    """Per keys, feature and distinct value the average rank (1-based) that ties share, and totals of all summed columns."""
    base = distinct_values(df, columns, keys, sums, edges)
    ranked = running_totals(base, [*keys, "feature"], "value", ["n", *sums], "slice")
    return ranked.withColumn("avg_rank", F.col("n_before") + (F.col("n") + 1) / F.lit(2.0))
