"""Exact quantiles by distributed selection.

Spark's exact percentile keeps every distinct value of a group in one task's memory. Selection instead
counts rows per slice, finds the slices that hold the wanted ranks, and shuffles and orders only the rows in those.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.ranking import distinct_values, packed, slice_edges, sliced_values
from panelkit.session import materialize


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (),
                    interpolate: bool = True, edges: dict[str, list[float]] | None = None) -> DataFrame:
    """Long table (keys, feature, prob, value, n): quantiles of every column per key group, nulls ignored.

    Interpolated quantiles lie at position p * (n - 1); the others are the smallest value whose
    cumulative share reaches p. The first pass shuffles only slice counts. The slices found are written, so the planner
    sees their size; where they are few they reach the second scan as a broadcast, and only the rows inside them
    are shuffled. Without cut points (few rows, or a short list of values) each group is counted and ordered as it is.
    """
    group = [*keys, "feature"]
    numbers = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    edges = slice_edges(numbers, columns) if edges is None else edges
    if not any(edges.values()):
        return quantiles_of_counts(distinct_values(numbers, columns, keys, edges=edges), probs, keys, interpolate, small=True)
    rows = sliced_values(numbers, columns, keys, edges=edges)
    per_slice = rows.groupBy(*group, "slice").agg(F.count(F.lit(1)).alias("slice_n"))
    needed = materialize(located(per_slice, group, probs, interpolate), "ranks")
    inside = rows.withColumn("__k", packed(group)).join(needed.select("__k", "slice"), ["__k", "slice"], "left_semi")
    counts = inside.groupBy(*group, "slice", "value").agg(F.count(F.lit(1)).alias("n"))
    return picked(ordered(counts, needed, group), group)


def coarser(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A value count table for fewer (or derived) keys, without another pass over the rows."""
    return counts.groupBy(*keys, "feature", "slice", "value").agg(F.sum("n").alias("n"))


def quantiles_of_counts(counts: DataFrame, probs: Sequence[float], keys: Sequence[str] = (),
                        interpolate: bool = True, small: bool = False) -> DataFrame:
    """Quantiles from a table with one row per keys, feature, slice and distinct value and its count ``n``.

    ``small`` orders each group as a whole; only for tables known to have few rows.
    """
    group = [*keys, "feature"]
    if small:
        whole = Window.partitionBy(*group)
        running = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        total = F.sum("n").over(whole)
        return _picked_at(counts.withColumns({"total": total, "before": F.coalesce(F.sum("n").over(running), F.lit(0))}), group, probs, interpolate)
    per_slice = counts.groupBy(*group, "slice").agg(F.sum("n").alias("slice_n"))
    return picked(ordered(counts, located(per_slice, group, probs, interpolate), group), group)


def located(per_slice: DataFrame, group: Sequence[str], probs: Sequence[float], interpolate: bool) -> DataFrame:
    """Slices that hold a wanted rank, with the rows before them and those ranks: a few rows per group."""
    whole = Window.partitionBy("__k")
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    total, start = F.sum("slice_n").over(whole), F.coalesce(F.sum("slice_n").over(earlier), F.lit(0))
    located = per_slice.withColumn("__k", packed(group)).select(
        "__k", "slice", "slice_n", total.alias("total"), start.alias("offset"))
    ranks = F.filter(_ranks(probs, F.col("total"), interpolate), lambda r: (
        (r["low"] >= F.col("offset")) & (r["low"] < F.col("offset") + F.col("slice_n")))
        | ((r["high"] >= F.col("offset")) & (r["high"] < F.col("offset") + F.col("slice_n"))))
    return located.withColumn("ranks", ranks).filter(F.size("ranks") > 0).drop("slice_n")


def ordered(counts: DataFrame, needed: DataFrame, group: Sequence[str]) -> DataFrame:
    """Value counts of the needed slices with the rows before each value."""
    inside = Window.partitionBy("__k", "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("__k", packed(group)).join(needed, ["__k", "slice"])
            .withColumn("before", F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))))


def picked(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    """Values at the wanted ranks."""
    hit = rows.select(*group, "total", "value", "before", (F.col("before") + F.col("n")).alias("after"), F.inline("ranks"))
    at = {end: (F.col(end) >= F.col("before")) & (F.col(end) < F.col("after")) for end in ("low", "high")}
    found = (hit.filter(at["low"] | at["high"]).groupBy(*group, "prob", "part")
             .agg(F.max(F.when(at["low"], F.col("value"))).alias("lo"), F.max(F.when(at["high"], F.col("value"))).alias("hi"),
                  F.first("total").alias("n")))
    return found.select(*group, "prob", (F.col("lo") + F.col("part") * (F.col("hi") - F.col("lo"))).alias("value"), "n")


def _picked_at(rows: DataFrame, group: Sequence[str], probs: Sequence[float], interpolate: bool) -> DataFrame:
    """The same with every value of a group at hand: one aggregate looks for all ranks, and rows are not multiplied by them."""
    at = [_rank(p, F.col("total"), interpolate) for p in probs]
    inside = lambda rank: F.max(F.when((rank >= F.col("before")) & (rank < F.col("before") + F.col("n")), F.col("value")))
    wide = rows.groupBy(*group).agg(F.max("total").alias("total"), *[e for i, (low, high, _) in enumerate(at)
                                                                    for e in (inside(low).alias(f"lo{i}"), inside(high).alias(f"hi{i}"))])
    found = F.array(*[F.struct(F.lit(float(p)).alias("prob"), (F.col(f"lo{i}") + at[i][2] * (F.col(f"hi{i}") - F.col(f"lo{i}"))).alias("value"))
                      for i, p in enumerate(probs)])
    return wide.select(*group, F.inline(found), F.col("total").alias("n")).select(*group, "prob", "value", "n")


def _rank(p: float, total, interpolate: bool):
    """Zero-based ranks of one quantile among ``total`` values, and the share taken from the upper one."""
    if interpolate:
        position = F.lit(float(p)) * (total - 1)
        return F.floor(position), F.ceil(position), position - F.floor(position)
    low = F.greatest(F.ceil(F.lit(float(p)) * total) - 1, F.lit(0))
    return low, low, F.lit(0.0)


def _ranks(probs: Sequence[float], total, interpolate: bool):
    """Zero-based ranks of each quantile among ``total`` values, with the share taken from the upper one."""
    def one(p: float):
        low, high, part = _rank(p, total, interpolate)
        return F.struct(F.lit(float(p)).alias("prob"), low.alias("low"), high.alias("high"), part.alias("part"))
    return F.array(*[one(p) for p in probs])


def _wide_medians(long: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(c) for c in columns],
        *[F.coalesce(F.max(F.when(F.col("feature") == c, F.col("n"))), F.lit(0)).alias(f"{c}_n") for c in columns])


def medians(df: DataFrame, columns: Sequence[str], keys: Sequence[str],
            edges: dict[str, list[float]] | None = None) -> DataFrame:
    """Wide table of discrete medians per key group, with ``<column>_n`` non-null rows."""
    return _wide_medians(exact_quantiles(df, columns, [0.5], keys, False, edges), columns, keys)


def medians_of_counts(counts: DataFrame, columns: Sequence[str], keys: Sequence[str], small: bool = False) -> DataFrame:
    """The same from value counts of these keys."""
    return _wide_medians(quantiles_of_counts(counts, [0.5], keys, False, small), columns, keys)


def _as_lists(long: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    found = {(r["feature"], r["prob"]): r["value"] for r in long.collect()}
    return {c: [found[(c, float(p))] for p in probs if (c, float(p)) in found] for c in columns}


def collect_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], interpolate: bool = True,
                      edges: dict[str, list[float]] | None = None) -> dict[str, list[float]]:
    """Quantiles of whole columns as lists, to pin as fitted parameters: len(columns) * len(probs) numbers."""
    return _as_lists(exact_quantiles(df, columns, probs, (), interpolate, edges), columns, probs)


def collect_from_counts(counts: DataFrame, columns: Sequence[str], probs: Sequence[float], interpolate: bool = True,
                        small: bool = False) -> dict[str, list[float]]:
    """The same from a value count table without keys."""
    return _as_lists(quantiles_of_counts(counts, probs, (), interpolate, small), columns, probs)


def quantiles_of_unions(df: DataFrame, columns: Sequence[str], probs: Sequence[float], part: str, unions: Mapping[int, Collection[int]],
                        interpolate: bool = True, edges: dict[str, list[float]] | None = None) -> dict[int, dict[str, list[float]]]:
    """Quantiles of whole columns in groups of rows that overlap, each a union of parts: {group: as ``collect_quantiles``}.

    ``part`` numbers a row's part from 0. Rows are counted once by part, however many groups have it; the counts are added up for each group.
    """
    numbers = df.select(F.col(part).alias("__part"), *[F.col(c).cast("double").alias(c) for c in columns])
    edges = slice_edges(numbers, columns) if edges is None else edges
    of = [[u for u in sorted(unions) if p in unions[u]] for p in range(1 + max((p for some in unions.values() for p in some), default=0))]
    lists = F.array(*[F.array(*[F.lit(u) for u in some]).cast("array<int>") for some in of])
    group = ["__union", "feature"]

    def added(counts: DataFrame, *within: str) -> DataFrame:
        return counts.select("*", F.explode(F.get(lists, F.col("__part"))).alias("__union")).groupBy(*group, *within).agg(F.sum("n").alias("n"))

    rows = sliced_values(numbers, columns, ["__part"], edges=edges)
    count = F.count(F.lit(1)).alias("n")
    if not any(edges.values()):
        long = quantiles_of_counts(added(rows.groupBy("__part", "feature", "slice", "value").agg(count), "slice", "value"), probs, ["__union"], interpolate, small=True)
    else:
        per_slice = added(rows.groupBy("__part", "feature", "slice").agg(count), "slice").withColumnRenamed("n", "slice_n")
        needed = materialize(located(per_slice, group, probs, interpolate), "ranks")
        inside = rows.join(needed.select("__k.feature", "slice").distinct(), ["feature", "slice"], "left_semi")
        counts = added(inside.groupBy("__part", "feature", "slice", "value").agg(count), "slice", "value")
        long = picked(ordered(counts, needed, group), group)
    found = {(r["__union"], r["feature"], r["prob"]): r["value"] for r in long.collect()}
    return {u: {c: [found[u, c, float(p)] for p in probs if (u, c, float(p)) in found] for c in columns} for u in unions}
