"""Data checks as one aggregate each; the raising forms read one row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.dates import Split
from panelkit.functions.numeric import rule_hits


def missing_shares(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Share of nulls per column in long form, all columns in one pass."""
    wide = df.groupBy(*keys).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return wide.unpivot([*keys], list(columns), "feature", "missing_rate")


def mostly_missing(df: DataFrame, columns: Sequence[str], limit: float = 0.5, keys: Sequence[str] = ()) -> DataFrame:
    """Columns whose null share is above the limit."""
    return missing_shares(df, columns, keys).filter(F.col("missing_rate") > limit)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join whose keys must be unique on both sides; an error otherwise."""
    for side, frame in (("left", left), ("right", right)):
        if not duplicate_keys(frame, keys).isEmpty():
            raise ValueError(f"keys {list(keys)} are not unique on the {side} side")
    return left.join(right, list(keys), how)


def with_labels(features: DataFrame, labels: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    """Features with their label; an error when a feature row has none."""
    joined = features.join(labels, list(keys), "left")
    missing = joined.filter(F.col(label).isNull()).count()
    if missing:
        raise ValueError(f"{missing} feature rows have no label")
    return joined


def split_check(df: DataFrame, windows: Sequence[Split], date: str, split: str = "data_split") -> DataFrame:
    """Per split: rows, rows outside their window, first and last date."""
    outside = F.lit(0)
    for w in windows:
        outside = outside + ((F.col(split) == w.name)
                             & ~F.col(date).between(F.lit(w.start), F.lit(w.end))).cast("int")
    return (df.filter(F.col(split).isNotNull()).groupBy(split)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(outside).alias("n_outside"),
                 F.min(date).alias("first_date"), F.max(date).alias("last_date")))


def require_splits(df: DataFrame, windows: Sequence[Split], date: str, split: str = "data_split") -> DataFrame:
    """The same frame, or an error when a split is empty or has rows outside its window."""
    found = {r[split]: r for r in split_check(df, windows, date, split).collect()}  # one row per split
    for w in windows:
        if w.name not in found or found[w.name]["n_outside"]:
            raise ValueError(f"split {w.name!r} has no rows or rows outside {w.start}..{w.end}")
    return df


def later_than(df: DataFrame, columns: Sequence[str], reference: str) -> DataFrame:
    """Per column the rows dated after the reference date (features from the future)."""
    wide = df.agg(*[F.count(F.when(F.col(c) > F.col(reference), 1)).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "feature_date", "n_future")


def any_null(df: DataFrame) -> DataFrame:
    """Rows with a null in any column."""
    condition = F.lit(False)
    for c in df.columns:
        condition = condition | F.col(c).isNull()
    return df.filter(condition)


def metric_gaps(found: DataFrame, expected: DataFrame, keys: Sequence[str], metric: str) -> DataFrame:
    """Recomputed and stored metric side by side with their difference."""
    return (found.select(*keys, F.col(metric).alias("recomputed"))
            .join(expected.select(*keys, F.col(metric).alias("stored")), list(keys), "full_outer")
            .withColumn("difference", F.col("recomputed") - F.col("stored")))


def column_roles(df: DataFrame, categorical: Sequence[str], exclude: Sequence[str] = ()) -> dict[str, str]:
    """categorical, binary (all values 0 or 1) or numeric per column, from one aggregate row."""
    rest = [c for c in df.columns if c not in exclude]
    tested = [c for c in rest if c not in categorical]
    row = df.agg(*[F.coalesce(F.every(F.col(c).isNull() | F.col(c).isin(0, 1)), F.lit(True)).alias(c)
                   for c in tested]).first() if tested else {}
    return {c: "categorical" if c in categorical else "binary" if row[c] else "numeric" for c in rest}


def rule_counts(df: DataFrame, rules: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Per cleaning rule the rows it hits, in long form."""
    return df.agg(*rule_hits(rules)).unpivot([], list(rules), "column", "n_invalid")
