"""Joins in time: latest known row, whole-history lookback keys, roles in force."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.ranking import slice_count, with_slices

#: Rows of both sides that a task of the ordered pass is to have at most, as far as keys and slices can be told apart.
TASK_ROWS = 1_000_000


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The last whole row per key, ordered by ``by``; combined map-side, so a hot key is not sorted in one task."""
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in by] + [c for c in rest if c not in by]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return df.groupBy(*keys).agg(best).select(*keys, "last.*")


def latest_non_null(df: DataFrame, keys: Sequence[str], by: str, columns: Sequence[str]) -> DataFrame:
    """Per key and column the last value that is not null, which may come from different rows."""
    return df.groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(by, c))).alias(c) for c in columns])


def _moment(df: DataFrame, column: str) -> Column:
    """A time as a number: microseconds of dates and timestamps, numbers as they are."""
    kind = df.schema[column].dataType
    return F.unix_micros(F.col(column).cast("timestamp")) if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else F.col(column)


def asof_lookup(probes: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
                columns: Sequence[str], strict: bool = False, slices: int | None = None) -> DataFrame:
    """Per distinct key and time the columns of the right row with the greatest time not after it, as one struct ``found``.

    ``strict`` takes only times before the probe. A segmented scan: time is cut at quantiles of the times of both sides, so that a slice
    holds about the same number of rows whatever the calendar; one ordered pass inside each key and slice finds the last row,
    and the last row of all earlier slices is carried over from a table with one row per key and slice. No pairs of rows
    are formed. ``slices=1`` is for calendars and histories of decisions, which have a row a month: one pass and no measuring. A key with a third of all rows, be it on one day, is spread over a third of the slices, and without keys (``on``
    empty) the slices alone divide the work. A key's carried table has at most ``slices`` rows (by default the session's
    shuffle width within limits); beyond ``TASK_ROWS`` rows for each of that width there are more tasks. Null keys and times find nothing; of several right rows at a time the greatest counts.
    """
    payload = F.struct(F.col(right_time).alias("__at"), *columns)
    facts = (right.filter(F.col(right_time).isNotNull())
             .groupBy(*on, F.col(right_time).alias("__t")).agg(F.max(payload).alias("__row")))
    asked = probes.filter(F.col(left_time).isNotNull()).select(*on, F.col(left_time).alias("__t")).distinct()
    empty = F.lit(None).cast(facts.schema["__row"].dataType)
    first, second = (0, 1) if strict else (1, 0)
    both = (asked.select(*on, "__t", _moment(asked, "__t").cast("double").alias("__n"), F.lit(first).alias("__side"), empty.alias("__row"))
            .unionByName(facts.select(*on, "__t", _moment(facts, "__t").cast("double").alias("__n"), F.lit(second).alias("__side"), "__row")))
    times = probes.select(_moment(probes, left_time).cast("double").alias("__n")).unionByName(right.select(_moment(right, right_time).cast("double").alias("__n")))
    n = slices or slice_count(probes)
    cuts, rows = times.agg(F.percentile_approx("__n", F.array(*[F.lit(i / n) for i in range(1, n)]), 4 * n), F.count(F.lit(1))).first() if n > 1 else ([], 0)
    cuts = sorted(set(cuts or []))
    both = with_slices(both, {"__n": cuts}).withColumnRenamed("__n__slice", "__slot")
    tasks = -(-rows // TASK_ROWS)
    if cuts and tasks > slice_count(probes):  # a task sorts about as many rows however many there are; the pass and the table of slices share the shuffle
        both = both.repartition(tasks, *on, "__slot")
    upto = (Window.partitionBy(*on, "__slot").orderBy("__n", "__side")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = both.withColumn("__found", F.last("__row", ignorenulls=True).over(upto)).filter(F.col("__side") == first)
    if not cuts:  # one slice: nothing is carried
        return inner.select(*on, F.col("__t").alias(left_time), F.col("__found").alias("found"))
    slots = both.groupBy(*on, "__slot").agg(F.max_by("__row", F.when(F.col("__side") == second, F.struct("__n"))).alias("__row"))
    before = Window.partitionBy(*(on or [F.lit(0)])).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select(*on, "__slot", F.last("__row", ignorenulls=True).over(before).alias("__carried"))
    return (inner.join(carried, [*on, "__slot"], "left")
            .select(*on, F.col("__t").alias(left_time), F.coalesce("__found", "__carried").alias("found")))


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
              columns: Sequence[str], strict: bool = False, slices: int | None = None) -> DataFrame:
    """Adds to each left row the columns of the latest right row of its key; see ``asof_lookup``."""
    if slices == 1:
        return _one_pass(left, right, on, left_time, right_time, columns, strict)
    found = asof_lookup(left, right, on, left_time, right_time, columns, strict, slices)
    return left.join(found, [*on, left_time], "left").select(
        *left.columns, *[F.col(f"found.{c}").alias(c) for c in columns])


def _one_pass(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, columns: Sequence[str],
              strict: bool) -> DataFrame:
    """The same in one ordered pass per key over the rows of both sides, nothing measured and nothing joined back."""
    asked = left.select(*on, F.col(left_time).alias("__t"), F.lit(0 if strict else 1).alias("__side"), F.struct(*left.columns).alias("__left"))
    known = right.filter(F.col(right_time).isNotNull()).select(
        *on, F.col(right_time).alias("__t"), F.lit(1 if strict else 0).alias("__side"), F.struct(*columns).alias("__row"))
    both = asked.unionByName(known, allowMissingColumns=True)
    upto = Window.partitionBy(*(on or [F.lit(0)])).orderBy("__t", "__side", "__row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = F.lit(True)
    for k in on:
        named = named & F.col(k).isNotNull()
    found = both.withColumn("__found", F.when(named, F.last("__row", ignorenulls=True).over(upto))).filter(F.col("__left").isNotNull())
    return found.select("__left.*", *[F.col(f"__found.{c}").alias(c) for c in columns])


def role_intervals(roles: DataFrame, start: str = "effective_from") -> DataFrame:
    """Role rows with the date the next one takes effect and whether the champion changed.

    The role history is one row per promotion decision, so one ordered pass over it is small.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(start)
    return roles.withColumns({
        "effective_to": F.lead(start).over(order),
        "champion_changed": F.coalesce(F.lag("champion").over(order) != F.col("champion"), F.lit(True))})
