"""Lookback features: aggregates of earlier events in windows before each label date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.asof import asof_join
from panelkit.operators.quantiles import located, ordered, picked
from panelkit.operators.ranking import distinct_values, packed, slice_edges
from panelkit.session import materialize

DAY = "1970-01-01"
#: Accuracy of the quantile sketch, and values of a window up to which it is exact however its parts were merged.
SKETCH, FEW = 10000, 4000


def _day(column: str) -> Column:
    return F.datediff(F.col(column), F.lit(DAY).cast("date"))


def pair_within(events: DataFrame, keys: DataFrame, on: Sequence[str], event_date: str, key_date: str,
                days: int) -> DataFrame:
    """Each event with every key date 1 to ``days`` days after it, and ``days_before``.

    The date condition is part of the equi-join: time is cut into slices as long as the window, and a key date
    looks only into its own slice and the one before. An event therefore meets only key dates near it, never
    all dates of its customer, and a busy customer is spread over time slices.
    """
    slot = F.floor(_day(key_date) / days)
    probes = keys.select(*on, key_date).distinct().select(
        *on, key_date, F.explode(F.array(slot, slot - 1)).alias("__slot"))
    facts = events.withColumn("__slot", F.floor(_day(event_date) / days))
    distance = F.datediff(F.col(key_date), F.col(event_date))
    return (facts.join(probes, [*on, "__slot"])
            .withColumn("days_before", distance)
            .filter(F.col("days_before").between(1, days)).drop("__slot"))


def daily_moments(events: DataFrame, on: Sequence[str], date: str, columns: Sequence[str]) -> DataFrame:
    """Per key and day: row count and, per column, count, mean, squared deviation, minimum and maximum."""
    stats = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        stats += [F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"),
                  (F.var_pop(c) * F.count(c)).alias(f"{c}__m2"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    return events.groupBy(*on, date).agg(*stats)


def _merged(column: str, inside: Column) -> dict[str, Column]:
    """Mean, extremes and sample deviation of a window from daily moments.

    The squared deviation is folded day by day with the pairwise update of mean and deviation, which stays exact for values far
    from zero; a key date has at most one row of moments for each day of the window.
    """
    n = F.when(inside, F.col(f"{column}__n"))
    total, count = F.sum(n * F.col(f"{column}__mean")), F.sum(n)
    days = F.collect_list(F.when(inside & (F.col(f"{column}__n") > 0), F.struct(
        F.col(f"{column}__n").cast("double").alias("n"), F.col(f"{column}__mean").cast("double").alias("mean"), F.col(f"{column}__m2").cast("double").alias("m2"))))

    def add(so_far: Column, day: Column) -> Column:
        both, apart = so_far["n"] + day["n"], day["mean"] - so_far["mean"]
        return F.struct(both.alias("n"), (so_far["mean"] + apart * day["n"] / both).alias("mean"),
                        (so_far["m2"] + day["m2"] + apart * apart * so_far["n"] * day["n"] / both).alias("m2"))

    zero = F.lit(0.0)
    squares = F.aggregate(days, F.struct(zero.alias("n"), zero.alias("mean"), zero.alias("m2")), add)["m2"]
    return {"mean": F.when(count > 0, total / count),
            "max": F.max(F.when(inside, F.col(f"{column}__max"))),
            "min": F.min(F.when(inside, F.col(f"{column}__min"))),
            "std": F.when(count > 1, F.sqrt(squares / (count - 1)))}


def _direct(column: str, inside: Column) -> dict[str, Column]:
    value = F.when(inside, F.col(column))
    return {"mean": F.avg(value), "max": F.max(value), "min": F.min(value), "std": F.stddev_samp(value)}


def window_medians(events: DataFrame, keys: DataFrame, on: Sequence[str], event_date: str, key_date: str, columns: Sequence[str], windows: Sequence[int],
                   edges: dict[str, list[float]] | None = None) -> DataFrame:
    """Discrete medians of the windows before each key date, exact at every size: ``on``, ``key_date``, ``feature``, ``days``, ``value``.

    Events are reduced to counts per key, day, value slice and value. A key date first adds up the counts of its days' slices and
    finds the slice of each window in which the median lies; then only the values of those slices are paired with it and
    counted. A key with a third of all events has no group in one task: its values are divided by slice.
    """
    numbers = events.select(*on, event_date, *columns)
    edges = slice_edges(numbers, columns) if edges is None else edges
    daily = materialize(distinct_values(numbers, columns, [*on, event_date], edges=edges), "daily-values")
    reach, group = max(windows), [*on, key_date, "feature", "days"]
    inside = F.explode(F.filter(F.array(*map(F.lit, windows)), lambda w: F.col("days_before") <= w)).alias("days")
    per_slice = pair_within(daily.groupBy(*on, event_date, "feature", "slice").agg(F.sum("n").alias("n")), keys, on, event_date, key_date, reach)
    per_slice = per_slice.select(*on, key_date, "feature", "slice", "n", inside).groupBy(*group, "slice").agg(F.sum("n").alias("slice_n"))
    wanted = materialize(located(per_slice, group, [0.5], False).select("__k.*", "slice", "total", "offset", "ranks"), "median-slices")
    part = [*on, "feature", "slice"]
    pairs = pair_within(daily, wanted, part, event_date, key_date, reach).select(*part, key_date, "value", "n", inside)
    counts = pairs.join(wanted.select(*group, "slice"), [*group, "slice"], "left_semi").groupBy(*group, "slice", "value").agg(F.sum("n").alias("n"))
    needed = wanted.select(packed(group).alias("__k"), "slice", "total", "offset", "ranks")
    return picked(ordered(counts, needed, group), group).select(*group, "value")


def _with_exact_medians(table: DataFrame, events: DataFrame, keys: DataFrame, on: Sequence[str], event_date: str, key_date: str,
                        middle: Sequence[tuple[str, int]], few: int) -> DataFrame:
    """The table with the medians of those keys put right that have over ``few`` events, so that a window of theirs may hold more."""
    many = materialize(events.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > few).select(*on), "busy-keys")
    if not many.limit(1).count():
        return table if few else table.withColumns({f"{c}_median_{w}d": F.lit(None).cast("double") for c, w in middle})
    busy = keys.select(*on, key_date).join(many, list(on), "left_semi").distinct()
    found = window_medians(events, busy, on, event_date, key_date, list(dict.fromkeys(c for c, _ in middle)), sorted({w for _, w in middle}))
    exact = {(c, w): F.max(F.when((F.col("feature") == c) & (F.col("days") == w), F.col("value"))).alias(f"__m_{c}_{w}") for c, w in middle}
    wide = busy.withColumn("__busy", F.lit(True)).join(found.groupBy(*on, key_date).agg(*exact.values()), [*on, key_date], "left")
    made = table.join(wide, [*on, key_date], "left")
    return made.withColumns({f"{c}_median_{w}d": F.when(F.col("__busy"), F.col(f"__m_{c}_{w}")).otherwise(
        F.col(f"{c}_median_{w}d") if few else F.lit(None)) for c, w in middle}).drop("__busy", *[f"__m_{c}_{w}" for c, w in middle])


def lookback(events: DataFrame, keys: DataFrame, on: Sequence[str], event_date: str, key_date: str,
             columns: Sequence[str], windows: Sequence[int] = (30, 60, 90),
             stats: Sequence[str] = ("mean", "max", "min", "std"), counts: bool = True, trend: int | None = 30,
             latest: bool = False, keep: Sequence[str] | None = None, dedupe: bool = True,
             empty_count_zero: bool = False, rollup: bool = False, few: int = FEW) -> DataFrame:
    """All windows, statistics, counts and trends of every key date in one aggregation.

    Rows on the key date itself are excluded. With ``rollup`` events are first reduced to one row of moments per key and day,
    so that a busy key does not multiply its events by the key dates near them; a panel with about one row per key and day
    is better joined as it is, as moments are wider than values. Both ways give the same numbers. ``trend`` d is the mean
    of days 1..d minus the mean of days d+1..2d. ``keep`` limits the output to named features; only
    the columns and statistics they need are computed. A key date without any event in the longest window
    has no output row unless ``latest`` finds an older event.

    Medians are the discrete ones. Those of keys with at most ``few`` events come from the same aggregation, where they are exact; key
    dates of busier keys are looked up by ``window_medians``.
    """
    wanted = set(keep) if keep else None
    raw = not rollup
    if dedupe:
        events = events.dropDuplicates()
    middle = [(c, w) for w in windows for c in columns if "median" in stats and (wanted is None or f"{c}_median_{w}d" in wanted)]
    source = events if raw else daily_moments(events, on, event_date, columns)
    reach = max([*windows, 2 * trend if trend else 0])
    pairs = pair_within(source, keys, on, event_date, key_date, reach)
    before = F.col("days_before")
    out: dict[str, Column] = {}
    for w in windows:
        for c in columns:
            made = (_direct if raw else _merged)(c, before <= w)
            out.update({f"{c}_{s}_{w}d": made[s] for s in stats if s != "median"})
        if counts:
            rows = F.count(F.when(before <= w, 1)) if raw else F.sum(F.when(before <= w, F.col("rows")))
            out[f"click_count_{w}d"] = F.coalesce(rows, F.lit(0)) if empty_count_zero else F.when(rows > 0, rows)
    if trend:
        for c in columns:
            make = _direct if raw else _merged
            out[f"{c}_trend_{trend}d"] = (make(c, before <= trend)["mean"]
                                          - make(c, before.between(trend + 1, 2 * trend))["mean"])
    if wanted is not None:
        out = {k: v for k, v in out.items() if k in wanted}
    if middle and raw:  # exact while a window has at most as many values as the sketch keeps
        out.update({f"{c}_median_{w}d": F.percentile_approx(F.when(before <= w, F.col(c)), 0.5, SKETCH) for c, w in middle})
    elif middle:
        out["__rows"] = F.sum("rows")
    if latest and not out:
        return latest_before(events, keys, on, event_date, key_date, columns)
    table = pairs.groupBy(*on, key_date).agg(*[v.alias(k) for k, v in out.items()])
    if middle:
        table = _with_exact_medians(table, events, keys, on, event_date, key_date, middle, few if raw else 0).drop("__rows")
    if not latest:
        return table
    last = latest_before(events, keys, on, event_date, key_date, columns)
    return last.join(table, [*on, key_date], "full_outer")


def latest_before(events: DataFrame, keys: DataFrame, on: Sequence[str], event_date: str, key_date: str,
                  columns: Sequence[str]) -> DataFrame:
    """Values of the last event strictly before each key date; key dates without one are left out."""
    probes = keys.select(*on, key_date).distinct()
    found = asof_join(probes, events, on, key_date, event_date, [event_date, *columns], strict=True)
    return (found.filter(F.col(event_date).isNotNull())
            .select(*on, key_date, *[F.col(c).alias(f"{c}_latest") for c in columns]))


def history_mean(events: DataFrame, keys: DataFrame, on: Sequence[str], event_date: str, key_date: str,
                 columns: Sequence[str]) -> DataFrame:
    """Mean of all events strictly before each key date, from running daily totals: no pairs are formed.

    A key has at most one row per day on either side, so its ordered pass is bounded by the calendar.
    """
    daily = events.groupBy(*on, F.col(event_date).alias("__d")).agg(
        *[F.sum(c).alias(f"{c}__s") for c in columns], *[F.count(c).alias(f"{c}__n") for c in columns],
        F.count(F.lit(1)).alias("__rows")).withColumn("__probe", F.lit(False))
    probes = keys.select(*on, F.col(key_date).alias("__d")).distinct().withColumn("__probe", F.lit(True))
    both = daily.unionByName(probes, allowMissingColumns=True).withColumn("__d", _day("__d"))
    before = Window.partitionBy(*on).orderBy("__d").rangeBetween(Window.unboundedPreceding, -1)
    out = both.withColumns({f"{c}_hist_mean": F.try_divide(F.sum(f"{c}__s").over(before), F.sum(f"{c}__n").over(before))
                            for c in columns} | {"__seen": F.sum("__rows").over(before)})
    return (out.filter(F.col("__probe") & (F.col("__seen") > 0))
            .select(*on, F.date_add(F.lit(DAY).cast("date"), F.col("__d")).alias(key_date),
                    *[f"{c}_hist_mean" for c in columns]))
