"""Calendar expressions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def month_start(column) -> Column:
    """First day of the month of a date."""
    return F.trunc(_c(column), "MM")


def calendar_months(later, earlier) -> Column:
    """Whole calendar months between two dates; the day of the month does not matter."""
    later, earlier = _c(later), _c(earlier)
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def month_spine(bounds: DataFrame, start: str, end: str, out: str = "month", truncate: bool = True) -> DataFrame:
    """Every first-of-month between the bounds, inclusive, per row of ``bounds``.

    With ``truncate`` the start is moved back to its month start; otherwise the first
    listed month is the first month start not before it.
    """
    first = month_start(start)
    if not truncate:
        first = F.when(F.col(start) == first, first).otherwise(F.add_months(first, 1))
    end_col = F.col(end).cast("date")
    months = F.when(first <= end_col, F.sequence(first, end_col, F.expr("interval 1 month")))
    return bounds.select(*[c for c in bounds.columns if c not in (start, end)], F.explode(months).alias(out))


def months_back(day: dt.date, months: int) -> dt.date:
    """The date some calendar months earlier, clamped to the month's last day."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    last = (dt.date(year + (month == 11), (month + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(day.day, last))


@dataclass(frozen=True)
class Split:
    """One closed date window of a chronological split."""

    name: str
    start: dt.date
    end: dt.date


def split_windows(train_date: str, data_start: str = "2023-01-01", validation: int = 1, test: int = 2,
                  oot: int = 2) -> list[Split]:
    """Train, validation, test and out-of-time windows counted back from the training date."""
    one = dt.timedelta(days=1)
    cut = dt.date.fromisoformat(train_date)
    oot_start = months_back(cut, oot)
    test_end = oot_start - one
    test_start = months_back(test_end, test) + one
    valid_end = test_start - one
    valid_start = months_back(valid_end, validation) + one
    return [Split("train", dt.date.fromisoformat(data_start), valid_start - one),
            Split("validation", valid_start, valid_end),
            Split("test", test_start, test_end),
            Split("oot", oot_start, cut - one)]


def two_way_windows(data_start: str, train_end: str, unseen_start: str, data_end: str) -> list[Split]:
    """Older split: rows up to the training end, rows from the unseen start."""
    iso = dt.date.fromisoformat
    return [Split("train", iso(data_start), iso(train_end)), Split("unseen", iso(unseen_start), iso(data_end))]


def split_of(column, windows: list[Split]) -> Column:
    """Name of the window a date lies in, null outside all of them."""
    day = _c(column)
    chain = None
    for w in windows:
        inside = day.between(F.lit(w.start), F.lit(w.end))
        chain = F.when(inside, w.name) if chain is None else chain.when(inside, w.name)
    return chain


def in_windows(column, windows: list[Split]) -> Column:
    """Whether a date lies between the first and the last day of the windows: a plain range the scan can prune by."""
    return _c(column).between(F.lit(min(w.start for w in windows)), F.lit(max(w.end for w in windows)))


def in_window(column, windows: list[Split], name: str) -> Column:
    """Whether a date lies in the named window, as a plain range."""
    return in_windows(column, [w for w in windows if w.name == name])
