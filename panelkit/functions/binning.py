"""Bins from fitted edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "__MISSING__"


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def edge_labels(edges: Sequence[float]) -> list[str]:
    """Labels 'lo-hi'; from the second bin on the lower bound is the next integer."""
    whole = [int(e) for e in edges]
    return [f"{lo if i == 0 else lo + 1}-{hi}" for i, (lo, hi) in enumerate(zip(whole, whole[1:]))]


def labelled_bin(column, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """First bin closed on both sides, later bins open below; null outside or with fewer than two edges."""
    edges = sorted(set(edges))
    if len(edges) < 2:
        return F.lit(None).cast("string")
    column = _c(column)
    chain = F.when(column < F.lit(edges[0]), None)
    for upper, label in zip(edges[1:], labels or edge_labels(edges)):
        chain = chain.when(column <= F.lit(upper), label)
    return chain


def labelled_bin_by(column, edges: Column) -> Column:
    """The same with the edges in an array column: the bin is found by counting the edges below the value."""
    column, edges = _c(column), F.array_sort(F.array_distinct(edges))
    below = F.size(F.filter(edges, lambda e: e < column))
    at = F.greatest(below, F.lit(1))  # the first bin holds its lower edge too
    low, high = F.try_element_at(edges, at), F.try_element_at(edges, at + 1)
    label = F.concat((low.cast("long") + F.when(at > 1, 1).otherwise(0)).cast("string"), F.lit("-"), high.cast("long").cast("string"))
    return F.when((F.size(edges) >= 2) & (column >= F.try_element_at(edges, F.lit(1))) & high.isNotNull(), label)


def labelled_bin_at(column, edges: Column, labels: Column, most: int) -> Column:
    """The same with distinct edges in order, at most ``most``, and the labels of the bins between them, as ``edge_labels`` has them: a few
    comparisons in generated code, with nothing sorted or spelled for a row."""
    column = _c(column)
    below = sum((F.coalesce(F.try_element_at(edges, F.lit(i + 1)) < column, F.lit(False)).cast("int") for i in range(most)), F.lit(0))
    return F.when(column >= F.try_element_at(edges, F.lit(1)), F.try_element_at(labels, F.greatest(below, F.lit(1))))


def inner_edges(edges: Sequence[float]) -> list[float] | None:
    """Distinct edges without the outer two (those stand for minus and plus infinity); None below two edges."""
    distinct = sorted(set(edges))
    return distinct[1:-1] if len(distinct) >= 2 else None


def open_bin(column, inner: Sequence[float] | None) -> Column:
    """Right-closed bin number as text, a named bin for null; without edges the value itself."""
    column = _c(column)
    if inner is None:
        return F.coalesce(column.cast("string"), F.lit(MISSING))
    number = F.lit(0)
    for edge in inner:
        number = number + (column > F.lit(float(edge))).cast("int")
    return F.coalesce(number.cast("string"), F.lit(MISSING))


def open_bin_by(column, inner: Column, most: int | None = None) -> Column:
    """The same with the inner edges in an array column, null where there are none. ``most`` is the greatest number of edges, if it is known:
    then they are compared one by one in generated code, not by a function over the array."""
    column = _c(column)
    if most is None:
        number = F.size(F.filter(inner, lambda edge: column > edge))
    else:
        number = F.lit(0)
        for i in range(most):
            number = number + F.coalesce((column > F.get(inner, F.lit(i))).cast("int"), F.lit(0))
    return F.coalesce(F.when(inner.isNull() | column.isNull(), column.cast("string")).otherwise(number.cast("string")), F.lit(MISSING))


def level_bin(column) -> Column:
    """A category as its own bin, a named bin for null."""
    return F.coalesce(_c(column).cast("string"), F.lit(MISSING))
