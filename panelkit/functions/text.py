"""Cleaning of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip_underscores(column) -> Column:
    """Text without any underscore."""
    return F.translate(_c(column), "_", "")


def spell_undefined(column) -> Column:
    """Each underscore spelled out."""
    return F.regexp_replace(_c(column), "_", "Not Defined")


def clean_list(column, missing: str = "Not Specified") -> Column:
    """Comma list without ' and ' and without blanks around commas; a missing list gets a name."""
    joined = F.regexp_replace(F.coalesce(_c(column), F.lit(missing)), r"\s+and\s+", "")
    return F.trim(F.regexp_replace(joined, r"\s*,\s*", ","))


def replace_token(column, token: str, value: str) -> Column:
    """A placeholder value replaced."""
    column = _c(column)
    return F.when(column == token, value).otherwise(column)


def years_of(column) -> Column:
    """'X Years and Y Months' as years; null when a part is missing."""
    column = _c(column)
    years = F.regexp_extract(column, r"(\d+)\s+Years?", 1).try_cast("double")
    months = F.regexp_extract(column, r"(\d+)\s+Months?", 1).try_cast("double")
    return years + months / 12


def blank_to(column, value: str = "Unknown") -> Column:
    """Empty or missing text replaced."""
    column = _c(column)
    return F.when(column != "", column).otherwise(F.lit(value))


def column_name(text: str) -> str:
    """A category as part of a column name."""
    return text.replace(" ", "_").replace("-", "_")


def feature_stem(column, pattern: str = r"(fe_\d+)") -> Column:
    """The part of a feature name that matches a pattern."""
    return F.regexp_extract(_c(column), pattern, 1)
