"""Null-safe arithmetic, clipping, rule cleaning and status expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


# Cleaning rules, a value that meets its rule is a placeholder or impossible.
INVALID_RULES = {
    "Interest_Rate": (">", 50),
    "Num_Credit_Inquiries": (">", 30),
    "Num_of_Delayed_Payment": (">", 50),
    "Monthly_Balance": ("abs>", 1e9),
    "Amount_invested_monthly": ("==", 10000),
}
NON_NEGATIVE = ["Num_of_Delayed_Payment", "Num_Credit_Inquiries", "Delayed_Payments_per_Card", "Num_of_Loan_Cleaned"]


def within(column, low, high) -> Column:
    """The value inside a closed range, else null."""
    column = _c(column)
    return F.when(column.between(low, high), column)


def breaks_rule(column, op: str, limit) -> Column:
    """Whether a value meets an invalid-value rule; false for null."""
    column = _c(column)
    tests = {">": column > limit, ">=": column >= limit, "<": column < limit, "<=": column <= limit,
             "==": column == limit, "abs>": F.abs(column) > limit}
    return F.coalesce(tests[op], F.lit(False))


def apply_rules(rules: Mapping[str, tuple[str, float]]) -> dict[str, Column]:
    """Each ruled column with its invalid values nulled."""
    return {c: F.when(~breaks_rule(c, op, v), F.col(c)) for c, (op, v) in rules.items()}


def rule_hits(rules: Mapping[str, tuple[str, float]]) -> list[Column]:
    """Per rule the number of rows it nulls."""
    return [F.count(F.when(breaks_rule(c, op, v), 1)).alias(c) for c, (op, v) in rules.items()]


def at_least(column, low=0) -> Column:
    """Clip from below; null stays null (greatest alone would turn it into the bound)."""
    column = _c(column)
    return F.when(column.isNotNull(), F.greatest(column, F.lit(low)))


def clip(column, low, high) -> Column:
    """Clip on both sides; null stays null."""
    column = _c(column)
    return F.when(column.isNotNull(), F.least(F.greatest(column, F.lit(low)), F.lit(high)))


def log1p_floor(column) -> Column:
    """log(1 + x) with negatives taken as zero."""
    return F.log1p(at_least(_c(column).cast("double"), 0.0))


def signed_log(column) -> Column:
    """sign(x) * log(1 + |x|)."""
    column = _c(column).cast("double")
    return F.signum(column) * F.log1p(F.abs(column))


def ratio(num, den) -> Column:
    """num / den, null when the denominator is zero or missing."""
    num, den = _c(num).cast("double"), _c(den).cast("double")
    return F.when(den != 0, num / den)


def round_half_up(column) -> Column:
    """Rounded half away from zero, as an integer."""
    return F.round(_c(column).cast("double")).cast("int")


def first_method(steps: Sequence[tuple[Column, str]], default: str) -> Column:
    """Name of the first step whose condition holds."""
    chain = None
    for condition, name in steps:
        chain = F.when(condition, name) if chain is None else chain.when(condition, name)
    return chain.otherwise(default)


def status(column, watch: float, alert: float, missing: str = "n/a") -> Column:
    """ok, watch or alert by two strict thresholds."""
    column = _c(column)
    return (F.when(column.isNull(), missing).when(column > alert, "alert")
            .when(column > watch, "watch").otherwise("ok"))


# Severity order of monitoring states, mildest first.
SEVERITY = ["ok", "n/a", "no labels yet", "watch", "alert"]


def worst_status(*columns) -> Column:
    """The most severe of several states."""
    rank = F.greatest(*[F.array_position(F.array(*map(F.lit, SEVERITY)), _c(c)) for c in columns])
    return F.element_at(F.array(*map(F.lit, SEVERITY)), rank.cast("int"))


def map_codes(column, codes: Mapping[str, str]) -> Column:
    """Codes replaced by labels; null for a code not listed."""
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _c(column))
