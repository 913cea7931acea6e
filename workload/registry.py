"""Query registry. ``@name`` in SQL stands for the common table expression of a derived view."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.views import cte

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = re.sub(r"@\w+(?:,\s*@\w+)*", lambda m: cte(*re.findall(r"\w+", m.group(0))), sql)
        return fn
    return add
