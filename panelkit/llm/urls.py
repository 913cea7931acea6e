"""URL parts and canonical forms as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URL = r"^\s*(?:([A-Za-z][A-Za-z0-9+.-]*):)?//(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, group)


def host(url: Column) -> Column:
    """Host in lower case without a final dot; empty if the URL has none."""
    return F.regexp_replace(F.lower(part(url, 2)), r"\.$", "")


def path(url: Column) -> Column:
    """Path, at least a slash."""
    found = part(url, 4)
    return F.when(found == "", F.lit("/")).otherwise(found)


def canonical(url: Column) -> Column:
    """The same page's URLs in one form: no scheme, user, default port, fragment, final slash or www., host in lower case, parameters in
    order, without utm_*. Text that is no URL stands for itself, trimmed; null stays null."""
    port = part(url, 3)
    kept = F.array_join(F.array_sort(F.filter(F.split(part(url, 5), "&"), lambda p: (p != "") & ~p.startswith("utm_"))), "&")
    there = F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.when(port.isin("", "80", "443"), F.lit("")).otherwise(F.concat(F.lit(":"), port)),
                     F.regexp_replace(path(url), "/+$", ""), F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept)))
    return F.when(url.isNotNull(), F.when(host(url) == "", F.trim(url)).otherwise(there))
