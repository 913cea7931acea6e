"""URL filters over time: dated list entries become validity intervals, and each capture is held against those active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelkit.llm.urls import host, path

#: Rules from the least to the most specific.
RULES = ("domain", "host", "prefix")
#: Days in a slice of time. An interval is listed under each slice that it touches up to the last capture.
SLICE_DAYS = 64


def intervals(entries: DataFrame) -> DataFrame:
    """``rule``, ``value``, ``action``, ``since`` and ``until`` (null: still valid) from entries ``rule``, ``value``, ``action``, ``listed_at``.

    An entry holds until the next one of the same rule and value; of several at the same time ``block`` goes before ``allow`` and
    ``allow`` before others. Entries with action ``drop`` end the one before and mean nothing themselves. Values are lower-cased;
    rows with a null in any of the four columns, or an unknown rule, hold nothing.
    """
    rows = entries.select("rule", F.lower("value").alias("value"), "action", F.col("listed_at").cast("timestamp").alias("since")).dropna()
    rank = F.when(F.col("action") == "block", 2).when(F.col("action") == "allow", 1).otherwise(0)
    rows = (rows.filter(F.col("rule").isin(*RULES)).groupBy("rule", "value", "since")
            .agg(F.max(F.struct(rank.alias("rank"), "action"))["action"].alias("action")))
    until = F.lead("since").over(Window.partitionBy("rule", "value").orderBy("since"))
    return rows.withColumn("until", until).filter("action != 'drop'")


def rule_keys(url: Column) -> Column:
    """What a URL can be listed under: its host, the host's parent domains and itself as domains, and host with each leading part of
    the path. As many as the URL has labels and path segments."""
    name = host(url)
    labels, segments = F.split(name, r"\."), F.filter(F.split(F.lower(path(url)), "/"), lambda s: s != "")
    key = lambda rule, value, size: F.struct(F.lit(rule).alias("rule"), value.alias("value"), size.cast("int").alias("size"))
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda n: key("domain", F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."), n))
    prefixes = F.transform(F.sequence(F.lit(0), F.size(segments)),
                           lambda n: key("prefix", F.concat_ws("/", name, F.array_join(F.slice(segments, F.lit(1), n), "/")), n))
    return F.when(name != "", F.concat(F.array(key("host", name, F.lit(1))), domains, prefixes))


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "capture_id", url_col: str = "url", time_col: str = "fetched_at",
                slice_days: int = SLICE_DAYS) -> DataFrame:
    """One row per row of ``captures``: the id, url and time, ``decision`` (``allow`` if nothing active matches), and the ``rule``, ``value``
    and ``since`` of the entry that decided: a path prefix before a host before a domain, the longer prefix or domain first.

    Captures are exploded into the few keys they can be listed under and joined to intervals on key and slice of time, so of a
    value with a long history only the versions of that slice are met, and a host with a third of all captures is split by
    the join like any other skewed key. Equal captures (url and time) are decided once. Captures without url, host or time are
    allowed; repeated rows stay repeated; other columns are ignored; without entries all is allowed.
    """
    rows = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).cast("timestamp").alias("at"))
    slice_of = lambda t: F.floor(F.unix_timestamp(t) / F.lit(86400 * slice_days))
    asked = rows.filter("url is not null and at is not null").select("url", "at").distinct()
    keys = asked.select("url", "at", slice_of(F.col("at")).alias("slice"), F.explode(rule_keys(F.col("url"))).alias("key")).select(
        "url", "at", "slice", "key.*")
    last = asked.agg(F.max("at").alias("last"))
    held = intervals(entries).crossJoin(F.broadcast(last)).filter(F.col("since") <= F.col("last"))  # one row: the last capture's time
    listed = held.withColumn("slice", F.explode(F.sequence(slice_of(F.col("since")), slice_of(F.least(F.coalesce("until", "last"), F.col("last"))))))
    matches = keys.join(listed, ["rule", "value", "slice"]).filter((F.col("since") <= F.col("at")) & (F.col("until").isNull() | (F.col("at") < F.col("until"))))
    weight = F.element_at(F.create_map(*[x for k, rule in enumerate(RULES) for x in (F.lit(rule), F.lit(k))]), F.col("rule"))
    best = matches.groupBy("url", "at").agg(F.max(F.struct(weight.alias("weight"), "size", "rule", "value", "action", "since")).alias("best"))
    return rows.join(best, ["url", "at"], "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("at").alias(time_col), F.coalesce("best.action", F.lit("allow")).alias("decision"),
        F.col("best.rule").alias("rule"), F.col("best.value").alias("value"), F.col("best.since").alias("since"))
