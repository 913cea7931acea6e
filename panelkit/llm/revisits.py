"""WARC revisits: a not-modified capture takes its body from the latest earlier full response of the same canonical URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelkit.llm.urls import canonical
from panelkit.operators.ranking import slice_count, with_slices
from panelkit.session import materialize

#: Headers of a not-modified answer that replace stored ones (RFC 9110, section 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def lower_names(headers: Column) -> Column:
    """Headers with names in lower case; of names that become equal the last value stays; null maps are empty."""
    entries = F.transform(F.map_entries(F.coalesce(headers, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))),
                          lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    later = lambda i: F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1)))
    return F.map_from_entries(F.filter(entries, lambda e, i: ~F.exists(later(i), lambda o: o["key"] == e["key"])))


def merged_headers(stored: Column, told: Column) -> Column:
    """The stored headers, with the permitted ones of the not-modified answer in place of or beside them."""
    fresh = F.map_filter(told, lambda k, v: k.isin(*PERMITTED))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(fresh, k)), fresh)


def resolve_revisits(records: DataFrame, slices: int | None = None) -> DataFrame:
    """One row per revisit record: ``record_id``, ``canonical_url``, ``fetched_at``, ``outcome``, ``source_id`` (the response that answers it),
    ``headers`` (the response's, with the permitted ones of the revisit) and ``payload`` (the response's).

    ``records`` has ``record_id``, ``kind`` (``response`` or ``revisit``), ``url``, ``fetched_at``, ``headers`` (map of text) and ``payload``.
    The response is the latest strictly earlier one of the canonical URL, of equal times the greatest record id. Validators
    are compared in this order, the first that both have decides: etag (weak marks ignored), last-modified, and the revisit's
    ``x-payload-sha256`` with the payload's digest. Outcomes: ``resolved``, ``changed`` (a validator differs), ``unproven`` (none in
    common) and ``missing`` (no earlier response, or no url or time); only ``resolved`` rows have headers and payload. Header names
    are matched in lower case. Repeated revisits are resolved each for itself, repeated responses count as one; responses
    without id, url or time are no source; other columns are ignored; an empty table gives no rows.

    As-of join in two steps, so that a URL with a third of all captures is not one task: inside slices of time by a running
    last value, and across slices over one row for each URL and slice. Slices are cut at quantiles of the capture times, so they
    hold about the same number of records even if all come within days. Revisits without url or time don't take part; they are
    ``missing``. Payloads and stored headers take no part either; they are joined to the answers found. Only responses that
    were recorded twice are brought together before that join, so that it can split a response that answers a third of all revisits.
    """
    rows = records.select("record_id", "kind", canonical(F.col("url")).alias("canonical_url"), F.col("fetched_at").cast("timestamp").alias("fetched_at"),
                          lower_names(F.col("headers")).alias("headers"), "payload")
    told = F.col("kind") == "revisit"
    named = lambda name: F.try_element_at("headers", F.lit(name))
    rows = (rows.withColumn("etag", F.regexp_replace(named("etag"), "^W/", "")).withColumn("modified", named("last-modified"))
            .withColumn("digest", F.when(told, named("x-payload-sha256")).otherwise(F.sha2("payload", 256))).withColumn("at", F.unix_micros("fetched_at")))
    key = F.struct("at", "record_id", "canonical_url", "etag", "modified", "digest")
    placed = F.col("canonical_url").isNotNull() & F.col("at").isNotNull()
    full = (F.col("kind") == "response") & F.col("record_id").isNotNull() & placed
    n = slices or slice_count(records)
    cuts = records.select(F.unix_micros(F.col("fetched_at").cast("timestamp")).alias("at")).agg(F.percentile_approx("at", F.array(*[F.lit(i / n) for i in range(1, n)]), 4 * n)).first()[0] if n > 1 else []
    known = rows.filter((told & placed) | full).select("record_id", "canonical_url", "fetched_at", F.col("at").cast("double").alias("at"), "kind", "etag", "modified", "digest",
                                                       F.when(told, F.col("headers")).alias("told"), F.when(full, key).alias("source"))
    known = with_slices(known, {"at": sorted(set(float(c) for c in cuts or []))}).withColumnRenamed("at__slice", "slice")
    inside = Window.partitionBy("canonical_url", "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = (known.groupBy("canonical_url", "slice").agg(F.max("source").alias("source"))
            .select(F.col("canonical_url").alias("end_url"), F.col("slice").alias("end_slice"), F.last("source", ignorenulls=True).over(across).alias("before")))
    found = known.withColumn("here", F.max("source").over(inside)).filter(told).join(
        ends, (F.col("canonical_url") == F.col("end_url")) & (F.col("slice") == F.col("end_slice")), "left").withColumn("answer", F.coalesce("here", "before"))
    same = F.coalesce(F.col("etag") == F.col("answer.etag"), F.col("modified") == F.col("answer.modified"), F.col("digest") == F.col("answer.digest"))
    outcome = F.when(F.col("answer").isNull(), "missing").when(same, "resolved").when(same.isNull(), "unproven").otherwise("changed")
    # a revisit without body asks for one that isn't there, under its own id, so that these don't meet in one task
    none = F.struct(*[(F.col("record_id") if f.name == "record_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.select(key.alias("k")).schema["k"].dataType])
    found = found.select("record_id", "canonical_url", "fetched_at", outcome.alias("outcome"), F.col("answer.record_id").alias("source_id"), "told",
                         F.when(outcome == "resolved", F.col("answer")).otherwise(none).alias("answer"))
    stored = rows.filter(full).select(key.alias("of"), F.struct(F.col("headers").alias("stored"), "payload").alias("body"))
    again = F.struct("record_id", F.col("fetched_at").cast("timestamp"))  # responses recorded twice agree in these at least
    twice = materialize(records.filter("kind = 'response'").groupBy(again.alias("again")).count().filter("count > 1").select("again"), "repeated")
    if twice.limit(1).count():
        same_record = F.struct("of.record_id", F.timestamp_micros("of.at")) == F.col("again")
        stored = stored.join(twice, same_record, "left_anti").unionByName(
            stored.join(twice, same_record, "left_semi").groupBy("of").agg(F.max_by("body", F.length("body.payload")).alias("body")))
    answered = found.join(stored, F.col("answer") == F.col("of"), "left").select(
        "record_id", "canonical_url", "fetched_at", "outcome", "source_id",
        F.when(F.col("of").isNotNull(), merged_headers(F.col("body.stored"), F.col("told"))).alias("headers"), F.col("body.payload").alias("payload"))
    nowhere = rows.filter(told & ~placed).select("record_id", "canonical_url", "fetched_at", F.lit("missing").alias("outcome"), *[
        F.lit(None).cast(answered.schema[c].dataType).alias(c) for c in ("source_id", "headers", "payload")])
    return answered.unionByName(nowhere)
