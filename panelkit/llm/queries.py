"""One query for each operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from panelkit.llm.bpe import encode_decode_bpe, load_byte_pairs
from panelkit.llm.chat import format_paths, read_back, threads
from panelkit.llm.decontaminate import contamination
from panelkit.llm.fingerprints import fingerprints
from panelkit.llm.langid import predict_language, train_language_model
from panelkit.llm.periodic import periodic_runs
from panelkit.llm.pieces import encode_decode, load_vocabulary
from panelkit.llm.revisits import resolve_revisits
from panelkit.llm.simhash import simhash_groups
from panelkit.llm.substring import remove_repeats
from panelkit.llm.toxicity import score_toxicity, train_toxicity_model
from panelkit.llm.urlfilter import filter_urls
from panelkit.llm.urls import host, path
from panelkit.llm.whitening import fit_whitening, identity_error, whiten, whole_vectors

MODEL_FILE = corpus_pipeline.MODEL_FILE
#: Where the byte-level tokenizer's file lies; it is read on the driver and never copied.
BYTE_PAIRS_FILE = "/opt/tokenizers/byte_bpe_50k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(by: int):
    return F.crc32(F.col("doc_id").cast("string")) % by


OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 33, 1)::BIGINT)) AS p FROM w),
h AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 34], ' ')) AS m FROM s),
d AS (SELECT m FROM h GROUP BY m HAVING count(*) > 1),
g AS (SELECT doc_id, list(p ORDER BY p) AS ps FROM h WHERE m IN (SELECT m FROM d) GROUP BY doc_id),
r AS (SELECT doc_id, list_distinct(flatten(list_transform(ps, lambda p: range(p, p + 35)))) AS gone FROM g),
k AS (SELECT w.doc_id, len(ws) AS n, ws, coalesce(gone, []) AS gone FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
x AS (SELECT doc_id, n, len(gone) AS n_gone, [ws[i] for i in range(1, n + 1) if NOT list_contains(gone, i)] AS kept FROM k)
SELECT doc_id, n::BIGINT AS n_words, n_gone::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM x
"""


@query("op1_substring_dedup", OP1_SQL)
def op1(spark, sf_dir):
    found = remove_repeats(_table(spark, sf_dir, "documents"), 35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_sentencepiece")
def op2(spark, sf_dir):
    return encode_decode(_table(spark, sf_dir, "documents"), load_vocabulary(MODEL_FILE)).select(
        "doc_id", "n_pieces", "pieces", F.sha2("decoded", 256).alias("decoded_sha256"), "lossless")


@query("op3_toxicity")
def op3(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = train_toxicity_model(docs, labels.filter(_remainder(5) != 0), required=False)
    return score_toxicity(docs, model).select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op4_fingerprints")
def op4(spark, sf_dir):
    return fingerprints(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query("op5_simhash")
def op5(spark, sf_dir):
    return simhash_groups(_table(spark, sf_dir, "documents"), size=4, distance=4)


OP6_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bs AS (SELECT item, ws, least(10, len(ws)) AS k, unnest(range(1, greatest(len(ws) - 8, 2)::BIGINT)) AS p FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item, k, array_to_string(ws[p:p + k - 1], ' ') AS s FROM bs),
ks AS (SELECT DISTINCT k FROM bw),
ds AS (SELECT doc_id, ws, k, unnest(range(1, greatest(len(ws) - k + 2, 1)::BIGINT)) AS p FROM w CROSS JOIN ks),
dw AS (SELECT doc_id, k, p, array_to_string(ws[p:p + k - 1], ' ') AS s FROM ds),
m AS (SELECT dw.doc_id, dw.k, dw.p, bw.item FROM dw JOIN bw ON dw.k = bw.k AND dw.s = bw.s),
c AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS i FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c ON w.doc_id = c.doc_id LEFT JOIN t ON w.doc_id = t.doc_id
"""


@query("op6_decontaminate", OP6_SQL)
def op6(spark, sf_dir):
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def captures_of(pages: DataFrame) -> DataFrame:
    """Each page as a capture at a time that follows from its id."""
    days, seconds = (F.col("page_id") * 7919) % 730, F.col("page_id") % 86400
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1704067200) + days * 86400 + seconds).alias("fetched_at"))


def lists_of(pages: DataFrame) -> DataFrame:
    """Dated list entries for the hosts, domains and leading path segments that occur in pages: blocked, some allowed, some dropped later."""
    seen = pages.select("page_id", host(F.col("url")).alias("host"), F.regexp_extract(path(F.col("url")), "^/([^/]+)", 1).alias("segment")).filter("host != ''")
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    names = seen.select("page_id", F.explode(F.array(
        F.struct(F.lit("host").alias("rule"), F.col("host").alias("value")), F.struct(F.lit("domain").alias("rule"), domain.alias("value")),
        F.struct(F.lit("prefix").alias("rule"), F.concat_ws("/", "host", F.lower("segment")).alias("value")))).alias("k")).select("page_id", "k.*")
    spans = names.filter("value != ''").groupBy("rule", "value").agg(F.min("page_id").alias("a"), F.max("page_id").alias("b"), F.count("*").alias("n"))
    day = lambda d: F.timestamp_seconds(F.lit(1704067200) + d * 86400)
    action = F.when(F.col("rule") == "domain", "allow").otherwise("block")
    entries = F.array(F.struct(action.alias("action"), day(F.col("a") % 400).alias("listed_at")),
                      F.struct(F.when(F.col("n") % 2 == 0, "allow").otherwise("drop").alias("action"), day(F.col("a") % 400 + F.col("b") % 300 + 1).alias("listed_at")),
                      F.struct(F.lit("block").alias("action"), day(F.col("a") % 400 + F.col("b") % 300 + F.col("n") % 100 + 20).alias("listed_at")))
    return spans.select("rule", "value", F.explode(entries).alias("e")).select("rule", "value", "e.*")


OP7_SQL = r"""
WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host,
                  regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
                  epoch_ms((1704067200 + (page_id * 7919 % 730) * 86400 + page_id % 86400) * 1000) AS tm FROM pages),
n AS (SELECT page_id, 'host' AS rule, host AS value FROM p UNION ALL
      SELECT page_id, 'domain', regexp_extract(host, '([^.]+\.[^.]+)$', 1) FROM p UNION ALL
      SELECT page_id, 'prefix', host || '/' || lower(regexp_extract(path, '^/([^/]+)', 1)) FROM p),
s AS (SELECT rule, value, min(page_id) AS a, max(page_id) AS b, count(*) AS n FROM n WHERE value <> '' GROUP BY ALL),
e AS (SELECT rule, value, CASE WHEN rule = 'domain' THEN 'allow' ELSE 'block' END AS action, a % 400 AS d FROM s UNION ALL
      SELECT rule, value, CASE WHEN n % 2 = 0 THEN 'allow' ELSE 'drop' END, a % 400 + b % 300 + 1 FROM s UNION ALL
      SELECT rule, value, 'block', a % 400 + b % 300 + n % 100 + 20 FROM s),
i AS (SELECT rule, value, action, epoch_ms((1704067200 + d * 86400) * 1000) AS since,
             epoch_ms((1704067200 + lead(d) OVER (PARTITION BY rule, value ORDER BY d) * 86400) * 1000) AS until FROM e),
g AS (SELECT page_id, tm, host, string_split(host, '.') AS l, list_filter(string_split(lower(path), '/'), lambda x: x <> '') AS q FROM p),
k AS (SELECT page_id, tm, 'host' AS rule, host AS value, 1 AS size FROM g UNION ALL
      SELECT page_id, tm, 'domain', array_to_string(l[len(l) - x + 1:], '.'), x FROM (SELECT *, unnest(range(1, len(l) + 1)) AS x FROM g) UNION ALL
      SELECT page_id, tm, 'prefix', host || '/' || coalesce(array_to_string(q[1:x], '/'), ''), x FROM (SELECT *, unnest(range(0, len(q) + 1)) AS x FROM g)),
m AS (SELECT k.page_id, i.*, row_number() OVER (PARTITION BY k.page_id ORDER BY CASE k.rule WHEN 'prefix' THEN 0 WHEN 'host' THEN 1 ELSE 2 END, size DESC) AS r
      FROM k JOIN i ON k.rule = i.rule AND k.value = i.value AND i.since <= k.tm AND (i.until IS NULL OR k.tm < i.until) WHERE i.action <> 'drop')
SELECT p.page_id, coalesce(m.action, 'allow') AS decision, m.rule, m.value, CAST(epoch(m.since) AS BIGINT) AS since_epoch
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.r = 1
"""


@query("op7_url_filter", OP7_SQL)
def op7(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(captures_of(pages), lists_of(pages), "page_id").select(
        "page_id", "decision", "rule", "value", F.unix_timestamp("since").alias("since_epoch"))


def records_of(pages: DataFrame) -> DataFrame:
    """Each page as a full response, and a later not-modified capture of it under another form of its URL. Validators follow from the page
    that the id names, so a revisit is of the page's own body unless another page of the URL came between."""
    day = lambda d: F.timestamp_seconds(F.lit(1704067200) + d * 86400 + F.col("page_id") % 86400)
    at, again = (F.col("page_id") * 7919) % 365, (F.col("page_id") * 7919) % 365 + (F.col("page_id") % 200) - 5
    text = lambda c: c.cast("string")
    modified = F.concat(F.lit("v"), text(F.length("html") % 1000))
    etag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    kind = F.col("page_id") % 4
    first = F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), text(at), F.lit("Last-Modified"), modified,
                         F.when(kind < 2, "ETag").otherwise("X-Served-By"), etag, F.lit("Cache-Control"), F.lit("max-age=60"))
    # 0: weak etag; 1: a changed etag; 2: last-modified; 3: the digest
    then = F.create_map(F.lit("Content-Type"), F.lit("text/plain"), F.lit("Date"), text(again), F.lit("Cache-Control"), F.lit("max-age=3600"),
                        F.when(kind < 2, "etag").when(kind == 2, "last-modified").otherwise("x-payload-sha256"),
                        F.when(kind == 0, F.concat(F.lit("W/"), etag)).when(kind == 1, F.lit('"other"')).when(kind == 2, modified).otherwise(F.sha2("html", 256)))
    other = F.concat(F.regexp_replace("url", "^https?://", "HTTP://"), F.lit("#again"))
    kinds = F.array(F.struct(F.lit("response").alias("kind"), F.col("url"), day(at).alias("fetched_at"), first.alias("headers"), F.col("html").alias("payload")),
                    F.struct(F.lit("revisit").alias("kind"), other.alias("url"), day(again).alias("fetched_at"), then.alias("headers"),
                             F.lit(None).cast("string").alias("payload")))
    return pages.select(F.col("page_id").alias("record_id"), F.explode(kinds).alias("k")).select("record_id", "k.*")


OP8_SQL = r"""
WITH p AS (SELECT page_id, html, md5(html) AS tag, 'v' || length(html) % 1000 AS modified, sha256(html) AS digest, page_id % 4 AS kind,
             1704067200 + (page_id * 7919 % 365) * 86400 + page_id % 86400 AS tm,
             1704067200 + (page_id * 7919 % 365 + page_id % 200 - 5) * 86400 + page_id % 86400 AS again,
             page_id * 7919 % 365 AS d1, page_id * 7919 % 365 + page_id % 200 - 5 AS d2,
             regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)), '^www\.', '') AS host,
             regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/+$', '') AS path,
             array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
                             lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), '&') AS q FROM pages),
c AS (SELECT *, host || path || CASE WHEN coalesce(q, '') = '' THEN '' ELSE '?' || q END AS canonical_url FROM p),
j AS (SELECT r.page_id AS record_id, r.canonical_url, r.again, r.kind, r.tag, r.modified, r.digest, r.d2, s.page_id AS source_id, s.kind AS s_kind,
             s.tag AS s_tag, s.modified AS s_modified, s.digest AS s_digest, s.html, s.d1,
             row_number() OVER (PARTITION BY r.page_id ORDER BY s.tm DESC, s.page_id DESC) AS n
      FROM c r LEFT JOIN c s ON r.canonical_url = s.canonical_url AND s.tm < r.again),
k AS (SELECT *, CASE WHEN source_id IS NULL THEN 'missing'
                 WHEN kind IN (0, 1) AND s_kind < 2 THEN CASE WHEN kind = 0 AND tag = s_tag THEN 'resolved' ELSE 'changed' END
                 WHEN kind IN (0, 1) THEN 'unproven'
                 WHEN kind = 2 THEN CASE WHEN modified = s_modified THEN 'resolved' ELSE 'changed' END
                 WHEN digest = s_digest THEN 'resolved' ELSE 'changed' END AS outcome FROM j WHERE n = 1)
SELECT record_id, canonical_url, CAST(again AS BIGINT) AS fetched_epoch, outcome, source_id,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=3600;content-type=text/html;date=' || d2 ||
            CASE WHEN s_kind < 2 THEN ';etag=' || CASE WHEN kind = 0 THEN 'W/' ELSE '' END || '"' || s_tag || '"' ELSE '' END || ';last-modified=' || s_modified ||
            CASE WHEN s_kind < 2 THEN '' ELSE ';x-served-by="' || s_tag || '"' END END AS headers,
       CASE WHEN outcome = 'resolved' THEN s_digest END AS payload_sha256
FROM k
"""


@query("op8_revisits", OP8_SQL)
def op8(spark, sf_dir):
    found = resolve_revisits(records_of(_table(spark, sf_dir, "pages")))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return found.select("record_id", "canonical_url", F.unix_timestamp("fetched_at").alias("fetched_epoch"), "outcome", "source_id",
                        F.when(F.col("headers").isNotNull(), F.array_join(entries, ";")).alias("headers"), F.sha2("payload", 256).alias("payload_sha256"))


@query("op9_language_id")
def op9(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = train_language_model(docs.filter(_remainder(4) != 2), required=False)
    return predict_language(docs, model).select("doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op10_chat_format")
def op10(spark, sf_dir):
    said = r"\### Assistant: </turn> ok"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(format_paths(threads(turns.unionByName(extra)))).select(
        F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def repeated_on_purpose(docs: DataFrame) -> DataFrame:
    """Documents of which about a tenth, told by a hash of the id, repeat a stretch of their words from one place to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("words")
    docs = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    docs = docs.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", F.floor((n - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    head, unit = F.slice("words", F.lit(1), F.col("a").cast("int")), F.slice("words", F.col("a").cast("int") + 1, F.col("p").cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - F.col("a")) / F.col("p")).cast("int"))), F.lit(1), (n - F.col("a")).cast("int"))
    return docs.select("doc_id", F.when(n > 0, F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    found = periodic_runs(repeated_on_purpose(_table(spark, sf_dir, "documents")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    more = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    best = F.reduce("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), more)  # runs come by start and period
    found = found.withColumn("best", best)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_bpe")
def op12(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return encode_decode_bpe(docs, load_byte_pairs(BYTE_PAIRS_FILE)).select(
        "doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.sha2(F.translate(F.col("tokens").cast("string"), "[] ", ""), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_whitening")
def op13(spark, sf_dir):
    vectors = whole_vectors(_table(spark, sf_dir, "embeddings"))
    model = fit_whitening(vectors, 8)
    explained = F.element_at(F.array(*[F.lit(float(e / model.trace)) for e in model.values], F.lit(None).cast("double")), F.col("component"))
    return whiten(vectors, model).select(
        F.col("id").alias("vec_id"), "component", F.lit(model.n).cast("long").alias("n"), F.col("deviation").cast("long").alias("deviation"), "whitened",
        explained.alias("explained"), F.lit(identity_error(vectors, model)).alias("identity_error"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


__all__ = ["ORACLE", "QUERIES"]
