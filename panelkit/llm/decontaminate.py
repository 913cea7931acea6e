"""Benchmark decontamination: words of documents inside any occurrence of a benchmark window, by an FM-index per slice of text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.fmindex import FmIndex
from panelkit.llm.words import ALNUM, LOWER, find_words, hash_words, ranges, slices
from panelkit.session import materialize

#: Characters of benchmark text that are searched for in one pass over the documents; a larger benchmark takes more passes.
BLOCK_CHARS = 2 << 20
SHARD_BYTES = 4 << 20
#: Windows that are compared with their neighbours at once.
STEP = 1 << 16


def window_table(items: list[tuple[str, str]], window: int) -> dict:
    """Vocabulary (sorted word hashes, with a second hash for proof), distinct windows as word numbers (zeros behind shorter ones) and the
    items of each. Numbers only: a window costs four bytes a word, once more while equal ones are brought together."""
    encoded = [(text or "").encode() for _, text in items]
    data = LOWER[np.frombuffer(b"".join(encoded), dtype=np.uint8)]
    starts, ends, first = find_words(data, np.cumsum([0] + [len(x) for x in encoded]), ALNUM)
    vocabulary, place, number = np.unique(hash_words(data, starts, ends, 0), return_index=True, return_inverse=True)
    proof = hash_words(data, starts, ends, 1)[place]
    names = sorted({item for item, _ in items})
    code = np.searchsorted(names, [item for item, _ in items]) if items else np.zeros(0, dtype=np.int64)
    sizes = np.diff(first)
    windows = np.where(sizes > 0, np.maximum(sizes - window + 1, 1), 0)
    begin, owner = ranges(first[:-1], windows), np.repeat(np.arange(len(sizes)), windows)
    numbers = np.r_[number + 1, np.zeros(window, dtype=number.dtype)].astype(np.int32)
    words = np.empty((len(begin), window), dtype=np.int32)
    for k in range(window):
        words[:, k] = np.where(k < sizes[owner], numbers[begin + k], 0)
    order = np.lexsort(words.T[::-1])
    fresh = np.ones(len(order), dtype=bool)
    for at in range(1, len(order), STEP):  # neighbours in order, some at a time
        some = order[at - 1:at - 1 + STEP + 1]
        fresh[at:at + STEP] = (words[some[1:]] != words[some[:-1]]).any(axis=1)
    group = np.cumsum(fresh) - 1
    pairs = np.unique(group * max(len(names), 1) + code[owner[order]])
    patterns = words[order[fresh]].astype(np.int64)
    counts = np.bincount(pairs // max(len(names), 1), minlength=len(patterns))
    return {"vocabulary": vocabulary, "proof": proof, "patterns": patterns, "sizes": (patterns > 0).sum(axis=1), "names": names,
            "owner_first": np.r_[0, np.cumsum(counts)], "owners": pairs % max(len(names), 1)}


def _shard_hits(data: np.ndarray, offsets: np.ndarray, table: dict):
    """Words of one shard of documents: starts, ends, first word of each row, hit flags, and (row, item) pairs."""
    data = LOWER[data]
    starts, ends, first = find_words(data, offsets, ALNUM)
    hit, none = np.zeros(len(starts), dtype=bool), (np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not len(starts) or not len(table["sizes"]):
        return starts, ends, first, hit, none
    hashes = hash_words(data, starts, ends, 0)
    number = np.minimum(np.searchsorted(table["vocabulary"], hashes), len(table["vocabulary"]) - 1)
    known = table["vocabulary"][number] == hashes
    # only stretches of benchmark words as long as the shortest window can hold one; a document's end ends a stretch
    shortest = int(table["sizes"].min())
    edge = np.zeros(len(starts) + 1, dtype=bool)
    edge[first] = True
    begins = np.flatnonzero(known & (edge[:-1] | ~np.concatenate([[False], known[:-1]])))
    stops = np.flatnonzero(known & (edge[1:] | ~np.concatenate([known[1:], [False]]))) + 1
    long = stops - begins >= shortest
    begins, stops = begins[long], stops[long]
    if not len(begins):
        return starts, ends, first, hit, none
    sizes = stops - begins + 1  # with the separator
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begins, sizes)
    text = np.zeros(len(place), dtype=np.int64)
    body = np.ones(len(place), dtype=bool)
    body[np.cumsum(sizes) - 1] = False
    word = place[body]
    same = table["proof"][number[word]] == hash_words(data, starts[word], ends[word], 1)
    text[body] = np.where(same, number[word] + 1, 0)
    index = FmIndex(text)
    low, high = index.search(table["patterns"], table["sizes"])
    pattern, at = index.locate(low, high)
    word, size = place[at], table["sizes"][pattern]
    change = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(change, word, 1)
    np.add.at(change, word + size, -1)
    hit = np.cumsum(change[:-1]) > 0
    row = np.searchsorted(first, word, side="right") - 1
    seen = np.unique(row * len(table["sizes"]) + pattern)
    row, pattern = seen // len(table["sizes"]), seen % len(table["sizes"])
    count = table["owner_first"][pattern + 1] - table["owner_first"][pattern]
    items = table["owners"][np.repeat(table["owner_first"][pattern] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))]
    pairs = np.unique(np.repeat(row, count) * len(table["names"]) + items)
    return starts, ends, first, hit, (pairs // len(table["names"]), pairs % len(table["names"]))


SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))


def mark_names(columns: list[str]) -> list[str]:
    """Names of the three marks, with more underscores before them if ``columns`` have such names."""
    before = "_"
    while {before + x for x in ("words", "spans", "items")} & set(columns):
        before += "_"
    return [before + x for x in ("words", "spans", "items")]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _search(table, text: int, marked: bool, names: list[str]):
    """Adds to each row its words, the ranges of words that are hit, merged, and the items found."""
    def search(batches):
        for part, data, offsets in slices(batches, text, SHARD_BYTES):
            starts, ends, first, hit, (row, item) = _shard_hits(data, offsets, table.value)
            edge = np.zeros(len(starts) + 1, dtype=bool)
            edge[first] = True
            begins = np.flatnonzero(hit & (edge[:-1] | ~np.concatenate([[False], hit[:-1]])))
            stops = np.flatnonzero(hit & (edge[1:] | ~np.concatenate([hit[1:], [False]]))) + 1
            n = len(first) - 1
            spans, items = [[] for _ in range(n)], [[] for _ in range(n)]
            for k, a, b in zip((np.searchsorted(first, begins, side="right") - 1).tolist(), begins.tolist(), stops.tolist()):
                spans[k].append((a - int(first[k]), b - int(first[k])))
            for k, name in zip(row.tolist(), item.tolist()):
                items[k].append(table.value["names"][name])
            columns = part.columns
            if marked:
                for k, (old, known) in enumerate(zip(columns[-2].to_pylist(), columns[-1].to_pylist())):
                    spans[k] = _merged(spans[k] + [(x["begin"], x["end"]) for x in old])
                    items[k] = sorted(set(items[k]) | set(known))
                columns = columns[:-3]
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            marks = [pa.array(np.diff(first).astype(np.int64)),
                     pa.array([[{"begin": a, "end": b} for a, b in x] for x in spans], type=kind), pa.array(items, type=pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns + marks, names=part.schema.names[:len(columns)] + names)
    return search


def mark_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", block_chars: int = BLOCK_CHARS, last=None) -> DataFrame:
    """All columns of ``docs`` and ``_words`` (number of words), ``_spans`` (ranges of words inside any occurrence of a window of a
    benchmark item, merged) and ``_items`` (ids of items with occurring windows, as text, sorted).

    A-Z are lower-cased; words are runs of ASCII letters, digits and non-ASCII characters. An item's windows are its runs of
    ``window`` words; a shorter item that has words is one window. Null and empty texts have no words; repeated items and rows
    are searched and marked like any other; an item without id is found under the empty id; an empty benchmark hits nothing. If ``docs`` has
    a column of a mark's name, all three marks get one more underscore before theirs.

    Each task cuts its documents into shards and indexes those stretches of a shard that consist of benchmark words (a
    window can't be elsewhere) as numbers: suffix order, transform, wavelet ranks. All windows are searched backward at once and
    located over sampled positions. What is sent to all tasks is at most ``block_chars`` characters of benchmark: a larger
    one is dealt by hash into blocks, each searched in a pass of its own over the whole table, written between passes. ``last`` is
    applied to the marked Arrow batches in the last pass, which then returns the columns of ``docs``.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-chars // block_chars))
    marked = docs
    names = mark_names(docs.columns)
    schema = T.StructType(docs.schema.fields + [T.StructField(n, kind) for n, kind in zip(names, (T.LongType(), SPANS, T.ArrayType(T.StringType())))])
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).distinct().collect()
        table = spark.sparkContext.broadcast(window_table([(r["item"], r["text"]) for r in part], window))
        if block:
            marked = materialize(marked, "marked")
        search = _search(table, docs.columns.index(text_col), block > 0, names)
        if last and block == blocks - 1:
            return marked.mapInArrow(lambda batches: last(search(batches)), docs.schema)  # noqa: B023
        marked = marked.mapInArrow(search, schema)
    return marked


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_hit`` (words inside any occurrence), ``items`` (ids found, sorted as text)
    and ``spans`` (ranges of word numbers to remove, merged). See ``mark_hits``."""
    marked = mark_hits(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")), benchmark, window, "_text")
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    return marked.select(F.col("_id").alias(id_col), F.col("_words").alias("n_words"), hit.alias("n_hit"), F.col("_items").alias("items"),
                         F.col("_spans").alias("spans"))


def _cut(text: int):
    def cut(batches):
        for part, data, offsets in slices(batches, text):
            starts, ends, first = find_words(LOWER[data], offsets, ALNUM)
            found = part.column(part.num_columns - 2).to_pylist()
            texts = part.column(text).to_pylist()
            for row, spans in enumerate(found):
                if spans:
                    raw, kept = data[offsets[row]:offsets[row + 1]].tobytes(), 0
                    pieces = []
                    for span in spans:
                        pieces.append(raw[kept:int(starts[first[row] + span["begin"]] - offsets[row])])
                        kept = int(ends[first[row] + span["end"] - 1] - offsets[row])
                    texts[row] = b"".join([*pieces, raw[kept:]]).decode()
            columns = part.columns[:-3]
            columns[text] = pa.array(texts, type=pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-3])
    return cut


def remove_hits(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """``docs`` with the same columns, the merged spans cut out of the texts; texts without hits, null ones too, stay as they are."""
    return mark_hits(docs, benchmark, window, text_col, last=_cut(docs.columns.index(text_col)))
