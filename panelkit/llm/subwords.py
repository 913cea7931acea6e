"""Hashed character n-grams of words, counted per distinct word, and labelled samples of bounded size."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.words import LETTERS, LOWER, find_words, hash_words, mix, ranges, slices

UNIT = 1 << 30


@dataclass(frozen=True)
class Grams:
    """Byte n-grams of lower-cased words marked < and >, and the whole word, hashed into 2^bits buckets. ``once``: a word that
    occurs several times in a document counts once."""

    sizes: tuple[int, ...] = (2, 3, 4)
    bits: int = 17
    once: bool = False

    def of_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all n-grams of the given words, and the number of the word of each."""
        sizes = ends - starts
        begin = np.cumsum(sizes + 2) - sizes - 2
        marked = np.zeros(int((sizes + 2).sum()) + max(self.sizes), dtype=np.uint8)
        marked[begin], marked[begin + sizes + 1] = 0x3C, 0x3E
        marked[ranges(begin + 1, sizes)] = data[ranges(starts, sizes)]
        total = len(marked) - max(self.sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes + 2)
        left = np.repeat(begin + sizes + 2, sizes + 2) - np.arange(total)
        value = np.zeros(total, dtype=np.uint64)
        buckets, owners, shift = [hash_words(data, starts, ends, 7) >> np.uint64(64 - self.bits)], [np.arange(len(sizes))], np.uint64(64 - self.bits)
        for n in range(1, max(self.sizes) + 1):
            value = value | (marked[n - 1:n - 1 + total].astype(np.uint64) << np.uint64(8 * (n - 1)))
            if n in self.sizes:
                fits = left >= n
                buckets.append(mix(value[fits] + np.uint64(n << 56)) >> shift)
                owners.append(owner[fits])
        return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)

    def distinct(self, data: np.ndarray, offsets: np.ndarray):
        """Of a slice of texts: lower-cased bytes, starts and ends of its distinct words, which of them each word occurrence is, and
        the row of each occurrence (in order)."""
        data = LOWER[data]
        starts, ends, first = find_words(data, offsets, LETTERS)
        _, place, word = np.unique(hash_words(data, starts, ends), return_index=True, return_inverse=True)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        if self.once and len(row):
            pairs = np.unique(row * len(place) + word)
            row, word = pairs // len(place), pairs % len(place)
        return data, starts[place], ends[place], word, row


def sum_rows(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Sums of ``values`` by ascending ``row``; zero where a row has none."""
    out = np.zeros((rows, *values.shape[1:]))
    if len(row):
        begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[begins]] = np.add.reduceat(values, begins, axis=0)
    return out


def sampled(docs: DataFrame, label: str, key: str, per_class: int, classes: int = 1000) -> DataFrame:
    """About ``per_class`` rows of each label (all of a rare one), picked by a hash of the key: bounded whatever the table's size.
    Of more than ``classes`` labels, those of the most rows, of equal numbers the first in order."""
    sizes = docs.filter(F.col(label).isNotNull()).groupBy(label).count()
    counts = {r[0]: r[1] for r in sizes.orderBy(F.desc("count"), label).limit(classes).collect()}
    if not counts:
        return docs.limit(0)
    shares = F.create_map(*[x for name, n in counts.items() for x in (F.lit(name), F.lit(min(UNIT, UNIT * per_class // n)))])
    picked = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(UNIT)) < F.element_at(shares, F.col(label))
    return docs.filter(picked).limit(2 * per_class * len(counts))


def sample_features(rows: DataFrame, grams: Grams, label: str, key: str, text: str) -> pa.Table:
    """Features of a bounded sample on the driver: label, a hash of the key, buckets and counts of each text."""
    def features(batches):
        for part, data, offsets in slices(batches, 2, lower=True):
            data, starts, ends, word, row = grams.distinct(data, offsets)
            bucket, owner = grams.of_words(data, starts, ends)
            order = np.argsort(owner, kind="stable")
            first = np.searchsorted(owner[order], np.arange(len(starts) + 1))
            buckets, counts = [], []
            for begin, end in zip(*(np.searchsorted(row, np.arange(len(offsets) - 1), side=s) for s in ("left", "right"))):
                found = word[begin:end]
                size = first[found + 1] - first[found]
                ids, n = np.unique(bucket[order[ranges(first[found], size)]], return_counts=True)
                buckets.append(ids.astype(np.int32))
                counts.append(n.astype(np.float32))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(buckets, pa.list_(pa.int32())),
                                              pa.array(counts, pa.list_(pa.float32()))], names=["label", "key", "buckets", "counts"])

    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("key", T.LongType()),
                           T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.FloatType()))])
    found = rows.select(F.col(label).cast("string").alias("label"), F.xxhash64(key).alias("key"), F.col(text).cast("string").alias("text"))
    return found.mapInArrow(features, schema).toArrow()


def by_key(table: pa.Table) -> np.ndarray:
    """Rows in order of key and label, an order that doesn't depend on how the sample arrived."""
    return pa.compute.sort_indices(table.select(["key", "label"]), [("key", "ascending"), ("label", "ascending")]).to_numpy()


def sparse(table: pa.Table, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, counts and the first place of each of the rows ``order`` (one more at the end), copied once."""
    sizes = pa.compute.list_value_length(table.column("buckets")).to_numpy().astype(np.int64)[order]
    first = np.concatenate([[0], np.cumsum(sizes)])
    place = np.full(table.num_rows, -1, dtype=np.int64)
    place[order] = first[:-1]
    out = np.empty(first[-1], dtype=np.int32), np.empty(first[-1], dtype=np.float32)
    for into, name in zip(out, ("buckets", "counts")):
        row = 0
        for chunk in table.column(name).chunks:
            offsets, values = chunk.offsets.to_numpy(), chunk.values.to_numpy()
            for at, a, b in zip(place[row:row + len(chunk)].tolist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                if at >= 0:
                    into[at:at + b - a] = values[a:b]
            row += len(chunk)
    return *out, first
