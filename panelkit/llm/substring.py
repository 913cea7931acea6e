"""Substring dedup: words of passages that occur more than once are removed, found by anchors at difference-cover positions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from panelkit.llm.words import UNSPACED, Spans, find_words, hash_words, mix, parts, returning, single_spaced, slices

#: Perfect difference sets. Modulo the period, every difference is one of two members of the set.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

#: Bytes of text whose words a task has at hand at once; hashes of a slice are put together from such parts.
PART_BYTES = 1 << 20


@dataclass(frozen=True)
class Layout:
    """A window of ``size`` words, and the anchors inside it. Of two equal windows, at one of the first ``period`` offsets
    both positions are in the cover, so both hold an anchor of ``anchor`` words there, wherever they start."""

    size: int
    period: int

    @property
    def anchor(self) -> int:
        return self.size - self.period + 1

    @property
    def reach(self) -> int:
        return self.period - 1


def layout(size: int) -> Layout:
    """The longest period that leaves anchors at least a third as long as the window."""
    fits = [p for p in COVERS if 3 * (size - p + 1) >= size]
    if not fits:
        raise ValueError("windows must have at least 10 words")
    return Layout(size, max(fits))


def _slice_words(data, offsets):
    starts, ends, first = find_words(data, offsets, UNSPACED)
    return starts, ends, first, np.diff(first)


def _grouped(first_key: np.ndarray, second_key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by both keys, and where each group of equal keys begins in it (one more at the end)."""
    order = np.lexsort((second_key, first_key))
    a, b = first_key[order], second_key[order]
    begins = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, np.int64)
    return order, np.r_[begins, len(a)]


def _places(ids: pa.Array, text_hash: np.ndarray, row: np.ndarray, position: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([ids.take(pa.array(row)), pa.array((text_hash[row] << 32) | position)], names=["id", "at"])


def _anchors(plan: Layout):
    cover = np.isin(np.arange(plan.period), COVERS[plan.period])

    def hashed(data, offsets):
        starts, ends, first, counts = _slice_words(data, offsets)
        row = np.repeat(np.arange(len(counts)), counts)
        position = np.arange(len(starts)) - first[row]
        at = np.flatnonzero(cover[position % plan.period] & (position + plan.anchor <= counts[row]) & (counts[row] >= plan.size))
        row, position = row[at], position[at]
        core = Spans(hash_words(data, starts, ends, 0), 1)(at, at + plan.anchor)
        before = np.minimum(position, plan.reach)
        after = np.minimum(counts[row] - position, plan.anchor + plan.reach)
        around = Spans(hash_words(data, starts, ends, 1), 2)(at - before, at + after)
        return row, position, core, mix(around ^ ((before * 4096 + after).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))

    def anchors(batches):
        for part, data, offsets in slices(batches, 2):
            found = []
            for a, b in parts(offsets, PART_BYTES):
                row, *rest = hashed(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                found.append((row + a, *rest))
            row, position, core, around = map(np.concatenate, zip(*found))
            order, begins = _grouped(core, around)
            lead = order[begins[:-1]]
            text_hash = part.column(1).to_numpy()
            places = _places(part.column(0), text_hash, row[order], position[order])
            rest = np.delete(np.arange(len(order)), begins[:-1])
            head = places.take(pa.array(begins[:-1]))
            more = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.diff(begins) - 1)].astype(np.int32)), places.take(pa.array(rest)))
            yield pa.RecordBatch.from_arrays([pa.array(core[lead].view(np.int64)), pa.array(around[lead].view(np.int64)),
                                              head.field("id"), head.field("at"), more], names=["core", "around", "id", "at", "more"])
    return returning(anchors)


def _window_starts(plan: Layout, places: np.ndarray, flag: int, n_words: int) -> np.ndarray:
    """Mask over window starts: those whose anchor at one of ``places`` (position * 4 + flags) has the flag."""
    change = np.zeros(n_words + 2, dtype=np.int64)
    at = places[(places & flag) > 0] >> 2
    np.add.at(change, np.maximum(at - plan.reach, 0), 1)
    np.add.at(change, np.minimum(at, n_words - plan.size) + 1, -1)
    return np.cumsum(change[:max(n_words - plan.size + 1, 0)]) > 0


def _lists(column: pa.Array) -> list[np.ndarray | None]:
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [values[a:b] if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], valid)]


def _windows(plan: Layout):
    def hashed(data, offsets, lists):
        starts, ends, first, counts = _slice_words(data, offsets)
        wanted, known = [], []
        for row, places in enumerate(lists):
            begin = np.flatnonzero(_window_starts(plan, places, 2, int(counts[row])))
            sure = _window_starts(plan, places, 1, int(counts[row]))
            wanted.append(begin + first[row])
            known.append(sure[begin])
        row = np.repeat(np.arange(len(counts)), [len(x) for x in wanted])
        at, known = np.concatenate(wanted).astype(np.int64), np.concatenate(known).astype(bool)
        one = Spans(hash_words(data, starts, ends, 0), 3)(at, at + plan.size)
        return row, at - first[row], known, one, Spans(hash_words(data, starts, ends, 1), 4)(at, at + plan.size)

    def windows(batches):
        for part, data, offsets in slices(batches, 2):
            found, lists = [], _lists(part.column(3))
            for a, b in parts(offsets, PART_BYTES):
                row, *rest = hashed(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], lists[a:b])
                found.append((row + a, *rest))
            row, position, known, one, two = map(np.concatenate, zip(*found))
            order, begins = _grouped(one, two)
            lead = order[begins[:-1]]
            open_ = ~known[order]
            group = np.repeat(np.arange(len(begins) - 1), np.diff(begins))[open_]
            asked = order[open_]
            places = _places(part.column(0), part.column(1).to_numpy(), row[asked], position[asked])
            held = pa.ListArray.from_arrays(pa.array(np.searchsorted(group, np.arange(len(begins))).astype(np.int32)), places)
            yield pa.RecordBatch.from_arrays([pa.array(one[lead].view(np.int64)), pa.array(two[lead].view(np.int64)),
                                              pa.array(np.diff(begins).astype(np.int64)), held], names=["one", "two", "n", "places"])
    return returning(windows)


def _finish(plan: Layout):
    def finish(batches):
        for part, data, offsets in slices(batches, 2, PART_BYTES):
            starts, ends, first, counts = _slice_words(data, offsets)
            text, begin, stop = single_spaced(data, starts, ends) if len(starts) else (b"", starts, ends)
            kept, removed = [], []
            for row, (places, resolved) in enumerate(zip(_lists(part.column(3)), _lists(part.column(4)))):
                low, high = int(first[row]), int(first[row + 1])
                if low == high:
                    kept.append("")
                    removed.append(0)
                    continue
                if places is None:
                    kept.append(text[begin[low]:stop[high - 1]].decode())
                    removed.append(0)
                    continue
                n = high - low
                repeated = _window_starts(plan, places, 1, n)
                if resolved is not None:
                    repeated[resolved] = True
                change = np.zeros(n + 1, dtype=np.int64)
                at = np.flatnonzero(repeated)
                change[at] += 1
                change[at + plan.size] -= 1
                stays = np.r_[False, np.cumsum(change[:-1]) == 0, False]
                turn = np.flatnonzero(stays[1:] != stays[:-1])
                kept.append(b" ".join(text[begin[low + a]:stop[low + b - 1]] for a, b in zip(turn[::2], turn[1::2])).decode())
                removed.append(n - int(stays.sum()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                                              *part.columns[5:-1]], names=["id", "n_words", "n_removed", "kept", *part.schema.names[5:-1]])
    return returning(finish)


def remove_repeats(docs: DataFrame, size: int = 35, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Words without those covered by a window of ``size`` words that starts anywhere else too: the id, ``n_words``, ``n_removed``
    and ``kept`` (the other words, unchanged, joined by one space), one row per row of ``docs``, and ``carried``, a struct of the
    columns named in ``carry``, if any.

    Words are separated by ASCII white space. All occurrences of a repeated window go, the first included, and windows are
    judged on the input. Null and empty texts have no words; texts of fewer than ``size`` words lose none; rows that are equal in
    id and text count as two documents, so they lose every window. If any row has no id or shares one, all rows are told apart by 96
    bits of their text's hashes too. Other columns are ignored; an empty table gives no rows.

    Anchors are runs of words at difference-cover positions of each document, modulo a period: equal windows, however they
    are shifted, share an aligned anchor, so about a quarter of the positions is hashed and shuffled. Each anchor carries a
    hash of the words as far as any of its windows extends. Anchors that agree in both prove all their windows repeated. Where
    anchors agree but their surroundings differ, the windows themselves are hashed (128 bits) and counted, one anchor of each
    surrounding standing for its equals. A slice of text sends each hash once, however often it holds it, so copies and
    common passages shrink before the shuffle and no pairs are formed. Texts are shuffled once.
    """
    plan = layout(size)
    text = F.col(text_col).cast("string")
    rest = [F.struct(*carry).alias("carried")] if carry else []
    lax = docs.groupBy(F.col(id_col).alias("id")).count().filter("id is null or count > 1").limit(1).count() > 0
    named = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.lit("apart"), text).alias("apart")) if lax else F.col(id_col)
    rows = docs.select(named.alias("id"), F.shiftright(F.xxhash64(text), 32).alias("hash"), text.alias("text"), *rest)
    rest = ["carried"] if carry else []  # this and ``open`` are also read where they aren't needed, so that both joins share their shuffles
    kind = rows.schema["id"].dataType
    place = T.StructType([T.StructField("id", kind), T.StructField("at", T.LongType())])
    found = T.StructType([T.StructField("core", T.LongType()), T.StructField("around", T.LongType()), T.StructField("id", kind),
                          T.StructField("at", T.LongType()), T.StructField("more", T.ArrayType(place))])
    ordered = Window.partitionBy("core").orderBy("around")
    group = Window.partitionBy("core")
    anchors = (rows.select("id", "hash", "text").mapInArrow(_anchors(plan), found)
               .withColumn("last", F.lag("around").over(ordered)).withColumn("next", F.lead("around").over(ordered))
               .withColumn("mixed", F.min("around").over(group) != F.max("around").over(group))
               .withColumn("twins", F.size("more") > 0)
               .filter("last is not null or next is not null or twins"))
    sure = F.col("twins") | F.coalesce(F.col("last") == F.col("around"), F.lit(False)) | F.coalesce(F.col("next") == F.col("around"), F.lit(False))
    stands = F.col("mixed") & (F.col("last").isNull() | (F.col("last") != F.col("around")))
    flags = sure.cast("long") + stands.cast("long") * 2
    each = F.concat(F.array(F.struct("id", "at", flags.alias("flags"))),
                    F.transform("more", lambda p: F.struct(p["id"].alias("id"), p["at"].alias("at"), F.lit(1).cast("long").alias("flags"))))
    position = F.col("at").bitwiseAND(F.lit((1 << 32) - 1))
    # a struct key: nulls compare equal in it, and one partitioning serves the grouping and both joins
    owner = F.struct("id", F.shiftright("at", 32).alias("hash"))
    known = (anchors.select(F.explode(each).alias("p")).select("p.*").groupBy(owner.alias("row"))
             .agg(F.collect_list(position * 4 + F.col("flags")).alias("places"), F.max(F.col("flags") >= 2).alias("open")))
    texts = rows.select(F.struct("id", "hash").alias("row"), "text", *rest)
    counted = T.StructType([T.StructField("one", T.LongType()), T.StructField("two", T.LongType()), T.StructField("n", T.LongType()),
                            T.StructField("places", T.ArrayType(place))])
    resolved = (texts.join(known.filter("open"), "row").select("row.id", "row.hash", "text", "places", *rest)
                .mapInArrow(_windows(plan), counted)
                .withColumn("n", F.sum("n").over(Window.partitionBy("one", "two"))).filter("n > 1")
                .select(F.explode("places").alias("p")).select("p.*").groupBy(owner.alias("row")).agg(F.collect_list(position).alias("resolved")))
    lists = known.join(resolved, "row", "left")
    out = T.StructType([T.StructField("id", kind), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                        T.StructField("kept", T.StringType())] + ([rows.schema["carried"]] if carry else []))
    done = texts.join(lists, "row", "left").select("row.id", "row.hash", "text", "places", "resolved", *rest, "open").mapInArrow(_finish(plan), out)
    return (done.withColumn("id", F.col("id.id")) if lax else done).withColumnRenamed("id", id_col)
