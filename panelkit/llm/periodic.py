"""Periodic runs of words, found by string synchronising sets: positions that a hash selects by their context alone, at dyadic scales."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.words import UNSPACED, find_words, hash_words, mix, single_spaced, slices

#: A run repeats its period at least so often; the method rests on it (see ``periodic_runs``).
REPEATS = 4
NEVER = ~np.uint64(0)


def number_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words as numbers, equal if and only if their two 64-bit hashes are."""
    one, two = hash_words(data, starts, ends, 0), hash_words(data, starts, ends, 1)
    _, place, number = np.unique(one, return_index=True, return_inverse=True)
    if (two[place][number] == two).all():
        return number
    order = np.lexsort((two, one))
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(np.r_[False, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])
    return out


def _window_least(value: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by windows that double."""
    least, reach = value, 1
    while reach < width:
        step = min(reach, width - reach)
        least, reach = np.minimum(least[:-step], least[step:]), reach + step
    return least


def synchronising(ids: np.ndarray, scale: int) -> np.ndarray:
    """Positions i whose window of identities ids[i .. i + scale] has its least at one of its two ends. ``ids`` are hashes of the ``scale``
    words from each position, ``NEVER`` in highly periodic regions. So whether i is selected depends on words i .. i + 2 * scale
    alone, and of any ``scale`` neighbouring positions one is selected unless all that they see is highly periodic."""
    if len(ids) <= scale:
        return np.zeros(0, dtype=np.int64)
    least = _window_least(ids, scale + 1)
    return np.flatnonzero((least != NEVER) & ((least == ids[:-scale]) | (least == ids[scale:])))


def proposals(ids: np.ndarray, context: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Synchronising positions that have the next one of equal context (2 * scale words) at a distance of scale .. 2 * scale - 1 words, and
    that distance: the period it proposes."""
    chosen = synchronising(ids, scale)
    seen = context[chosen]
    order = np.argsort(seen, kind="stable")
    at, equal = chosen[order], seen[order]
    distance = at[1:] - at[:-1]
    fits = (equal[1:] == equal[:-1]) & (distance >= scale) & (distance < 2 * scale)
    return at[:-1][fits], distance[fits]


def _stretch(words: np.ndarray, at: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The widest stretch around ``at`` inside low .. high in which words ``period`` apart are equal."""
    end, step = at, 4 * period
    while end + period < high:
        stop = min(end + step, high - period)
        differ = words[end:stop] != words[end + period:stop + period]
        first = int(differ.argmax())
        if differ[first]:
            end += first
            break
        end, step = stop, 2 * step
    begin, step = at, 4 * period
    while begin > low:
        stop = max(begin - step, low)
        differ = words[stop:begin] != words[stop + period:begin + period]
        last = int(differ[::-1].argmax())
        if differ[len(differ) - 1 - last]:
            begin -= last
            break
        begin, step = stop, 2 * step
    return begin, end + period


def find_runs(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Every run of the texts of a slice: rows of (begin, end, period) in ``words``, by begin and period. ``words`` are the words' numbers,
    ``first`` where each text's words begin (one more at the end).

    A run is a stretch of one text with smallest period q and at least ``REPEATS`` * q words that keeps q no further on either side.
    At scale s (1, 2, 4, ...) those with s <= q < 2 s are found. Let the highly periodic regions of the scale be the windows of
    s words inside a run of period s / 4 or less: they are known from smaller scales, and nothing is selected there, so a word
    said a thousand times doesn't flood the larger scales. A run of q words is seen outside of them (else q would not be its
    smallest period), so a position s is selected in its first words; s + q sees the same 2 s words inside the
    run, so it is selected too, and nothing between sees them, for they hold more than a period. Each pair is then
    widened word by word, which also proves it.
    """
    sizes = np.diff(first)
    found, seen = np.zeros((0, 3), dtype=np.int64), set()
    held, scale = np.flatnonzero(sizes >= REPEATS), 1
    # the long enough texts one after the other, each closed by a word that occurs nowhere else
    place, spots = _places(sizes[held]), np.arange(int((sizes[held] + 1).sum()))
    inner = np.ones(len(spots), dtype=bool)
    inner[place + sizes[held]] = False
    origin = np.where(inner, spots - np.repeat(place - first[held], sizes[held] + 1), -1)
    ids = np.where(inner, words[origin].astype(np.uint64), np.uint64(1 << 40) + spots.astype(np.uint64)) if len(held) else np.zeros(0, np.uint64)
    ids = mix(ids + np.uint64(1))
    while len(held):
        context = ids.copy()  # a context that would pass the end holds the last text's end, so it is like no other anyway
        context[:-scale] = mix(ids[:-scale] * np.uint64(0x9E3779B97F4A7C15) + ids[scale:])
        at, period = proposals(_outside(ids, found, scale, held, sizes, first), context, scale)
        at, order = np.sort(origin[at]), np.argsort(origin[at])
        period = period[order]
        fresh = np.ones(len(at), dtype=bool)  # a pair one word after a pair of the same distance is in the same run
        fresh[1:] = (at[1:] != at[:-1] + 1) | (period[1:] != period[:-1])
        at, period = at[fresh], period[fresh]
        text, covered, new = np.searchsorted(first, at, side="right") - 1, {}, []
        for a, q, t in zip(at.tolist(), period.tolist(), text.tolist()):
            if a < covered.get((t, q), -1):
                continue
            begin, end = _stretch(words, a, q, int(first[t]), int(first[t + 1]))
            covered[t, q] = end - q
            if end - begin >= REPEATS * q and (begin, end) not in seen:  # known: it has a smaller period
                seen.add((begin, end))
                new.append((begin, end, q))
        found = np.concatenate([found, np.array(new, dtype=np.int64).reshape(-1, 3)])
        scale *= 2
        stays = sizes[held] >= REPEATS * scale
        left = np.repeat(stays, sizes[held] + 1)
        held, ids, origin = held[stays], context[left], origin[left]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _places(sizes: np.ndarray) -> np.ndarray:
    """Where each text begins if one word is put after each."""
    return np.cumsum(sizes + 1) - sizes - 1


def _outside(ids: np.ndarray, runs: np.ndarray, scale: int, held: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``ids`` with ``NEVER`` where the ``scale`` words from a position lie inside a run of period scale / ``REPEATS`` or less."""
    runs = runs[(REPEATS * runs[:, 2] <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]  # such a run's text is long enough to be held
    if not len(runs):
        return ids
    change, offset = np.zeros(len(ids) + 1, dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    kept = np.zeros(len(sizes), dtype=bool)
    offset[held], kept[held] = _places(sizes[held]) - first[held], True
    text = np.searchsorted(first, runs[:, 0], side="right") - 1
    runs, text = runs[kept[text]], text[kept[text]]
    np.add.at(change, runs[:, 0] + offset[text], 1)
    np.add.at(change, runs[:, 1] - scale + 1 + offset[text], -1)
    return np.where(np.cumsum(change[:-1]) > 0, NEVER, ids)


def _finder(least: int):
    def run(batches):
        for part, data, offsets in slices(batches, 1):
            starts, ends, first = find_words(data, offsets, UNSPACED)
            runs = find_runs(number_words(data, starts, ends), first)
            runs = runs[runs[:, 1] - runs[:, 0] >= least]
            change = np.zeros(len(starts) + 1, dtype=np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 1], -1)
            stays = np.cumsum(change[:-1]) == 0
            text, begin, stop = single_spaced(data, starts, ends) if len(starts) else (b"", starts, ends)
            kept = []
            for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
                if low == high:
                    kept.append("")
                elif stays[low:high].all():
                    kept.append(text[begin[low]:stop[high - 1]].decode())
                else:
                    turn = np.flatnonzero(np.diff(np.r_[0, stays[low:high].astype(np.int8), 0])) + low
                    kept.append(b" ".join(text[begin[a]:stop[b - 1]] for a, b in zip(turn[::2], turn[1::2])).decode())
            row = np.searchsorted(first, runs[:, 0], side="right") - 1
            told = pa.StructArray.from_arrays([pa.array(runs[:, 0] - first[row]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                                              names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(first))).astype(np.int32)), told)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(first).astype(np.int64)), lists, pa.array(kept, pa.string())],
                                             names=["id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, least: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``runs`` (``start``, ``length``, ``period`` in words, by start and period) and
    ``collapsed``: the text without what its runs repeat.

    Words are separated by ASCII white space and compared unchanged. A run is a stretch of words with smallest period q, at least
    ``least`` and 4 * q words long, that no neighbouring word extends. A word is dropped if any run contains it after that run's first
    q words; the others are joined by one space. Runs may overlap and nest; all are told. Null and empty texts have no words and no
    runs; a row without an id is a row like any other, and so are repeated rows. Other columns are ignored, whatever their
    names; an empty table gives no rows.

    Runs lie inside one text, so each text is searched where it is read, without a shuffle: in about n log n steps by
    synchronising sets (see ``find_runs``), all texts of a slice together.
    """
    run = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(run)), T.StructField("collapsed", T.StringType())])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_finder(least), schema).withColumnRenamed("id", id_col)
