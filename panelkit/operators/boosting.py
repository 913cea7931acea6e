"""Boosted trees with monotone constraints: rows are binned once, and each level of every tree is one sum of slopes and curvatures by bin."""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Collection, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.numeric import clip
from panelkit.operators.penalised import BLOCK_BYTES, sigmoid
from panelkit.operators.quantiles import quantiles_of_unions
from panelkit.session import materialize
from panelkit.sources.sinks import write_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the functions that run in tasks travel with the job

#: Most bins of a feature; one more holds missing values.
BINS = 64
#: Least gain of a split, so that rounding makes none.
LEAST_GAIN = 1e-6
#: Passes after which the margins of finished trees are written, so that a pass only walks the trees since.
REFRESH = 48
#: Rows of a packed block: enough that a step on a column outweighs its call, few enough that columns stay in the processor's cache.
BLOCK_ROWS = 1 << 16
#: Most joint values of features whose sums are taken in one go.
JOINT = 256


@dataclass(frozen=True)
class TreeSetting:
    """Hyper-parameters of one fit; names and meanings are those usual for gradient boosting with second-order steps."""

    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 3
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0


# ---- binning --------------------------------------------------------------------------------------------------------
def _clipped(v: float, low: float, high: float) -> float:
    """A value clipped as in a column, where NaN is above all numbers."""
    up = low if np.isnan(low) else max(v, low)
    return up if np.isnan(high) else high if np.isnan(up) else min(up, high)


def fit_cuts(rows: DataFrame, columns: Sequence[str], caps: Mapping[int, Mapping[str, tuple[float, float]]], parts: Mapping[int, Collection[int]],
             edges: dict[str, list[float]], bins: int = BINS) -> dict[int, list[list[float]]]:
    """Cut points of each column at its quantiles in each fold, clipped to the fold's caps; a value lies in the bin numbered by the cut points not above it.

    A fold's rows are those whose ``__part`` is in its ``parts``. Clipping keeps the order of values, so the quantiles of clipped values are the
    clipped quantiles, and the rows are ordered once for all folds.
    """
    most = sys.float_info.max  # stands for infinity and NaN, which is clipped like it
    numbers = rows.select("__part", *[clip(F.col(c).cast("double"), -most, most).alias(c) for c in columns])
    found = quantiles_of_unions(numbers, columns, [i / bins for i in range(1, bins)], "__part", parts, False, edges)
    ends, out = {most: float("inf"), -most: -float("inf")}, {}
    for k, of in found.items():
        clipped = [[_clipped(ends.get(v, v), *caps[k][c]) for v in of[c]] for c in columns]
        out[k] = [sorted({v for v in some if not np.isnan(v)}) for some in clipped]
    return out


def flag_cuts(rows: int, ones: int, bins: int = BINS) -> list[float]:
    """The same of a column of 0 and 1, from its counts."""
    ranks = [max(math.ceil(i / bins * rows) - 1, 0) for i in range(1, bins)] if rows else []
    return sorted({0.0 if r < rows - ones else 1.0 for r in ranks})


def _numbered(x: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Bins of values by cut points; NaN goes to the bin after the last."""
    if len(cut) > 8:
        at = np.searchsorted(cut, x, side="right").astype(np.uint8)
    else:
        at = np.zeros(len(x), dtype=np.uint8)
        for c in cut:
            at += (x >= c).view(np.uint8)
    return np.where(np.isnan(x), np.uint8(len(cut) + 1), at)


def bin_rows(rows: DataFrame, cuts: Sequence[Sequence[float]], keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and ``bins``, one byte for each entry of the array column ``x``; NaN goes to the bin after the last.

    The entries travel as columns of numbers: an array column costs many times as much on its way to Python.
    """
    edges = [np.array(c) for c in cuts]

    def run(batches):
        for batch in batches:
            out = np.empty((batch.num_rows, len(edges)), dtype=np.uint8)
            for f, cut in enumerate(edges):
                out[:, f] = _numbered(batch.column(f).to_numpy(zero_copy_only=False), cut)
            places = np.arange(len(out) + 1, dtype=np.int32) * len(edges)
            made = pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(out.tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns[len(edges):], made], names=[*keep, "bins"])

    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("bins", T.BinaryType())])
    return rows.select(*[F.get("x", F.lit(f)).alias(f"__x{f}") for f in range(len(edges))], *keep).mapInArrow(run, schema)


def bin_folds(rows: DataFrame, columns: Mapping[int, Sequence[str]], cuts: Mapping[int, Sequence[Sequence[float]]], parts: Mapping[int, Collection[int]]) -> DataFrame:
    """Blocks of rows of all folds from one pass: ``fold``, and of all rows of a block ``r``, ``y`` and ``bins`` by the fold's cut points, as bytes.

    ``rows`` has ``__part``, ``r``, ``y`` and numbers; ``columns`` names each fold's. A row is in each fold whose ``parts`` hold its own part.
    """
    names = sorted({c for some in columns.values() for c in some})
    place = {c: 3 + n for n, c in enumerate(names)}
    edges = {k: [np.array(c) for c in some] for k, some in cuts.items()}

    def found(batches):
        for batch in batches:
            part, r, y = (batch.column(c).to_numpy() for c in range(3))
            x = {c: batch.column(n).to_numpy(zero_copy_only=False) for c, n in place.items()}
            for k in sorted(columns):
                here = np.isin(part, list(parts[k]))
                if here.any():
                    bins = np.empty((len(columns[k]), int(here.sum())), dtype=np.uint8)
                    for f, c in enumerate(columns[k]):
                        bins[f] = _numbered(x[c][here], edges[k][f])
                    yield k, r[here], y[here], bins

    flat = rows.select(F.col("__part").cast("int"), F.col("r").cast("long"), F.col("y").cast("double"), *names)
    return flat.mapInArrow(lambda batches: _as_blocks(found(batches)), T.StructType(BLOCK[:4]))


BLOCK = [T.StructField("fold", T.IntegerType()), *[T.StructField(c, T.BinaryType()) for c in ("r", "y", "bins", "m")]]


def _short(y: np.ndarray) -> np.ndarray:
    """Labels in a byte each if all are 0 or 1."""
    return y.astype(np.uint8) if ((y == 0) | (y == 1)).all() else y


def _as_blocks(pieces: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Pieces (fold, row hashes, labels, bins with a line for each feature) put together to blocks of one fold."""
    waiting: dict[int, list[tuple]] = {}

    def block(k: int) -> pa.RecordBatch:
        r, y, bins = zip(*waiting.pop(k))
        made = [np.concatenate(r), _short(np.concatenate(y)), np.concatenate(bins, axis=1)]
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in made]], names=["fold", "r", "y", "bins"])

    for k, *piece in pieces:
        waiting.setdefault(k, []).append(piece)
        if sum(len(r) for r, _, _ in waiting[k]) >= BLOCK_ROWS:
            yield block(k)
    for k in list(waiting):
        yield block(k)


def pack(rows: DataFrame, name: str = "blocks") -> DataFrame:
    """Rows in blocks of one fold, written and read back: ``fold``, and of all rows of a block ``r``, ``y``, ``bins`` (feature by feature) and ``m``
    (margins, none yet) as bytes. ``rows`` has ``fold``, ``r``, ``y`` and ``bins``, or is in blocks already (see ``bin_folds``). A pass then
    moves a few long values in place of a list for each row."""
    def found(batches):
        for batch in batches:
            if batch.num_rows:
                fold, r, y, bins = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), _bytes(batch.column(3))
                for k in np.unique(fold).tolist():
                    here = fold == k
                    yield k, r[here], y[here], bins[here].T

    if isinstance(rows.schema["r"].dataType, T.BinaryType):
        blocks = rows
    else:
        flat = rows.select(F.col("fold").cast("int"), F.col("r").cast("long"), F.col("y").cast("double"), "bins")
        blocks = flat.mapInArrow(lambda batches: _as_blocks(found(batches)), T.StructType(BLOCK[:4]))
    return materialize(blocks.withColumn("m", F.lit(None).cast("binary")), name, BLOCK_BYTES)


def _blocks(batch, base: Mapping[int, float], number: int, width: int | None = None):
    """Each block's fold, row hashes, labels, bins (a column lies together) and margins at the last refresh, one column a setting. Without hashes
    (see ``grow_all``) the number of features tells the rows."""
    folds = batch.column(0).to_pylist()
    for i, k in enumerate(folds):
        r, y, bins, m = (None if not c[i].is_valid else c[i].as_buffer() for c in batch.columns[1:])
        r, bins = None if r is None else np.frombuffer(r, dtype=np.int64), np.frombuffer(bins, dtype=np.uint8)
        n = len(bins) // width if r is None else len(r)
        y = np.frombuffer(y, dtype=np.uint8 if len(y) == n else np.float64).astype(np.float64, copy=False)
        margins = np.broadcast_to(np.float64(base[k]), (n, number)) if m is None else np.frombuffer(m, dtype=np.float64).reshape(n, number)
        yield k, r, y, bins.reshape(-1, n).T, margins


# ---- trees ----------------------------------------------------------------------------------------------------------
def leaf_weight(g, h, setting: TreeSetting, low=-np.inf, high=np.inf):
    """Best value of a leaf within its bounds."""
    pull = np.sign(g) * np.maximum(np.abs(g) - setting.reg_alpha, 0)
    total = h + setting.reg_lambda
    return np.clip(np.where(total > 0, -pull / np.where(total > 0, total, 1), 0.0), low, high)


def leaf_gain(g, h, w, setting: TreeSetting):
    """How much a leaf of value ``w`` lowers the loss, twice."""
    return -(2 * g * w + (h + setting.reg_lambda) * w ** 2 + 2 * setting.reg_alpha * np.abs(w))


def best_split(g: np.ndarray, h: np.ndarray, cuts: Sequence[int], features: Sequence[int], signs: Sequence[int], setting: TreeSetting,
               low: float, high: float) -> dict | None:
    """The best split of one node from its sums by (feature, bin), or None if none gains enough.

    Rows of a bin up to ``bin`` go left; missing values (the bin after a feature's last) go where they gain more. Both children must have
    the least weight, and where a feature is constrained the right leaf must not be on the wrong side of the left one.
    """
    all_g, all_h = float(g[features[0]].sum()), float(h[features[0]].sum())
    before = leaf_gain(all_g, all_h, leaf_weight(all_g, all_h, setting, low, high), setting)
    best = None
    for f in features:
        n = cuts[f]
        if not n:
            continue
        gone_g, gone_h = float(g[f, n + 1]), float(h[f, n + 1])
        run_g, run_h = np.cumsum(g[f, :n]), np.cumsum(h[f, :n])
        for missing_left in (False, True) if gone_h > 0 else (False,):
            gl, hl = (run_g + gone_g, run_h + gone_h) if missing_left else (run_g, run_h)
            gr, hr = all_g - gl, all_h - hl
            wl, wr = leaf_weight(gl, hl, setting, low, high), leaf_weight(gr, hr, setting, low, high)
            gain = leaf_gain(gl, hl, wl, setting) + leaf_gain(gr, hr, wr, setting) - before
            fits = (hl >= setting.min_child_weight) & (hr >= setting.min_child_weight) & (hl > 0) & (hr > 0) & (signs[f] * (wr - wl) >= 0)
            gain = np.where(fits, gain, -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > max(LEAST_GAIN, setting.gamma) and (best is None or gain[k] > best["gain"]):
                best = {"gain": float(gain[k]), "feature": f, "bin": k, "missing_left": missing_left, "left": (float(gl[k]), float(hl[k]), float(wl[k])),
                        "right": (float(gr[k]), float(hr[k]), float(wr[k]))}
    return best


@dataclass
class Tree:
    """Nodes of a tree in heap order (children of i at 2 i + 1 and 2 i + 2): feature or -1, last bin that goes left, where missing goes, value."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return Tree(np.full(size, -1, dtype=np.int16), np.zeros(size, dtype=np.int16), np.zeros(size, dtype=bool), np.zeros(size))

    def steps(self) -> tuple[list[list[tuple]], np.ndarray]:
        """The tree for ``walk``: by level each inner node, its split and its inner children; and the node at the end of every way."""
        levels, ways, level = [], np.zeros(1, dtype=np.int64), [0] if self.feature[0] >= 0 else []
        while level:
            inner = {c for node in level for c in (2 * node + 1, 2 * node + 2) if self.feature[c] >= 0}
            levels.append([(node, (int(self.feature[node]), int(self.bin[node]), bool(self.missing_left[node])), 2 * node + 1 in inner, 2 * node + 2 in inner)
                           for node in level])
            parts = self.feature[ways] >= 0
            ways = np.concatenate([np.where(parts, 2 * ways + 1, ways), np.where(parts, 2 * ways + 2, ways)])
            level = sorted(inner)
        return levels, ways

    def nodes(self, bins: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The node that each row has come to."""
        levels, ways = self.steps()
        return walk(levels, ways, bins, cuts, {})


def walk(levels: Sequence[Sequence[tuple]], ends: np.ndarray, bins: np.ndarray, cuts: np.ndarray, known: dict) -> np.ndarray:
    """For each row the entry of ``ends`` at its way down a tree (see ``Tree.steps``).

    Each split is one comparison of a whole column, a bit a row, and sets of rows go down the tree: no row looks up its own node. The turns to
    the right, a bit for each level, number the ways. ``known`` keeps the comparisons for further trees of the same rows.
    """
    sets: dict[int, np.ndarray] = {}
    kind = np.min_scalar_type(len(ends) - 1)
    way = np.zeros(len(bins), dtype=kind)
    for place, level in enumerate(levels):
        turned = None
        for node, split, goes_left, goes_right in level:
            right = known.get(split)
            if right is None:
                f, last, missing_left = split
                right = known[split] = np.packbits((bins[:, f] > last) & (bins[:, f] <= int(cuts[f])) if missing_left else bins[:, f] > last)
            if node:
                here = sets.pop(node)
                right = right & here
                if goes_left:
                    sets[2 * node + 1] = here ^ right
            elif goes_left:
                sets[1] = ~right
            if goes_right:
                sets[2 * node + 2] = right
            turned = right if turned is None else turned | right
        way += np.unpackbits(turned, count=len(bins)) * kind.type(1 << place)
    return ends.take(way, mode="clip")


@dataclass
class Growing:
    """One fit under way: finished trees, the tree that grows, and what is known of its open nodes."""

    setting: TreeSetting
    cuts: list[int]
    signs: list[int]
    rng: np.random.Generator
    trees: list[Tree] = field(default_factory=list)
    gains: list[list[dict]] = field(default_factory=list)
    tree: Tree | None = None

    def __post_init__(self):
        self.begin()

    def begin(self) -> None:
        usable = [f for f, n in enumerate(self.cuts) if n]
        self.tree, self.level, self.open = Tree.empty(self.setting.max_depth), 0, {0: (-np.inf, np.inf)}
        size = max(1, round(self.setting.colsample * len(usable))) if usable else 0
        self.features = sorted(self.rng.choice(usable, size=size, replace=False).tolist()) if usable else []
        self.seed = int(self.rng.integers(1 << 62))
        self.gains.append([])

    @property
    def finished(self) -> bool:
        return len(self.trees) >= self.setting.rounds or not self.features

    def grow(self, g: np.ndarray, h: np.ndarray) -> None:
        """One level further, from sums by (open node, feature, bin); closes the tree if no node is left open."""
        tree, rate, following = self.tree, self.setting.learning_rate, {}
        for k, (node, (low, high)) in enumerate(sorted(self.open.items())):
            found = best_split(g[k], h[k], self.cuts, self.features, self.signs, self.setting, low, high)
            if found is None:
                if node == 0:
                    tree.value[0] = rate * float(leaf_weight(g[k][self.features[0]].sum(), h[k][self.features[0]].sum(), self.setting))
                continue
            self.gains[-1].append({"node": node, **found})
            f, (_, _, wl), (_, _, wr) = found["feature"], found["left"], found["right"]
            tree.feature[node], tree.bin[node], tree.missing_left[node] = f, found["bin"], found["missing_left"]
            middle = (wl + wr) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(self.signs[f], ((low, high), (low, high)))
            for child, w, bound in ((2 * node + 1, wl, bounds[0]), (2 * node + 2, wr, bounds[1])):
                tree.value[child] = rate * w
                following[child] = bound
        self.level += 1
        self.open = following if self.level < self.setting.max_depth else {}
        if not self.open:
            self.trees.append(tree)
            self.begin()


def _mixed(row: np.ndarray, seed: int) -> np.ndarray:
    """A number in 0 .. 1 for each row, by a hash of its key and the tree."""
    h = row.view(np.uint64) ^ np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(33))) >> np.uint64(11)) * 2.0 ** -53


def _bytes(column: pa.Array) -> np.ndarray:
    """Values of one length as lines of bytes."""
    _, places, data = column.buffers()
    places = np.frombuffer(places, dtype=np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8)[places[0]:places[-1]].reshape(len(column), -1)


def grow_all(rows: DataFrame, settings: Sequence[TreeSetting], cuts: Mapping[int, Sequence[Sequence[float]]], signs: Sequence[int], base: Mapping[int, float],
             seed: int = 42, refresh: int = REFRESH, patience=None) -> dict[tuple[int, int], Growing]:
    """Boosted trees of every fold and setting, all grown in the same passes over the rows: {(fold, setting): fit}.

    ``rows`` has ``fold``, ``r`` (a hash of the row's key, for sampling), ``y`` (0 or 1) and ``bins`` (see ``bin_rows``); ``cuts`` are each fold's
    cut points, ``base`` its first margin. The rows are packed once (see ``pack``). A pass walks the trees since the last refresh and sums slope and curvature of the log loss by
    (fit, open node, feature, bin), each fit at its own level of its own tree; the sums, at most fits x nodes x features x bins numbers
    however many rows there are, come to the driver, which chooses the splits. So there are as many passes as the longest fit has
    levels, and settings and folds add none. Margins are written to the shared folder every ``refresh`` passes.
    ``patience`` may say which fits to stop, given the fits and the rows; it is asked at each refresh.
    """
    size = {k: [len(c) for c in v] for k, v in cuts.items()}
    width, deep = len(signs), max(max(s) for s in size.values()) + 2 if size else 0
    fits = {(k, i): Growing(s, size[k], list(signs), np.random.default_rng([seed, k, i])) for k in sorted(cuts) for i, s in enumerate(settings)}
    rows = pack(rows)
    applied, stopped, passes = dict.fromkeys(fits, 0), set(), 0
    sums = T.StructType([T.StructField("k", T.LongType()), T.StructField("g", T.DoubleType()), T.StructField("h", T.DoubleType())])
    while True:
        live = {key: f for key, f in fits.items() if not f.finished and key not in stopped}
        if not live:
            break
        if passes and passes % refresh == 0:
            rows = refreshed(rows, fits, applied, size, base, len(settings))
            applied = {key: len(f.trees) for key, f in fits.items()}
            if patience is not None:
                stopped |= patience(fits)
                live = {key: f for key, f in live.items() if key not in stopped}
                if not live:
                    break
        plans = {key: (f.trees[applied[key]:], f.tree, sorted(f.open), f.features, f.setting.subsample, f.seed) for key, f in live.items()}
        order = {key: n for n, key in enumerate(sorted(live))}
        widest = max(len(p[2]) for p in plans.values())
        table = _sums(rows, plans, order, size, base, len(settings), widest, width, deep, sums).groupBy("k").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        place, g, h = (table.column(c).to_numpy() for c in ("k", "g", "h"))
        per_fit = widest * width * deep
        by = np.argsort(place // per_fit, kind="stable")
        edges = np.searchsorted((place // per_fit)[by], np.arange(len(order) + 1))
        for key, n in order.items():
            at = by[edges[n]:edges[n + 1]]
            full = np.zeros((2, per_fit))
            full[0, place[at] - n * per_fit], full[1, place[at] - n * per_fit] = g[at], h[at]
            live[key].grow(*full.reshape(2, widest, width, deep))
        passes += 1
    return fits


def _stepped(trees: Sequence[Tree]) -> list[tuple]:
    """Trees for ``walk``, with the value at the end of every way."""
    return [(levels, tree.value[ways]) for tree in trees for levels, ways in [tree.steps()]]


def _walked(steps: Sequence[tuple], bins: np.ndarray, cuts: np.ndarray, known: dict) -> np.ndarray:
    out = np.zeros(len(bins))
    for levels, values in steps:
        out += walk(levels, values, bins, cuts, known)
    return out


def _joint(cuts: Sequence[int], wanted: Collection[int]) -> list[list[int]]:
    """The features of ``wanted`` in groups with at most ``JOINT`` joint values; a feature with more is alone."""
    groups, count = [], JOINT + 1
    for f in sorted(wanted, key=lambda f: (cuts[f], f)):
        count *= cuts[f] + 2
        if count > JOINT:
            groups.append([])
            count = cuts[f] + 2
        groups[-1].append(f)
    return groups


def _sums(rows, plans, order, size, base, number, widest, width, deep, schema) -> DataFrame:
    """Sums of slope and curvature by (fit, open node, feature, bin). Features with few bins are summed by their joint value, a step for all of them;
    a task takes the sums of each from those at its end."""
    of = {k: {} for k, _ in plans}
    for (k, i), (trees, tree, nodes, features, part, seed) in plans.items():
        levels, ways = tree.steps()
        names = np.full(len(tree.feature), len(nodes), dtype=np.min_scalar_type(len(nodes)))  # after the open nodes come rows that are in none or left out
        names[nodes] = np.arange(len(nodes))
        of[k][i] = _stepped(trees), levels, names[ways], len(nodes), features, part, seed
    groups = {k: _joint(size[k], {f for plan in some.values() for f in plan[4]}) for k, some in of.items()}

    def add(batches):
        total = {}
        for batch in batches:
            for k, r, y, xk, margins in _blocks(batch, base, number, width):
                if k not in of:
                    continue
                cuts, codes, known = np.array(size[k]), [], {}
                for group in groups[k]:
                    code = xk[:, group[0]]
                    for f in group[1:]:
                        code = code * np.uint8(size[k][f] + 2) + xk[:, f]
                    codes.append(code)
                for i, (trees, levels, names, rest, features, part, seed) in of[k].items():
                    p = sigmoid(margins[:, i] + _walked(trees, xk, cuts, known))
                    g, h = p - y, p * (1 - p)
                    at = walk(levels, names, xk, cuts, known)
                    if part < 1:
                        at = np.where(_mixed(r, seed) < part, at, at.dtype.type(rest))
                    for n, (group, code) in enumerate(zip(groups[k], codes)):
                        if not any(f in features for f in group):
                            continue
                        cells = int(np.prod([size[k][f] + 2 for f in group])) * (rest + 1)
                        kind = np.min_scalar_type(cells)
                        cell = (code.astype(kind) * kind.type(rest + 1) + at).astype(np.intp)
                        found = np.array([np.bincount(cell, weights=v, minlength=cells) for v in (g, h)])
                        total[k, i, n] = total[k, i, n] + found if (k, i, n) in total else found
        for k, i in sorted({key[:2] for key in total}):
            rest, features = of[k][i][3:5]
            both = np.zeros((2, widest, width, deep))
            for n, group in enumerate(groups[k]):
                if (k, i, n) in total:
                    shape = [size[k][f] + 2 for f in group]
                    found = total[k, i, n].reshape(2, *shape, rest + 1)[..., :-1]
                    for axis, f in enumerate(group):
                        if f in features:
                            one = found.sum(axis=tuple(1 + a for a in range(len(group)) if a != axis))
                            both[:, :rest, f, :shape[axis]] = one.transpose(0, 2, 1)
            flat = both.reshape(2, -1)
            at = np.flatnonzero(flat[1])
            yield pa.RecordBatch.from_arrays([pa.array(at + order[k, i] * flat.shape[1]), pa.array(flat[0, at]), pa.array(flat[1, at])], names=["k", "g", "h"])
    sampled = any(plan[4] < 1 for plan in plans.values())
    return (rows if sampled else rows.withColumn("r", F.lit(None).cast("binary"))).mapInArrow(add, schema)


def _now(k, bins, margins, fresh, size) -> np.ndarray:
    """Margins of a block with the trees of ``fresh`` added."""
    out, known = margins.copy(), {}
    for (of, i), trees in fresh.items():
        if of == k and trees:
            out[:, i] += _walked(trees, bins, np.array(size[k]), known)
    return out


def refreshed(rows, fits, applied, size, base, number) -> DataFrame:
    """The packed rows with margins that hold all finished trees, written and read back."""
    fresh = {key: _stepped(f.trees[applied[key]:]) for key, f in fits.items()}

    def run(batches):
        for batch in batches:
            made = [_now(k, bins, margins, fresh, size).tobytes() for k, _, _, bins, margins in _blocks(batch, base, number)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(made, pa.binary())], names=batch.schema.names)

    return materialize(rows.mapInArrow(run, rows.schema), "margins", BLOCK_BYTES)


def scored(rows, fits, size, base, number) -> DataFrame:
    """Packed rows one by one with the probability ``p`` under each finished fit: ``fold``, ``setting``, ``y``, ``p``."""
    fresh = {key: _stepped(f.trees) for key, f in fits.items()}

    def run(batches):
        for batch in batches:
            for k, _, y, bins, margins in _blocks(batch, base, number):
                p = sigmoid(_now(k, bins, margins, fresh, size))
                for i in range(number):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), k), pa.int32()), pa.array(np.full(len(y), i), pa.int32()), pa.array(y), pa.array(p[:, i])],
                                                     names=["fold", "setting", "y", "p"])

    schema = T.StructType([T.StructField(c, T.IntegerType()) for c in ("fold", "setting")] + [T.StructField(c, T.DoubleType()) for c in ("y", "p")])
    return rows.mapInArrow(run, schema)


def stepped(rows: DataFrame, trees: Sequence[Tree], sizes: Sequence[int], base: float) -> DataFrame:
    """Packed rows of one fit once for each of ``trees``: ``round``, ``y`` and the probability ``p`` after it. ``rows`` hold the margin before."""
    steps = _stepped(trees)

    def run(batches):
        for batch in batches:
            for _, _, y, bins, margins in _blocks(batch, {0: base}, 1):
                margin, known = margins[:, 0], {}
                for number, (levels, values) in enumerate(steps):
                    margin = margin + walk(levels, values, bins, np.array(sizes), known)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(margin), number), pa.int32()), pa.array(y), pa.array(sigmoid(margin))],
                                                     names=["round", "y", "p"])

    schema = T.StructType([T.StructField("round", T.IntegerType()), T.StructField("y", T.DoubleType()), T.StructField("p", T.DoubleType())])
    return rows.mapInArrow(run, schema)


# ---- the fitted model -----------------------------------------------------------------------------------------------
@dataclass
class BoostedTrees:
    """A fitted model on the array of inputs: trees with cut values, and the first margin. ``gains`` tell each split's gain."""

    names: list[str]
    cuts: list[list[float]]
    trees: list[Tree]
    base: float
    signs: list[int]

    def margins(self, x: np.ndarray, upto: int | None = None) -> np.ndarray:
        """Log-odds of rows of inputs by the first ``upto`` trees; NaN is missing."""
        bins = self.binned(x)
        return self.base + _walked(_stepped(self.trees[:upto]), bins, np.array([len(c) for c in self.cuts]), {})

    def binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, dtype=np.uint8, order="F")
        for f, cut in enumerate(self.cuts):
            out[:, f] = _numbered(x[:, f], np.array(cut))
        return out

    def margin(self, inputs: Column) -> Column:
        """Log-odds as a column, from an array column of the inputs; evaluated on Arrow batches."""
        model = self

        @F.pandas_udf("double")
        def walk(*x: pd.Series) -> pd.Series:
            return pd.Series(model.margins(np.column_stack([v.to_numpy(dtype=float) for v in x])))

        return walk(*[F.get(inputs, F.lit(i)) for i in range(len(self.names))])

    def table(self, spark: SparkSession) -> DataFrame:
        """One row for each node: split (feature, cut, where missing goes) or value."""
        rows = []
        for t, tree in enumerate(self.trees):
            reached = {0}
            for node in range(len(tree.feature)):
                if node not in reached:
                    continue
                f = int(tree.feature[node])
                if f >= 0:
                    reached |= {2 * node + 1, 2 * node + 2}
                rows.append((t, node, self.names[f] if f >= 0 else None, float(self.cuts[f][tree.bin[node]]) if f >= 0 else None,
                             bool(tree.missing_left[node]) if f >= 0 else None, None if f >= 0 else float(tree.value[node])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, cut double, missing_left boolean, value double")

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {"names": self.names, "cuts": self.cuts, "base": self.base, "signs": self.signs,
                "trees": [[t.feature.tolist(), t.bin.tolist(), t.missing_left.tolist(), t.value.tolist()] for t in self.trees]}
        write_table(spark.createDataFrame([(json.dumps(meta),)], "model string"), path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        meta = json.loads(spark.read.parquet(path).first()["model"])
        trees = [Tree(np.array(f, dtype=np.int16), np.array(b, dtype=np.int16), np.array(m, dtype=bool), np.array(v)) for f, b, m, v in meta.pop("trees")]
        return BoostedTrees(trees=trees, **meta)
