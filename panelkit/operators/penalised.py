"""Penalised logistic regression for many penalties and folds at once: each pass over the rows serves all fits."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the functions that run in tasks travel with the job


#: Bytes of a row group of packed rows, of which a task holds one.
BLOCK_BYTES = 16 << 20


@dataclass(frozen=True)
class Fit:
    """Coefficients and intercept of one fold and setting, the passes it took, and whether the optimality conditions hold."""

    coefficients: np.ndarray
    intercept: float
    passes: int
    converged: bool


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def pack_numbers(rows: DataFrame, width: int) -> DataFrame:
    """Rows in blocks of one fold, written and read back: ``fold``, and ``x`` (``width`` numbers a row) and ``y`` of all rows of a block as bytes.

    The numbers travel as columns and, in each later pass, as a few long values: an array column costs many times as much on its way to Python.
    """
    def run(batches):
        for batch in batches:
            fold, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]) if width else np.empty((len(y), 0))
            for k in np.unique(fold).tolist():
                here = fold == k
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *[pa.array([v[here].tobytes()], pa.binary()) for v in (x, y)]], names=["fold", "x", "y"])

    schema = T.StructType([T.StructField("fold", T.IntegerType()), T.StructField("x", T.BinaryType()), T.StructField("y", T.BinaryType())])
    flat = rows.select(F.col("fold").cast("int"), F.col("y").cast("double"), *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(width)])
    return materialize(flat.mapInArrow(run, schema), "numbers", BLOCK_BYTES)


def _moments(rows: DataFrame, weights: dict[int, dict[int, np.ndarray]], width: int) -> dict[int, dict[int, tuple]]:
    """Loss, gradient and curvature of every open fit at its weights, and the rows of its fold: {fold: {fit: (n, loss, gradient, curvature)}}.

    One aggregate: a task sends one number for each entry of the wanted tables, whatever rows it has read, and the entries are added by place.
    """
    size = width + 1
    upper = np.triu_indices(size)
    per_fit = 1 + size + len(upper[0])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                if k not in weights:
                    continue
                yk, w = np.frombuffer(y), np.array(list(weights[k].values()))
                xk = np.column_stack([np.frombuffer(x).reshape(len(yk), width), np.ones(len(yk))])
                margin = xk @ w.T
                p = sigmoid(margin)
                loss = (np.logaddexp(0, margin) - yk[:, None] * margin).sum(axis=0)
                gradient = (p - yk[:, None]).T @ xk
                curvature = np.array([(xk.T @ (xk * c[:, None]))[upper] for c in (p * (1 - p)).T])
                found = np.r_[len(yk), np.column_stack([loss, gradient, curvature]).reshape(-1)]
                total[k] = total[k] + found if k in total else found
        for k, found in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k), pa.int32()), pa.array(np.arange(len(found)), pa.int32()), pa.array(found)],
                                             names=["fold", "at", "value"])

    schema = T.StructType([T.StructField("fold", T.IntegerType()), T.StructField("at", T.IntegerType()), T.StructField("value", T.DoubleType())])
    table = rows.mapInArrow(add, schema).groupBy("fold", "at").agg(F.sum("value").alias("value")).toArrow()
    folds, at, value = (table.column(c).to_numpy() for c in ("fold", "at", "value"))
    out: dict[int, dict[int, tuple]] = {}
    for k, fits in weights.items():
        flat = np.zeros(1 + per_fit * len(fits))
        flat[at[folds == k]] = value[folds == k]
        for fit, told in zip(fits, flat[1:].reshape(len(fits), per_fit)):
            full = np.zeros((size, size))
            full[upper] = told[1 + size:]
            out.setdefault(k, {})[fit] = (flat[0], told[0], told[1:1 + size], full + np.triu(full, 1).T)
    return out


def _penalty(w: np.ndarray, l2: np.ndarray, l1: np.ndarray) -> np.ndarray:
    return l2 / 2 * (w[:, :-1] ** 2).sum(axis=1) + l1 * np.abs(w[:, :-1]).sum(axis=1)


def unmet(w, slope, l1, low, high) -> np.ndarray:
    """How far each coefficient is from the optimality conditions: the part of the loss's slope that neither the L1 term nor a bound holds."""
    down, up = slope + l1 * np.where(w > 0, 1, -1), slope + l1 * np.where(w < 0, -1, 1)  # slopes to the left and to the right
    return np.maximum(np.where(w > low, down, 0), np.maximum(np.where(w < high, -up, 0), 0))


def _newton(w, gradient, curvature, l2, l1, low, high, sweeps: int = 500) -> np.ndarray:
    """Least of the quadratic model plus penalty within the bounds, by coordinate descent with soft thresholds, for all fits side by side."""
    new, size = w.copy(), w.shape[1]
    slope = gradient.copy()  # of the quadratic model at ``new``
    for _ in range(sweeps):
        moved = np.zeros(len(w))
        for j in range(size):
            bend = curvature[:, j, j] + (l2 if j < size - 1 else 0)
            safe = np.where(bend > 0, bend, 1)
            aim = curvature[:, j, j] * new[:, j] - slope[:, j]
            best = np.clip(np.sign(aim) * np.maximum(np.abs(aim) - (l1 if j < size - 1 else 0), 0) / safe, low[j], high[j])
            step = np.where(bend > 0, best - new[:, j], 0)
            slope += curvature[:, :, j] * step[:, None]
            new[:, j] += step
            moved = np.maximum(moved, np.abs(step))
        if moved.max() < 1e-12:
            break
    return new


def fit_all(rows: DataFrame, settings: Sequence[tuple[float, float]], width: int, bounds: Sequence[tuple[float, float]] | None = None,
            tolerance: float = 1e-10, max_passes: int = 100) -> dict[int, list[Fit]]:
    """Logistic regressions for every fold and (C, share of L1) setting: {fold: a fit per setting}.

    ``rows`` has ``fold``, ``x`` (``width`` numbers) and ``y`` (0 or 1). Each fit minimises the summed log loss of its fold's rows times C plus
    the penalty, (1 - share) / 2 * sum of squares + share * sum of absolute values; the intercept is free, the others stay in
    ``bounds`` (which hold zero). Proximal Newton steps: one
    pass over the rows, which are packed once, gives loss, slope and curvature of all fits that are still open, then each takes its step on the
    driver, where it has only (width + 1)^2 numbers a fit. A step that does not lower the loss is halved. So all penalties
    and folds together take about as many passes as the slowest alone, some ten. Fits that have not met the optimality conditions within ``max_passes``
    say so in ``converged``.
    """
    rows = pack_numbers(rows, width)
    folds = sorted(r[0] for r in rows.select("fold").distinct().collect())  # one number a fold
    share = np.array([s for _, s in settings])
    low, high = (np.array([b[side] for b in bounds] + [(-np.inf, np.inf)[side]] if bounds else [(-np.inf, np.inf)[side]] * (width + 1)) for side in (0, 1))
    current = {k: np.zeros((len(settings), width + 1)) for k in folds}
    trial = {k: v.copy() for k, v in current.items()}
    best = {k: np.full(len(settings), np.inf) for k in folds}
    passes = {k: np.zeros(len(settings), dtype=int) for k in folds}
    done = {k: np.zeros(len(settings), dtype=bool) for k in folds}
    for number in range(1, max_passes + 1):
        wanted = {k: {i: trial[k][i] for i in np.flatnonzero(~done[k]).tolist()} for k in folds if not done[k].all()}
        if not wanted:
            break
        for k, fits in _moments(rows, wanted, width).items():
            at = np.array(list(fits))
            n = max(next(iter(fits.values()))[0], 1.0)
            strength = 1 / (np.array([settings[i][0] for i in at]) * n)
            l1, l2 = share[at] * strength, (1 - share[at]) * strength
            loss, gradient, curvature = (np.array([fits[i][part] for i in at]) / n for part in (1, 2, 3))
            w = trial[k][at]
            goal = loss + _penalty(w, l2, l1)
            passes[k][at] = number
            better = goal <= best[k][at] + 1e-14 * np.abs(goal)
            trial[k][at[~better]] = (current[k][at[~better]] + w[~better]) / 2  # too far: half the way
            at, w, l1, l2, gradient, curvature, goal = (v[better] for v in (at, w, l1, l2, gradient, curvature, goal))
            if not len(at):
                continue
            current[k][at], best[k][at] = w, goal
            slope, held = gradient.copy(), np.column_stack([np.repeat(l1[:, None], width, axis=1), np.zeros(len(at))])
            slope[:, :-1] += l2[:, None] * w[:, :-1]
            done[k][at] = unmet(w, slope, held, low, high).max(axis=1) <= tolerance
            trial[k][at] = _newton(w, gradient, curvature, l2, l1, low, high)
    return {k: [Fit(w[:-1].copy(), float(w[-1]), int(p), bool(c)) for w, p, c in zip(current[k], passes[k], done[k])] for k in folds}


@dataclass(frozen=True)
class LinearModel:
    """A fitted model on an array of inputs."""

    names: list[str]
    coefficients: list[float]
    intercept: float

    def margin(self, inputs: Column) -> Column:
        """Log-odds from an array column of the inputs."""
        weights = F.array(*[F.lit(float(w)) for w in self.coefficients])
        return F.aggregate(F.zip_with(inputs, weights, lambda x, w: x * w), F.lit(float(self.intercept)), lambda total, v: total + v)
