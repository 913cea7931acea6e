"""Embedding whitening: leading eigenvectors of the covariance by block Jacobi-Davidson; the vectors are only read by centred products."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.session import materialize

#: A residual is down to rounding at so many units in the last place of the largest eigenvalue.
UNITS = 64
#: Steps of the inner solver for each correction, and rounds after which the search ends in any case.
INNER, ROUNDS = 4, 60
#: Numbers of vectors that a task works on at once.
BATCH = 1 << 20
#: A scaled entry beyond this is taken as this (2^40 times any likely one): sums over all rows stay whole numbers of 64 bits.
LARGEST = 1 << 40


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` vectors: sums of each dimension, eigenvalues of the covariance, unit eigenvectors (one a column), and its trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id`` and ``x`` (scaled whole numbers) of the rows that can be fitted: the vector is not null or empty, has no null, NaN or infinite
    entries, and is as long as most (of two lengths equally common the longer). Written to the shared folder."""
    entry = F.col("vector")
    fits = (F.size(entry) > 0) & ~F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(F.coalesce(fits, F.lit(False)))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    x = F.transform("vector", lambda c: F.floor(F.greatest(F.least(c * 1024, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("long") + 100000)
    return materialize(rows.filter(F.size("vector") == size).select("id", x.alias("x")), "vectors")


def _matrices(batches, column: int):
    """The batches in pieces, with column number ``column`` as a matrix."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, BATCH // len(batch.column(column)[0]))
        for row in range(0, batch.num_rows, step):
            part = batch.slice(row, step)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x minus the mean, from whole numbers: n * x - S is exact while it fits 53 bits, so only the division rounds."""
    return (n * x - sums).astype(np.float64) / n


def _summed(rows: DataFrame, run, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over all tasks of the arrays that ``run`` makes of its batches; each sends one, numbers are added up by place."""
    width = int(np.prod(shape))

    def send(batches):
        total = run(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total.reshape(-1))], names=["at", "value"])

    schema = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("value", T.DoubleType())])
    table = rows.select("x").mapInArrow(send, schema).groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(width)
    out[table.column("at").to_numpy()] = table.column("value").to_numpy()
    return out.reshape(shape)


class Covariance:
    """The covariance as an operator: each product is one pass over the vectors, for all columns of a block together."""

    def __init__(self, rows: DataFrame, n: int, sums: list[int]):
        self.rows, self.n, self.sums, self.size, self.passes = rows, n, np.array(sums, dtype=np.int64), len(sums), 0

    def __matmul__(self, block: np.ndarray) -> np.ndarray:
        n, sums = self.n, self.sums
        self.passes += 1

        def product(batches):
            total = None
            for _, x in _matrices(batches, 0):
                c = _centred(x, n, sums)
                part = c.T @ (c @ block)
                total = part if total is None else total + part
            return None if total is None else total / n

        return _summed(self.rows, product, block.shape)

    def trace(self) -> float:
        n, sums = self.n, self.sums

        def squares(batches):
            total = None
            for _, x in _matrices(batches, 0):
                total = (total if total is not None else 0.0) + (_centred(x, n, sums) ** 2).sum()
            return None if total is None else np.array([total / n])

        return float(_summed(self.rows, squares, (1,))[0])


def _against(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal directions of ``block`` outside the bases; what the bases already hold is left out."""
    for _ in range(2):
        for basis in bases:
            block = block - basis @ (basis.T @ block)
        length = np.linalg.norm(block, axis=0)
        block = block[:, length > 0] / length[length > 0]
    out = np.zeros((len(block), 0))
    for k in range(block.shape[1]):
        column = block[:, k]
        for _ in range(2):
            for basis in (*bases, out):
                column = column - basis @ (basis.T @ column)
        length = np.linalg.norm(column)
        if length > 1e-8 and sum(b.shape[1] for b in (*bases, out)) < len(block):
            out = np.column_stack([out, column / length])
    return out


def _corrections(apply, values: np.ndarray, right: np.ndarray, hidden: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions t of (I - QQ')(V - theta I)(I - QQ') t = right, one column and theta each, by MINRES: all columns take their
    steps side by side, so a step is one product with a block. ``hidden`` is Q."""
    outside = lambda b: b - hidden @ (hidden.T @ b)
    right = outside(right)
    beta = np.linalg.norm(right, axis=0)
    live = beta > 0
    t, v_old, w_old, w_older = (np.zeros_like(right) for _ in range(4))
    v = np.divide(right, beta, out=np.zeros_like(right), where=live)
    eta, c, c_old, s, s_old = beta.copy(), np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    below = np.zeros_like(beta)
    for _ in range(steps):
        p = outside(apply(v)) - values * v
        alpha = (v * p).sum(axis=0)
        p = outside(p - alpha * v - below * v_old)
        above = np.linalg.norm(p, axis=0)
        # the tridiagonal matrix's next column, turned by the last two rotations and by a new one
        delta, gap, far = c * alpha - c_old * s * below, s * alpha + c_old * c * below, s_old * below
        length = np.hypot(delta, above)
        live = live & (length > 0)
        safe = np.where(live, length, 1.0)
        c_old, s_old, c, s = c, s, np.where(live, delta / safe, 1.0), np.where(live, above / safe, 0.0)
        w = np.where(live, (v - gap * w_old - far * w_older) / safe, 0.0)
        t += np.where(live, c * eta * w, 0.0)
        eta = -s * eta
        v_old, w_older, w_old, below = v, w_old, w, above
        live = live & (above > 1e-14 * np.maximum(beta, 1e-300))
        v = np.where(live, p / np.where(above > 0, above, 1.0), 0.0)
        if not live.any():
            break
    return outside(t)


def leading_eigenvectors(matrix, wanted: int, guard: int = 2, inner: int = INNER, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues and unit eigenvectors of a symmetric operator without negative eigenvalues; fewer if it has no more
    above rounding. ``matrix`` has ``size`` and multiplies blocks.

    Block Jacobi-Davidson: a search space is kept orthonormal together with its products; Rayleigh-Ritz inside it gives the next
    best pairs; a pair whose residual is down to rounding is locked and the search goes on outside of it; for
    the others correction equations, projected outside of all current pairs, are solved by a few steps of MINRES, and the solutions
    widen the space. When it is too wide it is cut back to the best pairs. At the end one more product refines the locked
    pairs among themselves, and pairs that turn out not to be down to rounding go back into the search.
    """
    size = matrix.size
    wanted = min(wanted, size)
    width = min(size, wanted + guard)
    widest = max(4 * width, 24)
    space = _against(np.random.default_rng(seed).normal(size=(size, width)))
    image = matrix @ space
    locked, values = np.zeros((size, 0)), np.zeros(0)
    locked_image = np.zeros((size, 0))
    top = 0.0
    for _ in range(ROUNDS):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        top = max(top, float(theta[0]) if len(theta) else 0.0, float(values.max()) if len(values) else 0.0)
        left = min(wanted - len(values), len(theta))
        residual = image - space * theta
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        bound = UNITS * np.finfo(float).eps * top
        whole = locked.shape[1] + space.shape[1] >= size
        good = 0
        while good < left and (norms[good] <= bound or whole):
            good += 1
        if good:
            locked, locked_image = np.column_stack([locked, space[:, :good]]), np.column_stack([locked_image, image[:, :good]])
            values = np.r_[values, theta[:good]]
            space, image, residual, theta = space[:, good:], image[:, good:], residual[:, good:], theta[good:]
        if len(values) >= wanted or whole or not space.shape[1]:
            small = locked.T @ (locked_image := matrix @ locked)
            theta, turn = np.linalg.eigh((small + small.T) / 2)
            values, locked, locked_image = theta[::-1], locked @ turn[:, ::-1], locked_image @ turn[:, ::-1]
            norms = np.linalg.norm(locked_image - locked * values, axis=0)
            if whole or (norms <= 2 * bound).all():
                break
            back = norms > 2 * bound
            space, image = np.column_stack([locked[:, back], space]), np.column_stack([locked_image[:, back], image])
            locked, locked_image, values = locked[:, ~back], locked_image[:, ~back], values[~back]
            continue
        if space.shape[1] + width > widest:
            space, image, residual, theta = space[:, :2 * width], image[:, :2 * width], residual[:, :2 * width], theta[:2 * width]
        near = min(width - len(values), space.shape[1])
        hidden = np.column_stack([locked, space[:, :near]])
        t = _corrections(lambda b: matrix @ b, theta[:near], -residual[:, :near], hidden, inner)
        more = _against(np.column_stack([t, residual[:, :near]]), locked, space)[:, :max(near, 1)]
        if not more.shape[1]:  # nothing new in these directions
            more = _against(np.random.default_rng(seed + space.shape[1]).normal(size=(size, 1)), locked, space)
        space, image = np.column_stack([space, more]), np.column_stack([image, matrix @ more])
    order = np.argsort(-values, kind="stable")[:wanted]
    values, locked = values[order], locked[:, order]
    real = values > size * UNITS * np.finfo(float).eps * top
    return values[real], locked[:, real]


def fit_whitening(vectors: DataFrame, components: int = 8) -> Whitening:
    """Fit on all rows of ``whole_vectors``: exact sums, then the ``components`` largest eigenvalues of the covariance (divisor n) and their
    eigenvectors, to double precision; as many as the rank if it is less, so none for fewer than two different vectors.

    Passes over the vectors: one for the sums, one for the trace, and one for each product of the solver, about 60 for 64 dimensions. A task
    sends one number for each entry of the block, whatever it has read; on the driver are the search space and its products, bounded by the
    dimension.
    """
    def add(batches):
        total = None
        for part, x in _matrices(batches, 0):
            here = np.r_[part.num_rows, x.sum(axis=0)]
            total = here if total is None else total + here
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["at", "value"])

    schema = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("value", T.LongType())])
    told = vectors.select("x").mapInArrow(add, schema).groupBy("at").agg(F.sum("value").alias("value")).collect()
    counted = [value for _, value in sorted((r.at, r.value) for r in told)]
    if not counted:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 1)
    matrix = Covariance(vectors, counted[0], counted[1:])
    trace = matrix.trace()
    values, found = leading_eigenvectors(matrix, components) if trace > 0 else (np.zeros(0), np.zeros((matrix.size, 0)))
    return Whitening(counted[0], counted[1:], values, found, trace, matrix.passes + 2)


def _whitened(x: np.ndarray, model: Whitening, sums: np.ndarray) -> np.ndarray:
    return _centred(x, model.n, sums) @ model.vectors / np.sqrt(model.values)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened values minus the identity, measured in one more pass; 0 without components."""
    size = len(model.values)
    if not size:
        return 0.0
    sums = np.array(model.sums, dtype=np.int64)

    def moments(batches):
        total = None
        for _, x in _matrices(batches, 0):
            w = _whitened(x, model, sums)
            part = np.vstack([w.sum(axis=0), w.T @ w])
            total = part if total is None else total + part
        return None if total is None else total / model.n

    found = _summed(vectors, moments, (size + 1, size))
    return float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(size)).max())


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int] | np.ndarray:
    """Sum over dimensions of (n * x - S)^2 of each row, exact; in numbers of any length where 64 bits might not do."""
    reach = n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0))
    if reach < 1 << 62:
        d = n * x - sums
        if int(np.abs(d).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
            return (d * d).sum(axis=1)
    d = n * x.astype(object) - sums.astype(object)
    return (d * d).sum(axis=1)


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """One row for each vector and component (from 1, by falling eigenvalue): ``id``, ``component``, ``deviation`` (sum over dimensions of
    (n * x - S)^2, exact) and ``whitened`` (x minus the mean, projected on the component, over the root of its eigenvalue).
    Repeated rows and rows without an id are rows like any other; no rows if the model has no components."""
    sums, size = np.array(model.sums, dtype=np.int64), len(model.values)
    schema = T.StructType([vectors.schema["id"], T.StructField("component", T.IntegerType()), T.StructField("deviation", T.DecimalType(38, 0)),
                           T.StructField("whitened", T.DoubleType())])

    def run(batches):
        for part, x in _matrices(batches, 1) if size else ():
            rows = pa.array(np.repeat(np.arange(part.num_rows), size))
            found = _deviations(x, model.n, sums)
            exact = pa.array([Decimal(int(d)) for d in found], pa.decimal128(38, 0)) if found.dtype == object else pa.array(found).cast(pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([part.column(0).take(rows), pa.array(np.tile(np.arange(1, size + 1), part.num_rows), pa.int32()),
                                              exact.take(rows), pa.array(_whitened(x, model, sums).reshape(-1))], names=schema.names)

    return vectors.select("id", "x").mapInArrow(run, schema)
