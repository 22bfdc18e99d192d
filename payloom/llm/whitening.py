"""Embedding whitening: distributed covariance, float32 eigenvectors refined in high precision.

1. Every component ``c`` becomes the integer ``x = floor(scale * c) + shift``.  The fit list
   is each distinct integer vector once.
2. Sums of the fit list are integers, and so are the products of its vectors centred at
   their rounded mean: both are added up exactly, in any order.  The rest of the mean is
   taken off in whole numbers too, so the covariance has no rounding until its last division.
3. A float32 eigensolver gives a first basis.  Ogita-Aishima steps, which are a few matrix
   products in extended precision, correct basis and eigenvalues at a quadratic rate.
   Eigenvalues too close together for the step are a cluster: the covariance, shifted by the
   cluster's mean and projected on its vectors, is solved apart and turns them.
4. All rows are projected on the leading components.

Vectors that are null or hold null or non-finite entries, or an entry whose integer has more
than 40 bits, give no row; zero vectors do.  Vectors of different lengths are different
spaces with a fit list each.  Repeated rows give rows each but count once in the fit list,
and an id may be null.  A component without variance (fewer distinct vectors than
components, say) has explained 0 and whitened null and stays out of the identity error; a
deviation beyond 64 bits is null.  An empty table gives no row.  Only ``vec_id`` and
``embedding`` are read.  The driver and the tasks hold matrices of a vector's length squared.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payloom.llm.common import map_batches
from payloom.llm.vectors import matrix
from payloom.session import settle

HIGH = np.longdouble
SCALE, SHIFT, WIDEST = 64, 1_000_000, 1 << 40


# -- eigenvectors --------------------------------------------------------------------


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima step: better basis, eigenvalues, cluster distance, size of the correction."""
    r = np.eye(x.shape[1], dtype=x.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    apart = 2 * (np.linalg.norm((s - np.diag(values)).astype(float)) + np.linalg.norm(a.astype(float)) * np.linalg.norm(r.astype(float)))
    gap = values[None, :] - values[:, None]
    far = np.abs(gap) > apart
    e = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
    return x + x @ e, values, apart, float(np.abs(e).max())


def clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow one another at no more than ``apart``, two or more."""
    order = np.argsort(values, kind="stable")
    cut = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [part for part in np.split(order, cut) if len(part) > 1]


def eigen(a: np.ndarray, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Starts from float32 vectors and refines them in the precision of ``a``.
    """
    size = float(np.abs(a).max()) if a.size else 0.0
    if not size:
        return np.zeros(len(a), a.dtype), np.eye(len(a), dtype=a.dtype)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(a.dtype)
    eps, last = float(np.finfo(a.dtype).eps), np.inf
    for turn_no in range(steps):
        x, values, apart, change = _step(a, x)
        # below the rounding, or no longer getting smaller
        if change <= 8 * len(a) * eps or (turn_no > 5 and change > last / 2):
            break
        last, apart = change, apart + 8 * len(a) * eps
        for at in clusters(values, apart):
            # within a cluster the step only makes the vectors orthogonal; the shifted block says how to turn them
            y = x[:, at]
            middle = values[at].mean()
            block = y.T @ (a @ y - middle * y)
            top = np.abs(block).max()
            if top > 0:
                turn = np.linalg.eigh(((block + block.T) / (2 * top)).astype(float))[1]
                x[:, at] = y @ turn.astype(a.dtype)
    for _ in range(2):
        x = x @ (1.5 * np.eye(len(a), dtype=a.dtype) - x.T @ x / 2)
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


# -- the fit list --------------------------------------------------------------------


def whole(c: Column, scale: int, shift: int) -> Column:
    return F.transform(c, lambda v: F.floor(v * scale) + shift)


def usable(vectors: DataFrame, scale: int, shift: int) -> DataFrame:
    """``(id, x)``: integer vectors of the rows that take part."""
    c = F.col("c")
    fits = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * scale + abs(shift) < WIDEST))
    rows = vectors.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("c"))
    rows = rows.where(F.coalesce(fits, F.lit(False)) & (F.size(c) > 0))
    return rows.select("id", whole(c, scale, shift).alias("x"))


def by_length(batches, column: int):
    """``(d, rows as integers, their places in the batch, batch)`` for each vector length of a batch."""
    for batch in batches:
        lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            yield int(d), matrix(batch.column(column).take(pa.array(at))).astype(np.int64), at, batch


def _summed(df: DataFrame, work, keys: str) -> dict[int, list]:
    """Adds up the whole numbers that tasks give for each place; at most a matrix per length."""
    parts = map_batches(df, work, f"{keys}, total decimal(38,0)")
    names = [k.split()[0] for k in keys.split(", ")]
    found = defaultdict(list)
    for row in parts.groupBy(*names).agg(F.sum("total").alias("total")).collect():
        found[row.d].append((*row[1:-1], int(row.total)))
    return found


def _cells(keys: list[str], rows: list[tuple]) -> pa.RecordBatch:
    *places, totals = zip(*rows)
    columns = [pa.array(p, pa.int32()) for p in places]
    return pa.RecordBatch.from_arrays([*columns, pa.array([int(t) for t in totals], pa.decimal128(38, 0))], names=[*keys, "total"])


def sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sum of each dimension, per length."""

    def work(batches):
        held: dict[int, np.ndarray] = {}
        for d, x, _, _ in by_length(batches, 0):
            row = np.append(x.sum(axis=0), len(x)).astype(object)
            held[d] = held.get(d, 0) + row
        for d, row in held.items():
            yield _cells(["d", "i"], [(d, i, t) for i, t in enumerate(row)])

    return {
        d: (dict(cells)[d], [dict(cells)[i] for i in range(d)]) for d, cells in _summed(fit, work, "d int, i int").items()
    }


def exact_products(c: np.ndarray) -> np.ndarray:
    """``c.T @ c`` of whole numbers without rounding: floats while they hold it, else Python integers."""
    top = int(np.abs(c).max(initial=0))
    if top * top * len(c) < 1 << 53:
        f = c.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    most = (1 << 53) // (top * top) if top else len(c)
    if most >= 1:
        return sum((exact_products(c[i : i + most]) for i in range(0, len(c), most)), 0)
    whole_numbers = c.astype(object)
    return whole_numbers.T @ whole_numbers


def covariances(fit: DataFrame, known: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """Covariance per length, divisor n, each entry rounded once."""
    centre = {d: [(2 * s + n) // (2 * n) for s in total] for d, (n, total) in known.items()}

    def work(batches):
        held: dict[int, np.ndarray] = {}
        for d, x, _, _ in by_length(batches, 0):
            held[d] = held.get(d, 0) + exact_products(x - np.array(centre[d], np.int64))
        for d, table in held.items():
            for i in range(d):
                yield _cells(["d", "i", "j"], [(d, i, j, table[i, j]) for j in range(i, d)])

    out = {}
    for d, cells in _summed(fit, work, "d int, i int, j int").items():
        n, total = known[d]
        rest = [s - n * m for s, m in zip(total, centre[d])]
        v = np.zeros((d, d), HIGH)
        for i, j, products in cells:
            # n * n * covariance is a whole number
            v[i, j] = v[j, i] = _divided(n * products - rest[i] * rest[j], n * n)
        out[d] = v
    return out


def _divided(a: int, b: int) -> np.longdouble:
    whole_part, rest = divmod(a, b)
    return HIGH(whole_part) + HIGH(rest) / HIGH(b)


# -- whitening -----------------------------------------------------------------------


class Space:
    """What whitening needs of one vector length."""

    def __init__(self, n: int, total: list[int], v: np.ndarray, components: int):
        self.n, self.total, d = n, total, len(total)
        self.centre = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)
        rest = [s - n * int(m) for s, m in zip(total, self.centre)]
        self.rest = np.array([float(_divided(r, n)) for r in rest])
        self.rest_sums = rest
        values, vectors = eigen(v)
        trace = float(np.trace(v))
        k = min(components, d)
        floor = trace * 64 * d * float(np.finfo(HIGH).eps)
        self.alive = np.array([float(e) > floor for e in values[:k]], bool)
        safe = np.where(self.alive, values[:k], 1)
        self.turn = np.where(self.alive, vectors[:, :k] / np.sqrt(safe), 0).astype(float)
        self.explained = np.array([max(float(e), 0.0) / trace if trace else 0.0 for e in values[:k]])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) - self.rest) @ self.turn

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """``sum((n x - S) ** 2)`` without rounding."""
        near = x - self.centre
        top = self.n * (int(np.abs(near).max(initial=0)) + 1)
        kind = np.int64 if top * top * x.shape[1] < 1 << 63 else object
        lengths = self.n * near.astype(kind) - np.array(self.rest_sums, kind)
        return [int(s) if s < 1 << 63 else None for s in (lengths * lengths).sum(axis=1)]


def identity_errors(fit: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """Largest entry of the whitened fit list's covariance minus the identity, per length."""
    shared = fit.sparkSession.sparkContext.broadcast(spaces)

    def work(batches):
        held: dict[int, np.ndarray] = {}
        for d, x, _, _ in by_length(batches, 0):
            w = shared.value[d].whitened(x)
            held[d] = held.get(d, 0) + w.T @ w
        for d, table in held.items():
            yield pa.RecordBatch.from_pydict({"d": pa.array([d], pa.int32()), "w": [table.ravel().tolist()]})

    parts = map_batches(fit, work, "d int, w array<double>")
    cells = parts.select("d", F.posexplode("w").alias("i", "w")).groupBy("d", "i").agg(F.sum("w").alias("w"))
    found = defaultdict(dict)
    for row in cells.collect():  # a small matrix per length
        found[row.d][row.i] = row.w
    out = {}
    for d, entries in found.items():
        space = spaces[d]
        k = len(space.alive)
        table = np.array([entries[i] for i in range(k * k)]).reshape(k, k) / space.n
        alive = space.alive
        out[d] = float(np.abs(table - np.eye(k))[np.ix_(alive, alive)].max(initial=0.0))
    return out


def whiten(vectors: DataFrame, components: int = 16, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each row and component."""
    rows = usable(vectors, scale, shift)
    fit = settle(rows.select("x").distinct(), "whitening-fit")
    known = sums(fit)
    tables = covariances(fit, known)
    spaces = {d: Space(*known[d], tables[d], components) for d in known}
    errors = identity_errors(fit, spaces)
    shared = vectors.sparkSession.sparkContext.broadcast((spaces, errors))
    kind = dict(vectors.dtypes)["vec_id"]

    def work(batches):
        spaces, errors = shared.value
        for d, x, at, batch in by_length(batches, 1):
            space = spaces[d]
            k = len(space.alive)
            w, dev = space.whitened(x), space.deviations(x)
            none = np.broadcast_to(~space.alive, w.shape).ravel()
            many = np.repeat(np.arange(len(at)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at[many])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(many), space.n, np.int64)),
                    pa.array(dev, pa.int64()).take(pa.array(many)),
                    pa.array(w.ravel(), mask=none),
                    pa.array(np.tile(space.explained, len(at))),
                    pa.array(np.full(len(many), errors[d])),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return map_batches(
        rows, work,
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )
