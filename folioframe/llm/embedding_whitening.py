"""Embedding whitening: compensated covariance and its principal components.

Entries become integers, x = floor(64 c) + 1000000, which lie far from 0 beside their spread: products of plain sums would lose
most digits. So the mean is taken off first, as an unevaluated sum of two doubles, and the centred outer products are added
up in double-double arithmetic: error-free transformations (Knuth's sum, Veltkamp's split and Dekker's product) keep what each
operation rounds away. Every task hands on the high and low parts of its rows of the matrix; they are merged row by row, first
among some of the tasks, then among all. The driver holds one matrix of a vector's dimension and solves it with LAPACK's
``syevd`` (reduction to tridiagonal form, then divide and conquer), which ``numpy.linalg.eigh`` calls.

The whitened rows' own covariance is measured the same way and compared with the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Components returned, entries' scale and shift.
COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: Products held at once by a task, and groups in which tasks' parts are merged before all are.
HELD, GROUPS = 1 << 18, 32
#: Entries whose x needs more bits than a double holds make a vector unusable.
LARGEST = 2.0**52 / SCALE
_PARTS = "size int, row int, salt int, n long, hi array<double>, lo array<double>"


def two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a + b rounded, and what rounding lost."""
    s = a + b
    v = s - a
    return s, (a - (s - v)) + (b - v)


def _halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    c = a * 134217729.0  # 2^27 + 1
    high = c - (c - a)
    return high, a - high


def two_product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """a * b rounded, and what rounding lost."""
    p = a * b
    (ah, al), (bh, bl) = _halves(a), _halves(b)
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of two double-doubles."""
    s, e = two_sum(a[0], b[0])
    e = e + (a[1] + b[1])
    high = s + e
    return high, e - (high - s)


def summed(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of double-doubles along the first axis, by halves."""
    while len(hi) > 1:
        half = len(hi) // 2
        h, e = added((hi[:half], lo[:half]), (hi[half : 2 * half], lo[half : 2 * half]))
        hi, lo = (np.concatenate([h, hi[2 * half :]]), np.concatenate([e, lo[2 * half :]])) if len(hi) % 2 else (h, e)
    return hi[0], lo[0]


@dataclass
class Mean:
    """n vectors of one size and their exact mean, as high and low parts."""

    n: int
    sums: list[Fraction]

    def __post_init__(self):
        mean = [s / self.n for s in self.sums]
        self.hi = np.array([float(m) for m in mean])
        self.lo = np.array([float(m - Fraction(h)) for m, h in zip(mean, self.hi.tolist(), strict=True)])

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s, e = two_sum(x, -self.hi)
        e = e - self.lo
        high = s + e
        return high, e - (high - s)


def _matrices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, row numbers, vectors as doubles) of the sizes of a batch's lists."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    start = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size), at, flat[start[at][:, None] + np.arange(size)]


def _emitted(parts: list[tuple[int, int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    context = TaskContext.get()
    salt = (context.partitionId() if context else 0) % GROUPS
    size, row, n, hi, lo = zip(*parts, strict=True)
    cols = [pa.array(size, pa.int32()), pa.array(row, pa.int32()), pa.array([salt] * len(parts), pa.int32()), pa.array(n, pa.int64()), pa.array(hi, pa.list_(pa.float64())), pa.array(lo, pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays(cols, names=["size", "row", "salt", "n", "hi", "lo"])


def _adding_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of vectors: their number and sum a size."""
    held: dict[int, list] = {}
    for b in batches:
        for size, _, x in _matrices(b, "v"):
            more = summed(x, np.zeros_like(x))
            n, sums = held.get(size, (0, None))
            held[size] = (n + len(x), added(sums, more) if sums else more)
        if sum(held) > HELD:
            yield _emitted([(s, 0, n, *x) for s, (n, x) in held.items()])
            held.clear()
    if held:
        yield _emitted([(s, 0, n, *x) for s, (n, x) in held.items()])


def _multiplying(means: dict[int, Mean]):
    """Of vectors: the upper rows of the sum of their centred outer products, a size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for size, (n, (hi, lo)) in held.items():
                cut = np.cumsum([0, *range(size, 0, -1)])
                for at in range(0, size, 64):
                    yield _emitted([(size, i, n, hi[cut[i] : cut[i + 1]], lo[cut[i] : cut[i + 1]]) for i in range(at, min(size, at + 64))])
            held.clear()

        for b in batches:
            for size, _, x in _matrices(b, "v"):
                high, low = means[size].centred(x)
                i, j = np.triu_indices(size)
                step = max(1, HELD // len(i))
                for at in range(0, len(x), step):
                    h, e = high[at : at + step], low[at : at + step]
                    p, rest = two_product(h[:, i], h[:, j])
                    more = summed(p, rest + (h[:, i] * e[:, j] + e[:, i] * h[:, j]))
                    n, sums = held.get(size, (0, None))
                    held[size] = (n + len(h), added(sums, more) if sums else more)
            if sum(s * s for s in held) > 64 * HELD and len(held) > 1:
                yield from rows()
        yield from rows()

    return run


def _merging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts sorted by size, row and salt: one a key, holding no more than two of them."""
    key = part = None
    for b in batches:
        for r in range(b.num_rows):
            size, row, salt, n = (b.column(i)[r].as_py() for i in range(4))
            x = tuple(b.column(i)[r].values.to_numpy() for i in (4, 5))
            if key == (size, row, salt):
                part = (part[0] + n, added(part[1], x))
                continue
            if key:
                yield _one(key, part)
            key, part = (size, row, salt), (n, x)
    if key:
        yield _one(key, part)


def _one(key: tuple[int, int, int], part: tuple) -> pa.RecordBatch:
    size, row, salt = key
    cols = [pa.array([size], pa.int32()), pa.array([row], pa.int32()), pa.array([salt], pa.int32()), pa.array([part[0]], pa.int64()), *(pa.array([x], pa.list_(pa.float64())) for x in part[1])]
    return pa.RecordBatch.from_arrays(cols, names=["size", "row", "salt", "n", "hi", "lo"])


def _merged(parts: DataFrame) -> list[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(size, row, n, hi, lo), sorted; at most one a dimension reaches the driver."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["size", "row", "salt"]
    for salt in (F.col("salt"), F.lit(0)):
        parts = parts.withColumn("salt", salt).repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(_merging, _PARTS)
    got = parts.toArrow().combine_chunks()
    rows = zip(*(got[c].to_pylist() for c in ("size", "row", "n")), *((v.values.to_numpy() for v in got[c]) for c in ("hi", "lo")), strict=True)
    return sorted(rows, key=lambda r: r[:2])


def means(vectors: DataFrame) -> dict[int, Mean]:
    """Number and exact mean of the vectors ``v``, by their size."""
    rows = _merged(vectors.select("v").mapInArrow(_adding_up, _PARTS))
    return {size: Mean(n, [Fraction(h) + Fraction(e) for h, e in zip(hi.tolist(), lo.tolist(), strict=True)]) for size, _, n, hi, lo in rows}


def covariances(vectors: DataFrame, known: dict[int, Mean]) -> dict[int, np.ndarray]:
    """Covariance matrices (divisor n) of the vectors ``v``, by their size."""
    out = {size: np.zeros((size, size)) for size in known}
    for size, i, n, hi, lo in _merged(vectors.select("v").mapInArrow(_multiplying(known), _PARTS)):
        out[size][i, i:] = out[size][i:, i] = hi / n + lo / n
    return out


@dataclass
class Whitening:
    """Mean, unit eigenvectors as columns by falling eigenvalue, eigenvalues, and the trace of one size."""

    mean: Mean
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @classmethod
    def of(cls, mean: Mean, covariance: np.ndarray, components: int) -> Whitening:
        values, axes = np.linalg.eigh(covariance)
        keep = slice(None, None, -1)
        values, axes = values[keep][:components], axes[:, keep][:, :components]
        axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
        return cls(mean, axes, values, float(np.trace(covariance)))

    @property
    def usable(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        return self.values > len(self.axes) * np.finfo(float).eps * max(self.trace, 0.0)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of the usable components."""
        high, low = self.mean.centred(x)
        on = self.axes[:, self.usable]
        return (high @ on + low @ on) / np.sqrt(self.values[self.usable])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2 of each row, exact; None beyond 64 bits."""
        n, sums = self.mean.n, [int(s) for s in self.mean.sums]
        x = x.astype(np.int64)
        largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
        kind = np.int64 if len(sums) * largest**2 < 2**63 else object
        if kind is object and abs(n * (x.astype(np.float64) - self.mean.hi)).max(initial=0) ** 2 * len(sums) < 2**62 and largest < 2**63:
            kind = np.int64  # neither products nor differences leave 64 bits
        d = x.astype(kind) * n - np.array(sums, kind)
        return [v if v < 2**63 else None for v in (d * d).sum(axis=1).tolist()] if len(sums) else [0] * len(x)


def _applying(models: dict[int, Whitening]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id")
            for size, at, x in _matrices(b, "v"):
                m = models[size]
                w = m.project(x)
                cols = [ids.take(pa.array(at)), pa.array([size] * len(at), pa.int32()), pa.array([m.mean.n] * len(at), pa.int64()), pa.array(m.deviations(x), pa.int64()), pa.array(list(w), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "size", "n", "deviation", "v"])

    return run


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): the usable vectors with their entries as integers."""
    v = F.col("_v")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("_v")).where(fine)
    return rows.select("id", F.transform(v, lambda c: F.floor(c * SCALE) + SHIFT).alias("v"))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or empty, or hold null, non-finite or (from 2^46 on) inexact entries are left out; repeated rows count as
    often as they occur, and a null id keeps its rows. Vectors of different sizes are whitened apart, each size with its own fit list.
    A component without variance, as with a single vector, has null as ``whitened`` and no part in the error, which is then 0 if all
    are such. A deviation beyond 64 bits is null. Equal eigenvalues may take any axes of their space, the same ones for all rows.
    Other columns aren't read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, id_col, vector_col)
    mean = means(rows)
    models = {size: Whitening.of(mean[size], c, components) for size, c in covariances(rows, mean).items()}
    done = stored(rows.mapInArrow(_applying(models), "id long, size int, n long, deviation long, v array<double>"), "whitened")
    # Whitened rows of two sizes may be equally long, so each size is measured by itself.
    known = []
    for size, m in models.items():
        own = done.where(F.col("size") == size)
        usable, error = m.usable, 0.0
        if usable.any():
            k = int(usable.sum())
            error = float(np.abs(covariances(own, means(own))[k] - np.eye(k)).max())
        known += [(size, i + 1, float(e / m.trace) if m.trace > 0 else None, error) for i, e in enumerate(m.values.tolist())]
    facts = spark.createDataFrame(known, "size int, component int, explained double, identity_error double")
    # ``components`` rows a size of vectors at most; all rows of a size share their key, so this side is broadcast while it is small.
    out = done.join(F.broadcast(facts) if len(known) <= 100_000 else facts, "size")
    return out.select(F.col("id").alias(id_col), "component", "n", "deviation", F.get("v", F.col("component") - 1).alias("whitened"), "explained", "identity_error")
