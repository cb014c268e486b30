"""Embedding whitening by QDWH spectral divide and conquer.

Entries become whole numbers, whose sums Spark adds up exactly; a second scan adds up the
covariance of the centred entries. Its eigenvectors are found by splitting: the orthogonal
polar factor of the shifted covariance (QDWH: dynamically weighted Halley iterations) is the
sign of its spectrum, which gives the projectors on the parts above and below the shift; each
part is split again until its size is one or its eigenvalues are one. The components are
broadcast, and every vector is whitened where it lies. The driver holds matrices of the
dimension squared, whatever the number of vectors; no vector is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: An entry whose whole number would pass this size counts as this size.
LARGEST = 1 << 40
#: Components with less than this share of the largest variance have none but rounding.
LEAST_SHARE = 1e-11
_EPS = np.finfo(float).eps
_LIMB = 20
_ROWS = 4096


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix (Nakatsukasa, Bai and Gygi 2010): its matrix sign."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    inner = np.linalg.norm(np.linalg.qr(x)[1].diagonal(), -np.inf)
    low = min(1.0, max(inner / n, _EPS / n))  # at most the least singular value, about
    eye = np.eye(n)
    for _ in range(40):
        d = np.cbrt(4 * max(0.0, 1 - low**2) / low**4)
        a_k = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d)))
        b_k = (a_k - 1) ** 2 / 4
        c_k = a_k + b_k - 1
        if c_k > 100:  # ill-conditioned: the step by a QR factorisation
            q = np.linalg.qr(np.vstack([np.sqrt(c_k) * x, eye]))[0]
            new = (b_k / c_k) * x + ((a_k - b_k / c_k) / np.sqrt(c_k)) * (q[:n] @ q[n:].T)
        else:
            new = (b_k / c_k) * x + (a_k - b_k / c_k) * np.linalg.solve(eye + c_k * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        low = min(1.0, low * (a_k + b_k * low**2) / (1 + c_k * low**2))
        moved, x = np.linalg.norm(new - x), new
        if moved <= _EPS ** (1 / 3) * np.linalg.norm(x) and 1 - low < 10 * _EPS:
            break
    return x


def _orthonormal(projector: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """A basis of the range of a projector of rank ``k``."""
    q = np.linalg.qr(projector @ draw.standard_normal((len(projector), k)))[0]
    return np.linalg.qr(projector @ q)[0]


def _shifts(a: np.ndarray) -> list[float]:
    """Places to split a spectrum at: the median of the diagonal, its mean, and others between its ends."""
    diagonal = np.sort(a.diagonal())
    low, high = diagonal[0], diagonal[-1]
    spread = max(high - low, np.linalg.norm(a - np.diag(a.diagonal())) / len(a))
    middle = diagonal.mean()
    return [float(np.median(diagonal)), float(middle), *(float(middle + s * spread) for s in (0.0137, -0.0137, 0.093, -0.093, 0.31, -0.31))]


def _split(a: np.ndarray, small: float, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    n = len(a)
    middle = np.trace(a) / n
    if n == 1 or np.linalg.norm(a - middle * np.eye(n)) <= small:
        return a.diagonal().copy(), np.eye(n)
    for shift in _shifts(a):
        projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < n or np.linalg.norm(projector @ projector - projector) > 1e-10 * n:
            continue  # no eigenvalue on one side, or one at the shift
        basis = np.linalg.qr(np.hstack([_orthonormal(projector, k, draw), _orthonormal(np.eye(n) - projector, n - k, draw)]))[0]
        inner = basis.T @ a @ basis
        if np.linalg.norm(inner[k:, :k]) > 100 * small:
            continue
        values, vectors = np.empty(n), np.zeros((n, n))
        for part in (slice(0, k), slice(k, n)):
            block = (inner[part, part] + inner[part, part].T) / 2
            values[part], vectors[part, part] = _split(block, small, draw)
        return values, basis @ vectors
    raise ArithmeticError("no shift splits the spectrum")


def eigenpairs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    One step of first-order correction takes what rounding the splits has left.
    """
    a = (a + a.T) / 2
    small = 4 * _EPS * np.linalg.norm(a)
    values, vectors = _split(a, small, np.random.default_rng(7)) if len(a) else (np.zeros(0), a)
    inner = vectors.T @ a @ vectors
    apart = inner.diagonal()[None, :] - inner.diagonal()[:, None]
    clear = np.abs(apart) > 1e3 * np.abs(inner)
    np.fill_diagonal(clear, False)
    turn = np.where(clear, inner / np.where(clear, apart, 1.0), 0.0)
    vectors = np.linalg.qr(vectors + vectors @ turn)[0] if len(a) else vectors
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0) if len(a) else np.zeros(0, int)
    return values, vectors * np.where(vectors[largest, np.arange(len(values))] < 0, -1.0, 1.0)


class Whitener(NamedTuple):
    """What a fit leaves: vectors, sums of each dimension, components (rows) with their variances, whole variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float

    @property
    def centre(self) -> np.ndarray:
        """The whole number next to each mean."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def remainder(self) -> np.ndarray:
        """What the sums are beyond ``n`` times the centre: at most half of ``n``."""
        return np.array([s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)], np.int64)

    def centred(self, near: np.ndarray) -> np.ndarray:
        return near - self.remainder / self.n

    def whitened(self, near: np.ndarray) -> np.ndarray:
        """Projections of rows (given from the centre), each with variance one."""
        return self.centred(near) @ (self.components / np.sqrt(self.variances)[:, None]).T

    def deviations(self, near: np.ndarray) -> list[int]:
        """Exact sum over the dimensions of ``(n * x - S) ** 2`` of each row."""
        rest = self.remainder
        high, low = rest >> _LIMB, rest & ((1 << _LIMB) - 1)
        wide = np.abs(near).max(initial=0) >= 1 << 25
        near = near.astype(object) if wide else near
        squares, upper, lower = ((near * near).sum(axis=1), (near * high).sum(axis=1), (near * low).sum(axis=1))
        own = sum(int(r) ** 2 for r in rest)
        return [self.n * self.n * int(a) - 2 * self.n * ((int(b) << _LIMB) + int(c)) + own for a, b, c in zip(squares, upper, lower, strict=True)]


def _vectors(batches, size: int | None) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Whole numbers of the usable vectors of each batch, by their length: length, batch, places, numbers."""
    for whole in batches:
        for lo in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(lo, _ROWS)
            column = batch.column("vector")
            ends = column.offsets.to_numpy()
            entries = pc.fill_null(column.values.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
            starts, sizes = ends[:-1] - ends[0], np.diff(ends)
            usable = column.is_valid().to_numpy(zero_copy_only=False)
            for length in np.unique(sizes[usable]) if size is None else (size,):
                at = np.flatnonzero(usable & (sizes == length))
                rows = entries[starts[at][:, None] + np.arange(length)]
                good = np.isfinite(rows).all(axis=1)
                numbers = np.clip(np.floor(SCALE * rows[good]), -LARGEST, LARGEST).astype(np.int64) + OFFSET
                if len(numbers):
                    yield int(length), batch, at[good], numbers


def _sums(batches) -> Iterator[pa.RecordBatch]:
    """Per task and vector length: vectors and sums, in two parts that can't overflow."""
    totals: dict[int, list] = {}
    for length, _, _, numbers in _vectors(batches, None):
        held = totals.setdefault(length, [0, np.zeros(length, np.int64), np.zeros(length, np.int64)])
        sums = numbers.sum(axis=0)
        held[0] += len(numbers)
        held[1] += sums >> 32
        held[2] += sums & 0xFFFFFFFF
    for length, (n, high, low) in totals.items():
        arrays = [pa.array([length]), pa.array([n]), pa.array([high]), pa.array([low])]
        yield pa.RecordBatch.from_arrays(arrays, ["size", "n", "high", "low"])


def _products(rows: DataFrame, size: int, made: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of the outer product of ``made`` of it; one task adds up its own first."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, _, _, numbers in _vectors(batches, size):
            part = made(numbers)
            total += part.T @ part
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "sum"])

    out = np.zeros((width, width))
    for r in rows.mapInArrow(run, "i long, j long, sum double").groupBy("i", "j").agg(F.sum("sum").alias("sum")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["sum"]
    return out


def _source(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    return vectors.select(vectors[id_column].alias("vec_id"), vectors[vector_column].cast("array<double>").alias("vector"))


def fit(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> tuple[int, Whitener | None]:
    """The length of the vectors and their whitener; none if no vector is left.

    The length most vectors have counts (the greater of two as frequent). Fits cover every
    vector of it; the driver gets one row per length and dimension and the upper half of a
    matrix per scan.
    """
    rows = _source(vectors, id_column, vector_column)
    totals = rows.select("vector").mapInArrow(_sums, "size long, n long, high array<long>, low array<long>")
    counts = {r["size"]: r["n"] for r in totals.groupBy("size").agg(F.sum("n").alias("n")).collect() if r["size"]}
    if not counts:
        return 0, None
    size = max(counts, key=lambda s: (counts[s], s))
    by_dim = totals.filter(F.col("size") == size).select(F.posexplode(F.arrays_zip("high", "low")))
    by_dim = by_dim.groupBy("pos").agg(*(F.sum(F.col(f"col.{c}").cast("decimal(38,0)")).alias(c) for c in ("high", "low")))
    sums = [(int(r["high"]) << 32) + int(r["low"]) for r in sorted(by_dim.collect(), key=lambda r: r["pos"])]
    n = counts[size]
    plain = Whitener(n, sums, np.zeros((0, size)), np.zeros(0), 0.0, 0.0)
    centre = plain.centre
    covariance = _products(rows.select("vector"), size, lambda x: plain.centred(x - centre), size) / n
    values, columns = eigenpairs(covariance)
    some = values[:components] > LEAST_SHARE * max(values[0], 0.0)
    found = plain._replace(components=columns[:, :components].T[some], variances=values[:components][some], trace=float(np.trace(covariance)))
    width = len(found.variances)
    if width:
        got = _products(rows.select("vector"), size, lambda x: found.whitened(x - centre), width) / n
        found = found._replace(identity_error=float(np.abs(got - np.eye(width)).max()))
    return size, found


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Vectors that are null, hold null or non-finite entries, or have another length than most
    are left out, in the fit too; so are components without variance, and an empty table or
    one of empty vectors has no rows. Repeated rows and ties are fitted and returned each; a
    null id is returned. Further columns are not read. ``deviation`` is exact (decimal).
    Vectors are scanned four times and never shuffled.
    """
    rows = _source(vectors, id_column, vector_column)
    size, model = fit(vectors, id_column, vector_column, components)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not len(model.variances):
        return rows.sparkSession.createDataFrame([], schema)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        m = shared.value
        width, centre = len(m.variances), m.centre
        for _, batch, at, numbers in _vectors(batches, size):
            near = numbers - centre
            each = np.repeat(np.arange(len(at)), width)
            deviation = pa.array([Decimal(x) for x in m.deviations(near)], pa.decimal128(38, 0))
            arrays = [
                batch.column("vec_id").take(pa.array(at)).take(pa.array(each)), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(at))),
                pa.array(np.full(len(each), m.n)), deviation.take(pa.array(each)), pa.array(m.whitened(near).ravel()),
                pa.array(np.tile(m.variances / m.trace, len(at))), pa.array(np.full(len(each), m.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
