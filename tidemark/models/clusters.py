"""K-means whose restarts share every pass over the rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a task looks at together.
_BLOCK = 4096
#: Drawing rounds of the start, and candidates a round for each cluster.
_ROUNDS, _OVERSAMPLING = 2, 2


def _blocks(vectors: DataFrame, column: str):
    """Rows as blocks of numbers, as ``(bytes, rows)``."""

    def packed(batches):
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            values = values.reshape(batch.num_rows, -1) if batch.num_rows else values[:0].reshape(0, 1)
            for first in range(0, len(values), _BLOCK):
                part = values[first : first + _BLOCK]
                yield pa.RecordBatch.from_pydict({"block": [part.tobytes()], "rows": [len(part)]})

    return vectors.select(vector_to_array(column).alias("x")).mapInArrow(packed, "block binary, rows long").rdd


def squared(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of rows (down) and centers (across)."""
    found = (rows**2).sum(1)[:, None] + (centers**2).sum(1) - 2 * (rows @ centers.T)
    return np.maximum(found, 0, out=found)


def _split(wide: np.ndarray, starts: list[np.ndarray]) -> list[np.ndarray]:
    return np.split(wide, np.cumsum([len(c) for c in starts])[:-1], axis=1)


def _added(a: list, b: list) -> list:
    return [tuple(p + q for p, q in zip(x, y, strict=True)) for x, y in zip(a, b, strict=True)]


def _seeded(points: np.ndarray, weights: np.ndarray, k: int, rng) -> np.ndarray:
    """K-means++ and some rounds of Lloyd on weighted candidates."""
    points, place = np.unique(points, axis=0, return_inverse=True)
    weights = np.bincount(place.ravel(), weights)
    if len(points) <= k:
        return points
    weights = np.maximum(weights, 1e-9)
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    while len(chosen) < k:
        share = weights * squared(points, points[chosen]).min(1)
        share[chosen] = 0
        share = share / share.sum() if share.sum() > 0 else None
        left = np.setdiff1d(np.arange(len(points)), chosen)
        chosen.append(int(left[0] if share is None else rng.choice(len(points), p=share)))
    centers = points[chosen]
    for _ in range(30):
        nearest = squared(points, centers).argmin(1)
        mass = np.bincount(nearest, weights, k)
        moved = np.stack([np.bincount(nearest, weights * c, k) for c in points.T], 1)
        new = np.where(mass[:, None] > 0, moved / np.maximum(mass, 1e-300)[:, None], centers)
        if np.array_equal(new, centers):
            break
        centers = new
    return centers


class _Rows:
    """Blocks kept by Spark, looked at from the middle of all rows."""

    def __init__(self, blocks):
        self.blocks = blocks
        self.middle = 0.0

    def _each(self, work, join):
        """``work(rows, partition, block)`` of every block, joined by ``join`` in tasks and then as a tree."""
        middle = self.middle

        def run(number, blocks):
            found = None
            for i, (block, size) in enumerate(blocks):
                made = work(np.frombuffer(block).reshape(size, -1) - middle, number, i)
                found = made if found is None else join(found, made)
            return [] if found is None else [found]

        return self.blocks.mapPartitionsWithIndex(run).treeReduce(join)

    def center(self) -> None:
        size, total = self._each(lambda x, *_: (len(x), x.sum(0)), lambda a, b: (a[0] + b[0], a[1] + b[1]))
        self.middle = total / size

    def one_each(self, seeds: list[int]) -> list[np.ndarray]:
        """For each seed a row, every row alike likely."""

        def work(x, *place):
            draws = [np.random.default_rng((s, *place)).random(len(x)) for s in seeds]
            return [(d.max(), x[d.argmax()]) for d in draws]

        best = self._each(work, lambda a, b: [max(p, q, key=lambda r: r[0]) for p, q in zip(a, b, strict=True)])
        return [row[None] for _, row in best]

    def costs(self, starts: list[np.ndarray]) -> np.ndarray:
        def work(x, *_):
            return np.array([d.min(1).sum() for d in _split(squared(x, np.concatenate(starts)), starts)])

        return self._each(work, np.add)

    def drawn(self, starts: list[np.ndarray], costs: np.ndarray, many: int, seeds: list[int], turn: int) -> list[np.ndarray]:
        """About ``many`` rows a start, the likelier the farther from its centers."""

        def work(x, *place):
            found = []
            for d, cost, s in zip(_split(squared(x, np.concatenate(starts)), starts), costs, seeds, strict=True):
                draw = np.random.default_rng((s, turn, *place)).random(len(x))
                found.append(x[draw * cost < many * d.min(1)])
            return found

        return self._each(work, lambda a, b: [np.concatenate(p) for p in zip(a, b, strict=True)])

    def nearest(self, starts: list[np.ndarray]) -> list[np.ndarray]:
        """Rows by their nearest center."""

        def work(x, *_):
            return [(np.bincount(d.argmin(1), minlength=d.shape[1]),) for d in _split(squared(x, np.concatenate(starts)), starts)]

        return [w for (w,) in self._each(work, _added)]

    def means(self, starts: list[np.ndarray]) -> list[tuple]:
        """For each start the number and sum of the rows nearest to its centers."""

        def work(x, *_):
            found = []
            for d in _split(squared(x, np.concatenate(starts)), starts):
                mine = (d.argmin(1)[:, None] == np.arange(d.shape[1])).astype(float)
                found.append((mine.sum(0), mine.T @ x))
            return found

        return self._each(work, _added)


def best_of(vectors: DataFrame, column: str, k: int, restarts: int, seed: int, max_iter: int, tol: float) -> tuple[np.ndarray, float]:
    """Centers of the cheapest of several starts, and their cost.

    Starts are drawn as k-means|| draws them; each is moved until no center goes farther than
    ``tol``. One pass an iteration serves all starts that still move.
    """
    blocks = _blocks(vectors, column).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if blocks.isEmpty():
            raise ValueError("no rows to cluster")
        rows, seeds = _Rows(blocks), [seed + i for i in range(restarts)]
        rows.center()
        starts = rows.one_each(seeds)
        for turn in range(_ROUNDS):
            new = rows.drawn(starts, rows.costs(starts), _OVERSAMPLING * k, seeds, turn)
            starts = [np.concatenate(p) for p in zip(starts, new, strict=True)]
        weights = rows.nearest(starts)
        starts = [_seeded(c, w, k, np.random.default_rng(s)) for c, w, s in zip(starts, weights, seeds, strict=True)]
        moving = list(range(restarts))
        for _ in range(max_iter):
            found = rows.means([starts[i] for i in moving])
            still = []
            for i, (size, total) in zip(moving, found, strict=True):
                new = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], starts[i])
                if (((new - starts[i]) ** 2).sum(1) > tol**2).any():
                    still.append(i)
                starts[i] = new
            moving = still
            if not moving:
                break
        costs = rows.costs(starts)
        best = int(costs.argmin())
        return starts[best] + rows.middle, float(costs[best])
    finally:
        blocks.unpersist()


def nearest_center(column: str, centers: list[list[float]]) -> Column:
    """Number of the center nearest to a vector column."""
    places = np.array(centers)
    middle = places.mean(0)

    @F.pandas_udf("int")
    def nearest(vectors):
        if not len(vectors):
            return pd.Series([], dtype="int32")
        return pd.Series(squared(np.stack(vectors.to_numpy()) - middle, places - middle).argmin(1).astype("int32"))

    return nearest(vector_to_array(column))
