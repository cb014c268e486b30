"""Forests whose trees are grown whole, each by one task.

Trees without a sample of their own see a row only by its bins. Regression: where the bins of all
features make a grid of bounded size, the rows of a cell are one weighted row to every tree, a
tree is grown on the cells, and the forest is what it says for each cell of the grid.
Classification: a row is a few bytes of bins, every task gets all of them, up to ``MOST_BYTES``;
a tree comes back as a few bytes for each node.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import Bucketizer, SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models.base import PREDICTION, Fitted

CELL = "_forest_cell"
#: Most cells of a grid: what a task or the driver holds of one, whatever the table's size.
MOST_CELLS = 1 << 19
#: Nodes whose histograms a task holds at once.
_NODES = 1 << 14
#: Most bytes of binned rows, and of the leaves of all trees: what a task or the driver holds of either.
MOST_BYTES = 1 << 28
#: Counts by node, class and bin that a task holds at once.
_COUNTS = 1 << 18


def between(values: list[float]) -> list[float]:
    """Cuts that tell sorted values apart, in the middle of two."""
    low, high = np.array(values[:-1]), np.array(values[1:])
    return np.maximum((low + high) / 2, np.nextafter(low, np.inf)).tolist()


def grid_head(columns: list[str], cuts: list[list[float]]) -> list:
    """Pipeline stages that give a row the number of its cell."""
    steps = [f"{c}__step" for c in columns]
    strides = [math.prod(len(x) + 1 for x in cuts[i + 1 :]) for i in range(len(cuts))]
    cell = " + ".join(f"bigint(`{s}`) * {n}" for s, n in zip(steps, strides, strict=True))
    splits = [[-math.inf, *x, math.inf] for x in cuts]
    stages = []
    cut = [i for i, x in enumerate(cuts) if x]  # a column of one value has one bin
    if cut:
        stages.append(Bucketizer(inputCols=[columns[i] for i in cut], outputCols=[steps[i] for i in cut], splitsArray=[splits[i] for i in cut]))
    flat = "".join(f", 0d AS `{steps[i]}`" for i in range(len(cuts)) if i not in cut)
    stages.append(SQLTransformer(statement=f"SELECT *{flat} FROM __THIS__"))
    stages.append(SQLTransformer(statement=f"SELECT *, {cell} AS {CELL} FROM __THIS__"))
    return stages


def _best_cuts(codes, sizes, node, weight, total, chosen, leaf: int):
    """Best feature and bin of each node, the feature -1 where no cut gains; rows come sorted by node."""
    count = len(chosen)
    node_weight, node_total = np.bincount(node, weight, count), np.bincount(node, total, count)
    base = node_total**2 / node_weight
    gain, feature, place = 1e-12 * (base + 1e-300), np.full(count, -1), np.zeros(count, int)
    for j, size in enumerate(sizes):
        mine = np.flatnonzero(chosen[:, j])
        if size < 2 or not len(mine):
            continue
        rank = np.full(count, -1)
        rank[mine] = np.arange(len(mine))
        at = rank[node]
        held = at >= 0
        slot = at[held] * size + codes[j][held]
        left_weight = np.bincount(slot, weight[held], len(mine) * size).reshape(-1, size).cumsum(1)[:, :-1]
        left_total = np.bincount(slot, total[held], len(mine) * size).reshape(-1, size).cumsum(1)[:, :-1]
        right_weight, right_total = node_weight[mine, None] - left_weight, node_total[mine, None] - left_total
        allowed = (left_weight >= leaf) & (right_weight >= leaf)
        with np.errstate(divide="ignore", invalid="ignore"):
            gains = np.where(allowed, left_total**2 / left_weight + right_total**2 / right_weight - base[mine, None], -np.inf)
        best = gains.argmax(1)
        found = gains[np.arange(len(mine)), best]
        better = found > gain[mine]
        gain[mine[better]], feature[mine[better]], place[mine[better]] = found[better], j, best[better]
    return feature, place, node_total / node_weight


def grow(sizes: list[int], weight: np.ndarray, total: np.ndarray, leaf: int, depth: int, features: int, seed) -> np.ndarray:
    """What one tree says for each cell; ``weight`` rows lie in a cell, their labels add up to ``total``.

    Level by level, each node on ``features`` features of its own drawing, until no cut gains.
    """
    rng = np.random.default_rng(seed)
    codes = [c.astype(np.uint8 if size <= 256 else np.int32) for c, size in zip(np.unravel_index(np.arange(len(weight)), sizes), sizes, strict=True)]
    said = np.full(len(weight), total.sum() / weight.sum())
    cells, node, count = np.arange(len(weight)), np.zeros(len(weight), int), 1  # cells sorted by their node
    for _ in range(depth):
        nxt_cells, nxt_node, made = [], [], 0
        for first in range(0, count, _NODES):
            lo, hi = np.searchsorted(node, [first, first + _NODES])
            here, at = cells[lo:hi], node[lo:hi] - first
            many = min(_NODES, count - first)
            chosen = rng.random((many, len(sizes))).argsort(1).argsort(1) < features
            here_codes = [c[here] for c in codes]
            feature, place, mean = _best_cuts(here_codes, sizes, at, weight[here], total[here], chosen, leaf)
            said[here] = mean[at]
            split = feature >= 0
            child = made + 2 * (split.cumsum() - 1)
            made += 2 * int(split.sum())
            inner = split[at]
            here, at = here[inner], at[inner]
            code = np.choose(feature[at], [c[inner] for c in here_codes]) if len(here) else at
            nxt_cells.append(here)
            nxt_node.append(child[at] + (code > place[at]))
        if not made:
            break
        cells, node, count = np.concatenate(nxt_cells), np.concatenate(nxt_node), made
        order = node.argsort(kind="stable")
        cells, node = cells[order], node[order]
    return said


def fit_grid(name: str, df: DataFrame, stages: list, columns: list[str], cuts: list[list[float]], estimator) -> Fitted:
    """The forest of MLlib's ``estimator`` on ``columns``, which ``stages`` make, each tree grown by a task."""
    label, trees, seed = estimator.getLabelCol(), estimator.getNumTrees(), estimator.getSeed()
    leaf, depth = estimator.getMinInstancesPerNode(), estimator.getMaxDepth()
    features = len(columns) if trees == 1 else math.ceil(len(columns) / 3)  # MLlib's choice
    head = Pipeline(stages=[*stages, *grid_head(columns, cuts)]).fit(df)
    sizes = [len(x) + 1 for x in cuts]
    known = F.count(label) == F.count(F.lit(1))
    found = head.transform(df).groupBy(CELL).agg(F.count(F.lit(1)).cast("double").alias("rows"), F.when(known, F.avg(label)).alias("mean")).toPandas()
    if found["mean"].isna().any():
        raise ValueError(f"rows without a number in {label}")
    weight, mean = np.zeros(math.prod(sizes)), np.zeros(math.prod(sizes))
    weight[found[CELL]], mean[found[CELL]] = found["rows"], found["mean"]
    middle = float(np.average(mean, weights=weight))
    context = df.sparkSession.sparkContext
    shared = context.broadcast((weight, weight * (mean - middle)))
    try:
        grown = context.parallelize(range(trees), trees).map(lambda i: grow(sizes, *shared.value, leaf, depth, features, (seed, i)))
        values = grown.treeReduce(np.add) / trees + middle
    finally:
        shared.destroy()
    return Fitted(name, head, {"cells": values.tolist()})


def score_grid(fitted: Fitted, df: DataFrame) -> DataFrame:
    values = np.array(fitted.meta["cells"])
    table = df.sparkSession.createDataFrame(pd.DataFrame({CELL: np.arange(len(values)), PREDICTION: values}))
    celled = fitted.pipeline.transform(df).select(*[F.col(f"`{c}`") for c in df.columns if c != PREDICTION], CELL)
    return celled.join(F.broadcast(table), CELL, "left").drop(CELL)  # a bounded number of cells


class ClassTree(NamedTuple):
    """Nodes from the root on: the right child follows the left one, a row goes right with a bin over ``place``."""

    feature: np.ndarray  # -1 in a leaf
    place: np.ndarray
    child: np.ndarray  # the left one; of a leaf, its row of ``counts``
    counts: np.ndarray  # rows by leaf and class


def _class_cuts(flat, start, node, y, total, chosen, most: int, leaf: int):
    """Feature, bin and rows by class on the left of each node's best cut by Gini impurity, the feature -1 where none gains."""
    count, classes = total.shape
    size = total.sum(1)
    whole = np.einsum("nc,nc->n", total, total)
    score = whole / size * (1 + 1e-12)
    feature, place, lefts = np.full(count, -1), np.zeros(count, int), np.zeros_like(total)
    cell = (node * classes + y) * most
    for k in range(chosen.shape[1]):
        code = flat[start + chosen[node, k]]
        left = np.bincount(cell + code, minlength=count * classes * most).reshape(count, classes, most).cumsum(2, dtype=float)
        many = left.sum(1)
        rest = size[:, None] - many
        square = np.einsum("ncb,ncb->nb", left, left)
        cross = np.einsum("ncb,nc->nb", left, total)
        with np.errstate(divide="ignore", invalid="ignore"):
            found = square / many + (whole[:, None] - 2 * cross + square) / rest
        found[(many < leaf) | (rest < leaf)] = -np.inf
        at = found.argmax(1)
        found = found[np.arange(count), at]
        better = np.flatnonzero(found > score)
        score[better], feature[better], place[better] = found[better], chosen[better, k], at[better]
        lefts[better] = left[better, :, at[better]]
    return feature, place, lefts


def grow_classes(codes: np.ndarray, y: np.ndarray, most: int, classes: int, leaf: int, depth: int, features: int, seed) -> ClassTree:
    """One tree on rows of at most ``most`` bins a feature; a node draws ``features`` features of its own.

    Level by level until no cut gains. Two leaves of one node that name the same class are one, as in MLlib.
    """
    rng, (n, width) = np.random.default_rng(seed), codes.shape
    flat, y = codes.reshape(-1), y.astype(np.int64)
    rows, node = np.arange(n), np.zeros(n, np.int64)  # sorted by node
    levels, total = [], np.bincount(y, minlength=classes)[None].astype(float)
    while True:
        feature, place = np.full(len(total), -1), np.zeros(len(total), int)
        levels.append((feature, place, total))
        opened = np.flatnonzero((total.sum(1) >= 2 * leaf) & (total.max(1) < total.sum(1)))
        if len(levels) > depth or not len(opened):
            break
        rank = np.full(len(total), -1)
        rank[opened] = np.arange(len(opened))
        node = rank[node]
        rows, node = rows[node >= 0], node[node >= 0]
        step = max(1, _COUNTS // (classes * most))
        lefts = np.zeros((len(opened), classes))
        for first in range(0, len(opened), step):
            here = opened[first : first + step]
            lo, hi = np.searchsorted(node, [first, first + step])
            chosen = rng.random((len(here), width)).argsort(1)[:, :features]
            feature[here], place[here], lefts[first : first + step] = _class_cuts(
                flat, rows[lo:hi] * width, node[lo:hi] - first, y[rows[lo:hi]], total[here], chosen, most, leaf
            )
        cut = feature[opened] >= 0
        inner = cut[node]
        rows, at = rows[inner], opened[node[inner]]
        right = flat[rows * width + feature[at]] > place[at]
        node = 2 * (cut.cumsum() - 1)[node[inner]] + right
        order = node.astype(np.min_scalar_type(2 * len(opened))).argsort(kind="stable")
        rows, node = rows[order], node[order]
        total = np.stack([lefts[cut], total[opened[cut]] - lefts[cut]], 1).reshape(-1, classes)
    return _pruned(levels, codes.dtype)


def _pruned(levels: list[tuple], code: np.dtype) -> ClassTree:
    """The nodes of all levels one after another, without leaves that say what their sibling says."""
    cuts = [np.flatnonzero(feature >= 0) for feature, _, _ in levels]
    for (feature, _, _), (below, _, total), cut in zip(levels[-2::-1], levels[:0:-1], cuts[-2::-1], strict=True):
        said = np.where(below >= 0, -1 - np.arange(len(below)) % 2, total.argmax(1)).reshape(-1, 2)
        feature[cut[said[:, 0] == said[:, 1]]] = -1
    kept, made, children = np.array([True]), 0, []
    features, places, counts = [], [], []
    for (feature, place, total), cut in zip(levels, cuts, strict=True):
        made += int(kept.sum())
        inner = kept[cut] & (feature[cut] >= 0)
        child = np.zeros(len(feature), np.int64)
        child[cut[inner]] = made + 2 * np.arange(inner.sum())
        features.append(feature[kept])
        places.append(place[kept])
        children.append(child[kept])
        counts.append(total[kept & (feature < 0)])
        kept = np.repeat(inner, 2)
    feature, counts = np.concatenate(features), np.concatenate(counts)
    child = np.concatenate(children)
    child[feature < 0] = np.arange(len(counts))
    return ClassTree(feature.astype(np.int32), np.concatenate(places).astype(code), child.astype(np.int32), counts.astype(np.min_scalar_type(int(counts.max()))))


def class_counts(tree: ClassTree, codes: np.ndarray) -> np.ndarray:
    """Rows by class of the leaf that each row ends in."""
    n, width = codes.shape
    flat, rows, node = codes.reshape(-1), np.arange(n), np.zeros(n, np.int64)
    at = node
    while len(rows):
        feature = tree.feature[at]
        inner = feature >= 0
        if not inner.all():
            rows, at, feature = rows[inner], at[inner], feature[inner]
        at = tree.child[at] + (flat[rows * width + feature] > tree.place[at])
        node[rows] = at
    return tree.counts[tree.child[node]]


def binned(values: list[np.ndarray], cuts: list[list[float]]) -> np.ndarray:
    """Bins of rows, a row's beside each other; ``values`` has an array for each feature."""
    codes = np.empty((len(values[0]), len(cuts)), np.min_scalar_type(max(map(len, cuts))))
    for j, (column, cut) in enumerate(zip(values, cuts, strict=True)):
        codes[:, j] = np.searchsorted(cut, column, side="right")
    return codes


def held_bytes(estimator, rows: int, width: int, classes: int) -> float:
    """About the most that the driver holds at once for ``fit_classes``: binned rows, or leaves."""
    a_bin = np.min_scalar_type(estimator.getMaxBins()).itemsize
    leaves = rows / estimator.getMinInstancesPerNode() * estimator.getNumTrees()
    return max(rows * (width * a_bin + np.min_scalar_type(classes).itemsize), leaves * 4 * (classes + 4))


def fit_classes(name: str, df: DataFrame, stages: list, columns: list[str], cuts: list[list[float]], estimator, meta: dict) -> Fitted:
    """The forest of MLlib's ``estimator`` on ``columns``, which ``stages`` make, each tree grown by a task."""
    label, trees, seed, classes = estimator.getLabelCol(), estimator.getNumTrees(), estimator.getSeed(), len(meta["classes"])
    leaf, depth = estimator.getMinInstancesPerNode(), estimator.getMaxDepth()
    features = len(columns) if trees == 1 else math.ceil(math.sqrt(len(columns)))  # MLlib's choice
    head = Pipeline(stages=stages).fit(df)
    wanted = [F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    kind, bins = np.min_scalar_type(classes), [np.array(x) for x in cuts]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = binned([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], bins)
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(kind)
            yield pa.RecordBatch.from_pydict({"codes": [codes.tobytes()], "y": [y.tobytes()]})

    packed = head.transform(df).select(F.col(label), *wanted).mapInArrow(pack, "codes binary, y binary").collect()
    codes = np.frombuffer(b"".join(r["codes"] for r in packed), np.min_scalar_type(max(map(len, cuts)))).reshape(-1, len(columns))
    y = np.frombuffer(b"".join(r["y"] for r in packed), kind)
    del packed
    context, most = df.sparkSession.sparkContext, max(map(len, cuts)) + 1
    shared = context.broadcast((codes, y))

    def grown(i: int) -> bytes:
        return pickle.dumps(tuple(grow_classes(*shared.value, most, classes, leaf, depth, features, (seed, i))))

    try:
        made = context.parallelize(range(trees), trees).map(grown).collect()
    finally:
        shared.destroy()
    return Fitted(name, head, {**meta, "columns": columns, "cuts": cuts}, made)


def with_shares(fitted: Fitted, df: DataFrame, output: str) -> DataFrame:
    """``df`` and the mean share of each class in the leaves of the trees."""
    cuts, classes = [np.array(x) for x in fitted.meta["cuts"]], len(fitted.meta["classes"])
    shared = df.sparkSession.sparkContext.broadcast(fitted.parts)

    @F.arrow_udf("array<double>")
    def shares(values: pa.Array) -> pa.Array:
        n = len(values)
        codes = binned(list(values.flatten().to_numpy(zero_copy_only=False).reshape(n, len(cuts)).T), cuts)
        total = np.zeros((n, classes))
        for part in shared.value:
            counts = class_counts(ClassTree(*pickle.loads(part)), codes)
            total += counts / counts.sum(1, keepdims=True)
        total /= len(shared.value)
        return pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * classes).astype(np.int32)), pa.array(total.ravel()))

    numbers = F.array(*[F.col(f"`{c}`").cast("double") for c in fitted.meta["columns"]])
    return fitted.pipeline.transform(df).withColumn(output, shares(numbers))
