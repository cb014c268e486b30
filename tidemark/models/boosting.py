"""Gradient boosted trees with second-order gains, one tree per class and round on shared softmax gradients.

Rows become bins once, equal ones become one with a weight, and these are written. A level of all trees of a round is one job: each task
routes its rows and adds gradients up by (class, node, slot, bin), and tasks that hold the sums
of whole slots find the best cut of every node, so only such cuts reach the driver. A missing number is a bin
of its own, tried on both sides of every cut; a nominal slot is cut between categories in the
order of their mean gradient; a slot that is only ever 0 or 1 costs a row nothing where it is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models.base import FEATURES
from tidemark.session import written

#: Penalty on squared leaf values, and the least sum of second derivatives on either side of a cut.
PENALTY, LEAST_WEIGHT = 1.0, 1.0
#: Rounds whose trees the tasks evaluate anew before margins are written again.
REWRITE = 10
#: Binned rows of a task, at least; each level is a job, and small tables need few tasks.
TASK_ROWS = 50_000
#: Distinct sums a task holds before it merges equal ones.
HELD_SUMS = 1 << 20
NUMBER, NOMINAL, FLAG = "number", "nominal", "flag"


class Slot(NamedTuple):
    """How one place of the feature vector is binned; bin 0 is a missing value, or an absent flag."""

    index: int
    kind: str
    cuts: list[float]
    bins: int


class Tree(NamedTuple):
    """Cuts by node (the children of n are 2n and 2n + 1): slot and which bins go left; values by leaf."""

    output: int
    cuts: dict[int, tuple[int, list[bool]]]
    leaves: dict[int, float]


def explicit(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and value of the stored entries of a batch of vectors, dense or sparse."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.field("values")
    sizes = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(column)), sizes)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sparse = column.field("type").to_numpy(zero_copy_only=False) == 0
    if sparse.any():
        places[np.repeat(sparse, sizes)] = column.field("indices").flatten().to_numpy(zero_copy_only=False)
    return rows, places, values.flatten().to_numpy(zero_copy_only=False)


def _ranges(rows: DataFrame) -> list:
    """Per place of the vector with a stored entry that is not 0: least and largest value, whether any is missing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, places, values = explicit(batch.column(FEATURES))
            some = values != 0
            found = pd.DataFrame({"place": places[some], "value": values[some], "gap": np.isnan(values[some])}).groupby("place")
            frame = found.agg(low=("value", "min"), high=("value", "max"), gap=("gap", "max")).reset_index()
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    found = rows.select(FEATURES).mapInArrow(run, "place long, low double, high double, gap boolean")
    real = lambda c: F.when(~F.isnan(c), F.col(c))
    return found.groupBy("place").agg(F.min(real("low")).alias("low"), F.max(real("high")).alias("high"), F.max("gap").alias("gap")).orderBy("place").collect()


def _quantiles(rows: DataFrame, places: Sequence[int], max_bins: int) -> dict[int, list[float]]:
    """Values that cut each place into about equal parts."""
    if not places:
        return {}
    sliced = VectorSlicer(inputCol=FEATURES, outputCol="_used", indices=list(places)).transform(rows.select(FEATURES))
    values = sliced.select(F.posexplode(vector_to_array("_used")).alias("at", "value")).filter(~F.isnan("value"))
    shares = [i / max_bins for i in range(1, max_bins)]
    found = values.groupBy("at").agg(F.percentile_approx("value", shares, 10_000).alias("cuts"), F.max("value").alias("high")).collect()
    return {places[r["at"]]: sorted({float(c) for c in r["cuts"] if c < r["high"]}) for r in found}


def slots_of(rows: DataFrame, max_bins: int) -> list[Slot]:
    """Slots in the order numbers, nominal, flags; a place that is 0 in every row has none."""
    attributes = rows.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {})
    nominal = {a["idx"]: len(a.get("vals", ())) for a in attributes.get("nominal", ()) if a.get("vals")}
    seen = {r["place"]: r for r in _ranges(rows)}
    flags = [p for p, r in seen.items() if p not in nominal and r["low"] == r["high"] == 1 and not r["gap"]]
    numbers = [p for p in seen if p not in nominal and p not in set(flags)]
    cuts = _quantiles(rows, numbers, max_bins)
    made = [Slot(p, NUMBER, cuts.get(p, []), len(cuts.get(p, [])) + 2) for p in numbers]
    made += [Slot(p, NOMINAL, [], size + 1) for p, size in sorted(nominal.items())]
    return made + [Slot(p, FLAG, [], 2) for p in flags]


def bin_of(slot: Slot, values: np.ndarray) -> np.ndarray:
    """The bin of each value of a slot."""
    if slot.kind == FLAG:
        return (values != 0).astype(np.int32)
    gap = np.isnan(values)
    if slot.kind == NOMINAL:
        codes = np.where(gap | (values < 0) | (values > slot.bins - 2), -1, values)
        return codes.astype(np.int32) + 1
    return np.where(gap, 0, np.searchsorted(np.array(slot.cuts), values, side="left") + 1).astype(np.int32)


def _binned(rows: DataFrame, slots: list[Slot]) -> DataFrame:
    """Rows as ``bins`` (one per slot with values), ``flags`` (slots that are 1) and ``y``."""
    valued = sum(s.kind != FLAG for s in slots)
    position = {s.index: i for i, s in enumerate(slots)}
    known = np.array(sorted(position), np.int64)
    target = np.array([position[p] for p in known], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            row, place, value = explicit(batch.column(FEATURES))
            at = np.searchsorted(known, place)
            held = (at < len(known)) & (known[np.minimum(at, max(0, len(known) - 1))] == place) if len(known) else np.zeros(len(place), bool)
            row, value, slot = row[held], value[held], target[at[held]]
            dense = np.zeros((n, valued))
            low = slot < valued
            dense[row[low], slot[low]] = value[low]
            bins = np.zeros((n, valued), np.int32)
            for i in range(valued):
                bins[:, i] = bin_of(slots[i], dense[:, i])
            up = ~low & (value != 0)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row[up], minlength=n))]).astype(np.int32)
            every = (np.arange(n + 1) * valued).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(every), pa.array(bins.ravel())),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(slot[up].astype(np.int32))),
                    batch.column("y"),
                ],
                ["bins", "flags", "y"],
            )

    return rows.mapInArrow(run, "bins array<int>, flags array<int>, y double")


def _weighted(binned: DataFrame, classes: int, base: list[float]) -> DataFrame:
    """Rows of equal bins, and class, as one with its ``weight`` and mean label, and a ``margin``.

    Trees see nothing of a row but its bins, so derivatives of equal rows add up to those of one
    row of that weight.
    """
    label = F.col("y") if classes else F.lit(0.0)  # the class is part of what must be equal
    cells = binned.groupBy("bins", "flags", label.alias("class")).agg(F.avg("y").alias("y"), F.count("y").cast("double").alias("weight"))
    return cells.select("bins", "flags", "y", "weight", F.array(*[F.lit(float(b)) for b in base]).alias("margin"))


def route(tree: Tree, bins_of) -> np.ndarray:
    """The node each row ends in; ``bins_of`` gives the bins of a slot."""
    node = None
    for at, (slot, left) in sorted(tree.cuts.items()):
        bins = bins_of(slot)
        if node is None:
            node = np.ones(len(bins), np.int64)
        here = np.flatnonzero(node == at)
        node[here] = 2 * at + ~np.array(left, bool)[bins[here]]
    return node


def leaf_values(tree: Tree, node: np.ndarray) -> np.ndarray:
    values = np.zeros(max(tree.leaves) + 1)
    values[list(tree.leaves)] = list(tree.leaves.values())
    return values[node]


class _Rows:
    """One batch of binned rows."""

    def __init__(self, batch: pa.RecordBatch, slots: list[Slot]):
        self.n = batch.num_rows
        self.valued = sum(s.kind != FLAG for s in slots)
        self.bins = batch.column("bins").flatten().to_numpy(zero_copy_only=False).reshape(self.n, self.valued)
        flags = batch.column("flags")
        self.flag_row = np.repeat(np.arange(self.n), flags.value_lengths().to_numpy(zero_copy_only=False))
        self.flag = flags.flatten().to_numpy(zero_copy_only=False)
        self.y = batch.column("y").to_numpy(zero_copy_only=False)
        self.weight = batch.column("weight").to_numpy(zero_copy_only=False)
        self.margin = batch.column("margin").flatten().to_numpy(zero_copy_only=False).reshape(self.n, -1).copy()

    def bins_of(self, slot: int) -> np.ndarray:
        if slot < self.valued:
            return self.bins[:, slot]
        found = np.zeros(self.n, np.int32)
        found[self.flag_row[self.flag == slot]] = 1
        return found

    def advance(self, trees: list[Tree]) -> None:
        for tree in trees:
            self.margin[:, tree.output] += leaf_values(tree, route(tree, self.bins_of))


def derivatives(margin: np.ndarray, y: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of squared error (no classes), logistic (two) or softmax loss."""
    if not classes:
        return margin - y[:, None], np.ones_like(margin)
    if classes == 2:
        p = 1 / (1 + np.exp(-margin))
        return p - y[:, None], np.maximum(p * (1 - p), 1e-16)
    p = np.exp(margin - margin.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    own = np.zeros_like(p)
    own[np.arange(len(y)), y.astype(np.int64)] = 1
    return p - own, np.maximum(2 * p * (1 - p), 1e-16)


def _merged(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    found, back = np.unique(np.concatenate(keys), return_inverse=True)
    values = np.concatenate(sums)
    return [found], [np.stack([np.bincount(back, values[:, j], len(found)) for j in (0, 1)], 1)]


def _sums(rows: DataFrame, slots: list[Slot], classes: int, done: list[Tree], growing: dict[int, Tree], open_nodes: set[tuple[int, int]]) -> DataFrame:
    """Gradient sums of the open nodes: ``output, node, slot, bin, g, h``; slot ``len(slots)`` is the whole node if there are flags."""
    first = np.concatenate([[0], np.cumsum([s.bins for s in slots])]).astype(np.int64)
    width = int(first[-1]) + 1
    span = 1 << (1 + max(node for _, node in open_nodes).bit_length())
    any_flag = any(s.kind == FLAG for s in slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = [], []
        for batch in batches:
            part = _Rows(batch, slots)
            if not part.n:
                continue
            part.advance(done)
            g, h = (x * part.weight[:, None] for x in derivatives(part.margin, part.y, classes))
            for output in sorted({o for o, _ in open_nodes}):
                node = route(growing[output], part.bins_of) if growing[output].cuts else np.ones(part.n, np.int64)
                wanted = np.isin(node, [m for o, m in open_nodes if o == output])
                both = np.stack([g[:, output], h[:, output]], 1)
                head = (output * span + node) * width
                cells = [head[wanted] + first[i] + part.bins[wanted, i] for i in range(part.valued)]
                weights = [both[wanted]] * part.valued
                if any_flag:
                    up = wanted[part.flag_row]
                    cells += [head[part.flag_row[up]] + first[part.flag[up]] + 1, head[wanted] + width - 1]
                    weights += [both[part.flag_row[up]], both[wanted]]
                if cells:
                    k, s = _merged(cells, weights)
                    keys, sums = keys + k, sums + s
            if sum(map(len, keys)) > HELD_SUMS:
                keys, sums = _merged(keys, sums)
        if keys:
            (key,), (value,) = _merged(keys, sums)
            place, cell = key // width, key % width
            slot = np.searchsorted(first, cell, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (place // span, place % span, slot, cell - first[slot], value[:, 0], value[:, 1])],
                ["output", "node", "slot", "bin", "g", "h"],
            )

    return rows.mapInArrow(run, "output long, node long, slot long, bin long, g double, h double")


CUT = "output long, node long, slot long, bin long, gap_left boolean, gain double, g double, h double, all_g double, all_h double, lefts array<long>"


def _group_sums(values: np.ndarray, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums inside groups that stand together, and the sum of the whole group, for every row."""
    running = np.cumsum(values)
    running = running - (running[starts] - values[starts])[group]
    ends = np.append(starts[1:], len(values)) - 1
    return running, running[ends][group]


def search(sums: pa.Table, slots: list[Slot]) -> list[tuple]:
    """The best cut of every node in whole slots of sums, as rows of ``CUT``; of equal gains the lowest slot."""
    numbers, valued = sum(s.kind == NUMBER for s in slots), sum(s.kind != FLAG for s in slots)
    output, node, slot, bins, g, h = (sums.column(c).to_numpy() for c in ("output", "node", "slot", "bin", "g", "h"))
    is_number, is_flag = slot < numbers, slot >= valued
    order = np.where(is_number, bins, np.where(is_flag, 0, g / (h + PENALTY)))
    by = np.lexsort((bins, order, slot, node, output))
    output, node, slot, bins, g, h, is_number, is_flag = (x[by] for x in (output, node, slot, bins, g, h, is_number, is_flag))
    new_node = np.append(True, (np.diff(output) != 0) | (np.diff(node) != 0))
    new_slot = new_node | np.append(True, np.diff(slot) != 0)
    starts, group = np.flatnonzero(new_slot), np.cumsum(new_slot) - 1
    gap = np.where(is_number & (bins == 0), 1.0, 0.0)
    run_g, all_g = _group_sums(g, starts, group)
    run_h, all_h = _group_sums(h, starts, group)
    gap_g, gap_h = (_group_sums(gap * x, starts, group)[1] for x in (g, h))
    if is_flag.any():  # the row of the whole node comes last
        last = (np.append(np.flatnonzero(new_node)[1:], len(g)) - 1)[np.cumsum(new_node) - 1]
        all_g, all_h = np.where(is_flag, g[last], all_g), np.where(is_flag, h[last], all_h)
        run_g, run_h = np.where(is_flag, all_g - g, run_g), np.where(is_flag, all_h - h, run_h)

    def gain(left_g: np.ndarray, left_h: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        right_g, right_h = all_g - left_g, all_h - left_h
        allowed = allowed & (left_h >= LEAST_WEIGHT) & (right_h >= LEAST_WEIGHT)
        value = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - all_g**2 / (all_h + PENALTY)
        return np.where(allowed, value, -np.inf)

    real = (slot < len(slots)) & (gap == 0)
    with_gap = gain(run_g, run_h, real)
    without = gain(run_g - gap_g, run_h - gap_h, real & is_number & (gap_h > 0))
    best = np.maximum(with_gap, without)
    pick = np.lexsort((bins, slot, -best, node, output))
    pick = pick[np.append(True, (np.diff(output[pick]) != 0) | (np.diff(node[pick]) != 0))]
    found = []
    for i in pick[best[pick] > 1e-9]:
        aside = without[i] > with_gap[i]
        # where no gap was seen a later one follows most rows
        gap_left = not aside and (gap_h[i] > 0 or run_h[i] >= all_h[i] - run_h[i])
        left_g, left_h = (run_g[i] - gap_g[i], run_h[i] - gap_h[i]) if aside else (run_g[i], run_h[i])
        lefts = bins[starts[group[i]] : i + 1].tolist() if numbers <= slot[i] < valued else []
        numbers_of_cut = (x.item() for x in (best[i], left_g, left_h, all_g[i], all_h[i]))
        found.append((int(output[i]), int(node[i]), int(slot[i]), int(bins[i]), bool(gap_left), *numbers_of_cut, lefts))
    return found


def best_cuts(sums: DataFrame, slots: list[Slot]) -> list:
    """The best cut of every node that gains by one.

    Sums of one slot (of one node, if there are flags) meet in a task, which returns one row per
    node; the driver takes the best of these.
    """
    together = ["output", "node"] if any(s.kind == FLAG for s in slots) else ["output", "node", "slot"]
    table = sums.repartition(*together).groupBy("output", "node", "slot", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    names = [c.split()[0] for c in CUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        found = search(pa.Table.from_batches(held), slots) if held else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], names).cast(types)

    types = pa.schema([(n, {"boolean": pa.bool_(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}.get(t, pa.int64())) for n, t in (c.split() for c in CUT.split(", "))])
    best = {}
    for row in table.mapInArrow(run, CUT).collect():
        key = (row["output"], row["node"])
        if key not in best or (row["gain"], -row["slot"]) > (best[key]["gain"], -best[key]["slot"]):
            best[key] = row
    return [best[k] for k in sorted(best)]


def _side(slot: Slot, row) -> list[bool]:
    """Which bins of a slot go left."""
    if slot.kind == FLAG:
        return [True, False]
    if slot.kind == NOMINAL:
        lefts = set(row["lefts"])
        return [b in lefts for b in range(slot.bins)]
    return [bool(row["gap_left"]), *(b <= row["bin"] for b in range(1, slot.bins))]


def grow(rows: DataFrame, slots: list[Slot], classes: int, outputs: int, done: list[Tree], depth: int, rate: float) -> list[Tree]:
    """The trees of one round, level by level; an output whose root gains by no cut has none."""
    growing = {o: Tree(o, {}, {}) for o in range(outputs)}
    open_nodes = {(o, 1) for o in growing}
    for _ in range(depth):
        found = best_cuts(_sums(rows, slots, classes, done, growing, open_nodes), slots)
        open_nodes = set()
        for row in found:
            tree, at = growing[row["output"]], row["node"]
            tree.cuts[at] = (row["slot"], _side(slots[row["slot"]], row))
            tree.leaves.pop(at, None)
            for child, g, h in ((2 * at, row["g"], row["h"]), (2 * at + 1, row["all_g"] - row["g"], row["all_h"] - row["h"])):
                tree.leaves[child] = -rate * g / (h + PENALTY)
                open_nodes.add((row["output"], child))
        if not open_nodes:
            break
    return [t for t in growing.values() if t.cuts]


def fit_trees(head: Pipeline, df: DataFrame, label: str, classes: int, params: dict) -> tuple[object, dict]:
    """The fitted head and the trees as plain values.

    ``label`` holds numbers, or places in the class list if there are ``classes``. Rows without
    a label must be gone; a table without rows raises. A level that no cut gains by ends its
    tree, a round without a tree ends the fit.
    """
    fitted_head = head.fit(df)
    rows = fitted_head.transform(df).select(FEATURES, F.col(f"`{label}`").cast("double").alias("y"))
    y = F.col("y")
    if classes:
        counts = {int(r["y"]): r["count"] for r in rows.groupBy("y").count().collect()}
        shares = [max(counts.get(c, 0), 0.5) / max(1, sum(counts.values())) for c in range(classes)]
        base = [math.log(shares[1] / shares[0])] if classes == 2 else [math.log(s) for s in shares]
        size = sum(counts.values())
    else:
        found = rows.agg(F.avg(y).alias("mean"), F.count(y).alias("n")).first()
        size, base = found["n"], [found["mean"]]
    if not size:
        raise ValueError("no rows to fit")
    slots = slots_of(rows, int(params.get("max_bins", 64)))
    state = written(_weighted(_binned(rows, slots), classes, base), "boosting-rows")
    state = state.coalesce(-(-state.count() // TASK_ROWS))
    depth, rate = int(params.get("max_depth") or 6) if "max_depth" in params else 3, float(params.get("learning_rate", 0.1))
    trees, since = [], []
    for _ in range(int(params.get("n_estimators", 100)) if slots else 0):
        new = grow(state, slots, classes, len(base), since, depth, rate)
        if not new:
            break
        trees, since = trees + new, since + new
        if len(since) >= REWRITE * len(base):
            state, since = written(_advanced(state, slots, since), "boosting-rows"), []
    used = sorted({slot for t in trees for slot, _ in t.cuts.values()})
    place = {slot: i for i, slot in enumerate(used)}
    plain = [
        [t.output, {str(n): [place[slot], [int(x) for x in left]] for n, (slot, left) in t.cuts.items()}, {str(n): v for n, v in t.leaves.items()}]
        for t in trees
    ]
    return fitted_head, {"base": base, "slots": [list(slots[i]) for i in used], "trees": plain}


def _advanced(rows: DataFrame, slots: list[Slot], trees: list[Tree]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = _Rows(batch, slots)
            if part.n:
                part.advance(trees)
            ends = pa.array((np.arange(part.n + 1) * part.margin.shape[1]).astype(np.int32))
            margin = pa.ListArray.from_arrays(ends, pa.array(part.margin.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("flags"), batch.column("y"), batch.column("weight"), margin], ["bins", "flags", "y", "weight", "margin"])

    return rows.mapInArrow(run, rows.schema)


def with_margins(head, meta: dict, df: DataFrame, output: str) -> DataFrame:
    """``df`` with the features and one margin per output of the trees."""
    slots = [Slot(*s) for s in meta["slots"]]
    trees = [Tree(o, {int(n): (s, left) for n, (s, left) in cuts.items()}, {int(n): v for n, v in leaves.items()}) for o, cuts, leaves in meta["trees"]]
    base = meta["base"]
    rows = head.transform(df)
    if not trees:
        return rows.withColumn(output, F.array(*[F.lit(float(b)) for b in base]))

    @F.pandas_udf("array<double>")
    def margins(values: pd.Series) -> pd.Series:
        held = np.stack(values.to_list()) if len(values) else np.zeros((0, len(slots)))
        bins = [bin_of(s, held[:, i]) for i, s in enumerate(slots)]
        out = np.tile(np.array(base, float), (len(values), 1))
        for tree in trees:
            out[:, tree.output] += leaf_values(tree, route(tree, bins.__getitem__))
        return pd.Series(list(out))

    sliced = VectorSlicer(inputCol=FEATURES, outputCol="_used", indices=[s.index for s in slots]).transform(rows)
    return sliced.withColumn(output, margins(vector_to_array("_used"))).drop("_used")
