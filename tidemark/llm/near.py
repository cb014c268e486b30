"""N-gram Jaccard join: pairs of texts whose sets of five-word shingles have a similarity of 0.8 or more.

Candidates come from MinHash LSH: ``TREES`` prefix labels of minimum hashes, all cut at one
depth, the longest whose expected recall at the threshold, ``1 - (1 - s^depth)^trees``,
reaches the target (no trie is kept, and no prefix depends on the data). Texts that share a
label join to candidate clusters. Clusters are then verified exactly, in blocks: a block
counts links and keeps a spanning forest of them, so what leaves it grows with its texts, not
with their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, word_hashes
from tidemark.session import written

SHINGLE, THRESHOLD, TARGET_RECALL = 5, (4, 5), 0.999  # the threshold as a fraction: tests stay whole numbers
TREES, DEPTH = 32, 8
#: Texts and shingles that one side of a verified block holds about; larger clusters take more blocks.
BLOCK_TEXTS, BLOCK_SHINGLES = 1000, 200_000
#: Multipliers that spread 64-bit shingle hashes, one for each minimum; drawn once from a fixed seed.
_SPREAD = np.random.default_rng(5).integers(1 << 62, 1 << 63, TREES * DEPTH, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def depth_for(target: float = TARGET_RECALL, threshold: float = THRESHOLD[0] / THRESHOLD[1], trees: int = TREES) -> int:
    """The longest prefix whose expected recall at the threshold reaches the target."""
    depth = DEPTH
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row, and how many each text has.

    Words are runs of everything but ASCII white space. A text of fewer than five words, but
    not none, is one shingle.
    """
    hashes, sizes = word_hashes(texts)
    rolled = np.zeros(max(0, len(hashes) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        rolled = rolled * _BASE + hashes[j : j + len(rolled)]
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), np.maximum(sizes - SHINGLE + 1, 0))
    within = np.arange(len(owner)) - np.repeat(np.cumsum(np.maximum(sizes - SHINGLE + 1, 0)) - np.maximum(sizes - SHINGLE + 1, 0), np.maximum(sizes - SHINGLE + 1, 0))
    values = rolled[starts[owner] + within] if len(owner) else np.zeros(0, np.uint64)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        single = sizes[short].astype(np.uint64)
        for j in range(SHINGLE - 1):
            there = sizes[short] > j
            single[there] = single[there] * _BASE + hashes[starts[short[there]] + j]
        owner, values = np.concatenate([owner, short]), np.concatenate([values, single])
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(32)
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[first], np.bincount(owner[first], minlength=len(texts))


def trie_nodes(values: np.ndarray, sizes: np.ndarray, depth: int) -> np.ndarray:
    """For each text and tree a hash of the node its label passes at a depth; texts without shingles have none (0)."""
    some = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[some]
    nodes = np.zeros((len(sizes), TREES), np.uint64)
    if not len(some):
        return nodes
    for tree in range(TREES):
        label = np.full(len(some), tree + 1, np.uint64)
        for k in range(depth):
            least = np.minimum.reduceat(values * _SPREAD[tree * DEPTH + k], starts)
            label = (label ^ (label >> np.uint64(31))) * _BASE + (least ^ (least >> np.uint64(32)))
        nodes[some, tree] = label
    return nodes


def sketches(docs: DataFrame, depth: int, id_column: str, text_column: str) -> DataFrame:
    """One row per input row: its id, text hash, a key of its shingle set, their number and its trie nodes."""
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            values, sizes = shingle_sets(texts)
            ends = np.cumsum(sizes)
            keys = [xxhash.xxh3_128_digest(values[e - n : e].tobytes()) if n else None for e, n in zip(ends, sizes, strict=True)]
            nodes = trie_nodes(values, sizes, depth).view(np.int64)
            nodes = pa.FixedSizeListArray.from_arrays(pa.array(nodes.ravel()), TREES).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(keys, pa.binary()), pa.array(sizes), nodes],
                ["doc_id", "text_hash", "set_key", "n_shingles", "nodes"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, set_key binary, n_shingles long, nodes array<long>")


def components(edges: DataFrame) -> DataFrame:
    """The connected component of every node of an edge list ``(u, v)``: ``node``, ``label`` (its least node).

    Edges lead from a node to a lesser one. Until they are stars, one step jumps from each node
    past its least end to the least end of that one's least end, and moves each further edge
    down to the least ends of both its nodes; an edge that is not part of a star always gets
    lesser. A step starts from a written table of the nodes that are not done (more than one
    lesser end, or ends both ways); edges join to it by two shuffles, in which the rows of a
    dominant node are split, and when it is empty the work is done. Edges that are stars already
    take no step. The edges given may repeat; they are read several times and should be a
    written table.
    """
    edges = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    while True:
        ends = edges.select(F.col("u").alias("node"), F.col("v").alias("end"), F.lit(False).alias("held"))
        ends = ends.unionAll(edges.select(F.col("v").alias("node"), F.lit(None).alias("end"), F.lit(True).alias("held")))
        undone = ends.groupBy("node").agg(F.min("end").alias("least"), F.max("end").alias("most"), F.bool_or("held").alias("held"))
        undone = undone.filter("least is not null and (least != most or held)").select("node", "least", F.expr("least != most").alias("many"), "held")
        undone = written(undone, "undone")
        many = undone.agg(F.bool_or("many")).first()[0]
        if many is None:
            break
        upper = undone.filter("many").select(F.col("node").alias("u"), F.col("least").alias("of_u"))
        lower = undone.filter("held").select(F.col("node").alias("v"), F.col("least").alias("end"))
        lower = lower.join(lower.select(F.col("v").alias("end"), F.col("end").alias("next")), "end", "left").select("v", F.coalesce("next", "end").alias("of_v"))
        ends = edges.join(upper, "u", "left").join(lower, "v", "left").select("u", "v", F.coalesce("of_u", "v").alias("of_u"), F.coalesce("of_v", "v").alias("of_v"))
        ends = ends.select(F.when(F.col("of_u") == F.col("v"), F.col("u")).otherwise(F.col("of_u")).alias("u"), F.col("of_v").alias("v"))
        ends = ends.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = written(ends.distinct() if many else ends, "star")  # where every node has one end already, nothing meets
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return found.unionAll(found.select(F.col("label").alias("node"), "label")).distinct()


def _links(values: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (into left, into right) of texts with a similarity of the threshold or more, by exact set sizes."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    common = np.zeros((len(left), len(right)), np.float32)
    width = max(1, (4 << 20) // max(1, len(sizes)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (lo, lo + width))
        held = np.zeros((len(sizes), int(column[b - 1]) - lo + 1), np.float32)
        held[owner[a:b], column[a:b] - lo] = 1
        common += held[left] @ held[right].T
    part, whole = THRESHOLD
    return np.nonzero((whole + part) * common >= part * (sizes[left][:, None] + sizes[right][None]))


def _verified(keys: list[bytes], copies: np.ndarray, side: np.ndarray, texts: list[bytes], same: bool):
    """Linked texts of a block: key, documents linked to it, least key of what it hangs together with here."""
    values, sizes = shingle_sets(texts)
    left = np.arange(len(keys)) if same else np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return
    a, b = _links(values, sizes, left, right)
    a, b = left[a], right[b]
    if same:
        a, b = a[a != b], b[a != b]
    else:
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
    if not len(a):
        return
    count = np.bincount(a, weights=copies[b], minlength=len(keys)).astype(np.int64)
    rank = np.argsort(np.argsort(np.array(keys, "S16")))
    low = rank.copy()
    while True:  # the least rank spreads along links until it is everywhere
        new = low.copy()
        np.minimum.at(new, a, low[b])
        if (new == low).all():
            break
        low = new
    of_rank = np.argsort(rank)
    for i in np.flatnonzero(count):
        yield keys[i], int(count[i]), keys[of_rank[low[i]]]


def verified_links(docs: DataFrame, members: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Links inside candidate clusters: ``set_key``, ``n_links`` (documents), ``low`` (a linked key), in parts."""
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    same = rows["doc_id"].eqNullSafe(members["rep_id"]) & (rows["text_hash"] == members["rep_hash"])
    rows = rows.join(members, same).select("cluster", "set_key", "copies", "blocks", "text")
    block = F.pmod(F.xxhash64("set_key"), F.col("blocks"))
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    key = [F.col("cluster"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    rows = rows.select(*key, (F.col("block") > F.col("other")).cast("int").alias("side"), "set_key", "copies", "text")
    rows = rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "set_key")

    def run(batches) -> Iterator[pa.RecordBatch]:
        def blocks():
            at, held = None, []
            for batch in batches:
                for row in batch.to_pylist():
                    now = (row["cluster"], row["i"], row["j"])
                    if now != at and held:
                        yield at, held
                        held = []
                    at = now
                    if not held or held[-1]["set_key"] != row["set_key"]:  # a repeated row is one text
                        held.append(row)
            if held:
                yield at, held

        found = []
        for (_, i, j), held in blocks():
            copies, side = (np.array([r[c] for r in held]) for c in ("copies", "side"))
            found += _verified([r["set_key"] for r in held], copies, side, [(r["text"] or "").encode() for r in held], i == j)
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], ["set_key", "n_links", "low"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found, strict=True)], ["set_key", "n_links", "low"])

    return rows.mapInArrow(run, "set_key binary, n_links long, low binary")


def jaccard_join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", target_recall: float = TARGET_RECALL) -> DataFrame:
    """One row per input row: ``doc_id``, ``text_hash``, ``class_id``, ``n_links``, ``copies``.

    ``class_id`` is the least id of all documents that links lead to from this one, ``n_links``
    the number of other documents with a similarity of 0.8 or more (copies counted each),
    ``copies`` the documents with the same shingles. Null and empty texts have no shingles: a
    class of their own, no links, one copy. A repeated row is a copy. Further columns are not
    read; an empty table gives an empty result.
    """
    all_rows = written(sketches(docs, depth_for(target_recall), id_column, text_column), "sketches")
    some = all_rows.filter("n_shingles > 0")
    sets = some.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("nodes").alias("nodes")
    )
    sets = written(sets.select("set_key", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"), "copies", "n_shingles", "nodes"), "sets")
    below = sets.select("set_key", F.explode("nodes").alias("node"))
    company = below.groupBy("node").agg(F.min("set_key").alias("low"), F.max("set_key").alias("high")).filter("low != high").select("node", "low")
    clusters = components(written(below.join(company, "node").filter("set_key != low").select(F.col("set_key").alias("u"), F.col("low").alias("v")).distinct(), "edges"))
    facts = sets.select("set_key", "rep_id", "rep_hash", "copies", "n_shingles")
    members = written(clusters.withColumnsRenamed({"node": "set_key", "label": "cluster"}).join(facts, "set_key"), "members")
    sizes = members.groupBy("cluster").agg(F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks"))
    members = members.join(sizes, "cluster")
    links = written(verified_links(docs, members, id_column, text_column), "links")
    counts = links.groupBy("set_key").agg(F.sum("n_links").alias("n_links"))
    classes = components(links.select(F.col("set_key").alias("u"), F.col("low").alias("v")))
    classes = classes.withColumnRenamed("node", "set_key").join(facts.select("set_key", "rep_id"), "set_key")
    least = classes.groupBy("label").agg(F.min("rep_id").alias("class_id"))
    linked = classes.join(least, "label").select("set_key", "class_id").join(counts, "set_key", "left")
    told = written(facts.join(linked, "set_key", "left").select("set_key", F.coalesce("class_id", "rep_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "copies"), "told")
    return all_rows.join(told, "set_key", "left").select(
        "doc_id", "text_hash", F.coalesce("class_id", "doc_id").alias("class_id"), (F.coalesce("n_links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("copies")
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that carry the least id of their class; of repeated rows one.

    Null and empty texts are classes of their own and stay; of several texts with the least id
    all stay that are of the class; columns of any name pass through; an empty table gives an
    empty result.
    """
    kept = jaccard_join(docs, id_column, text_column).filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct()
    # the row as a whole under one name: no column of the input can clash
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[id_column].alias("row_id"), F.xxhash64(docs[text_column].cast("string")).alias("row_hash"))
    rows = rows.dropDuplicates(["row_id", "row_hash"])
    return rows.join(kept, rows["row_id"].eqNullSafe(kept["kept_id"]) & (rows["row_hash"] == kept["kept_hash"]), "left_semi").select("row.*")
