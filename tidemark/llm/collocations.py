"""Phrase collocations from weighted acyclic automata.

Every place of a text begins one window of three words, cut at the end of its piece; a phrase
occurs as often as it is a prefix of a window. A task sorts the windows of its blocks of text
and builds of each a count transducer: an automaton of three levels whose paths are windows and
whose last arcs carry counts, in which states with the same single arc are one. Transducers are
stored, cut at prefixes that part the whole corpus into ranges of about equal size, and the
pieces of a range are united and their weights summed. What a frequent prefix has in several
ranges is added up by a shuffle of those few sums. Counts of the parts of a phrase come from
composing an acceptor of the parts with the transducer of all frequent phrases.

Words are ordered by a 64-bit hash, then by their bytes; the hash only places them, so counts are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_bytes
from tidemark.session import arrow_batches, written

WORDS, LEAST, TOP, COVERED = 3, 10, 2000, 50
UNDETERMINED = "und"
#: Bytes of text of one shard, about, and of a text that are split at once.
BLOCK_BYTES, PART_BYTES = 12 << 20, 2 << 20
#: Bytes of rows (texts, shards, pieces of ranges) that Spark hands to a task at once, about.
BATCH_BYTES = 2 << 20
#: Windows of one range, about, and how many samples of a range tell where it ends.
RANGE_WINDOWS, SAMPLES = 1_000_000, 64
#: Windows of a range that wait to be added up, at least.
WAITING = 250_000
#: Parquet closes a page when a row has filled it, not after a hundred rows: a page is one shard, and so are its codec's buffers.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1"}
#: Phrases of one composition, about.
BUCKET = 200_000
_END = b"\xff"  # no byte of UTF-8: the end of a piece
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\v\f\r\t", b"abcdefghijklmnopqrstuvwxyz" + 10 * _END + b" ")


class _Numbers(dict):
    """Numbers of words in the order they come; the end of a piece is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _bits(size: int) -> int:
    return max(1, int(size).bit_length())


def _sorted_sums(columns: list[np.ndarray], counts: np.ndarray | None, size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of number columns (below ``size``) in order, with their summed counts."""
    if not len(columns[0]):
        return columns, np.zeros(0, np.int64)
    bits = _bits(size)
    if bits * len(columns) <= 63:
        key = columns[0].astype(np.int64)
        for c in columns[1:]:
            key = key << bits | c
        if counts is None:
            key = np.sort(key)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sums = np.diff(np.append(first, len(key)))
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sums = np.add.reduceat(counts[order], first)
        key = key[first]
        return [key >> bits * (len(columns) - 1 - i) & (1 << bits) - 1 for i in range(len(columns))], sums
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    first = np.flatnonzero(np.concatenate([[True], new]))
    counts = np.ones(len(order), np.int64) if counts is None else counts[order]
    return [c[first].astype(np.int64) for c in columns], np.add.reduceat(counts, first)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows of sorted columns change."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = columns[0][1:] != columns[0][:-1]
    for c in columns[1:]:
        new |= c[1:] != c[:-1]
    return np.flatnonzero(np.concatenate([[True], new]))


def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


class Transducer(NamedTuple):
    """A weighted acyclic automaton of three levels over numbered words (0 is the end of a piece).

    ``first`` are the labels of the arcs out of the start and ``fan`` how many arcs leave each
    of their states; ``second`` and ``target`` are labels and target states of those arcs;
    ``width`` is how many arcs leave each of these states, ``third`` and ``weight`` are theirs.
    """

    first: np.ndarray
    fan: np.ndarray
    second: np.ndarray
    target: np.ndarray
    width: np.ndarray
    third: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, windows: list[np.ndarray], counts: np.ndarray) -> Transducer:
        """Built from sorted distinct windows; states whose only arc has the same label and weight are one."""
        a, b, c = windows
        pair = _runs(a, b)
        arcs = np.diff(np.append(pair, len(a)))
        head = _runs(a[pair])
        single = arcs == 1
        labels, of_label = np.unique(c[pair[single]], return_inverse=True)
        weights, of_weight = np.unique(counts[pair[single]], return_inverse=True)
        register, target_of = np.unique(of_label * np.int64(max(1, len(weights))) + of_weight, return_inverse=True)
        target = np.empty(len(pair), np.int64)
        target[single] = target_of
        target[~single] = len(register) + np.arange((~single).sum())
        own = np.repeat(~single, arcs)
        return cls(
            a[pair][head], np.diff(np.append(head, len(pair))), b[pair], target, np.concatenate([np.ones(len(register), np.int64), arcs[~single]]),
            np.concatenate([labels[register // max(1, len(weights))], c[own]]), np.concatenate([weights[register % max(1, len(weights))], counts[own]]),
        )

    def windows(self) -> tuple[list[np.ndarray], np.ndarray]:
        """All paths, in order, with their weights."""
        start = np.cumsum(self.width) - self.width
        arcs = self.width[self.target].astype(np.int64)
        at = np.repeat(start[self.target] - (np.cumsum(arcs) - arcs), arcs) + np.arange(arcs.sum())
        pairs = np.repeat(self.first, self.fan)
        return [np.repeat(pairs, arcs).astype(np.int64), np.repeat(self.second, arcs).astype(np.int64), self.third[at].astype(np.int64)], self.weight[at].astype(np.int64)

    def packed(self) -> bytes:
        arrays = [_small(x) for x in self]
        head = np.array([(len(x), x.itemsize) for x in arrays], np.int64)
        return head.tobytes() + b"".join(x.tobytes() for x in arrays)

    @classmethod
    def unpacked(cls, raw: bytes) -> Transducer:
        n, at, out = len(cls._fields), 16 * len(cls._fields), []
        for size, width in np.frombuffer(raw, np.int64, 2 * n).reshape(n, 2).tolist():
            out.append(np.frombuffer(raw, f"<u{width}", size, at).astype(np.int64))
            at += size * width
        return cls(*out)

    def composed(self, asked: Transducer) -> tuple[list[np.ndarray], np.ndarray]:
        """Paths that both have, with the weights of this one: the two are walked level by level, matching labels."""
        base = int(max(self.second.max(initial=0), asked.second.max(initial=0), self.third.max(initial=0), asked.third.max(initial=0))) + 1
        # level one: states of the same first word
        _, mine, theirs = np.intersect1d(self.first, asked.first, assume_unique=True, return_indices=True)
        partner = np.full(len(asked.first), -1)
        partner[theirs] = mine
        # level two: arcs of partner states with the same label
        state = np.repeat(np.arange(len(self.first)), self.fan)
        other = np.repeat(partner, asked.fan)
        arcs, wanted = state * base + self.second, other * base + asked.second
        at = np.searchsorted(arcs, wanted)
        found = (other >= 0) & (np.append(arcs, -1)[at] == wanted)
        first = np.repeat(asked.first, asked.fan)[found]
        second, here, there = asked.second[found], self.target[at[found]], asked.target[found]
        # level three: arcs of both target states
        start, asked_start = np.cumsum(self.width) - self.width, np.cumsum(asked.width) - asked.width
        many = asked.width[there]
        pick = np.repeat(asked_start[there] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        of = np.repeat(np.arange(len(there)), many)
        arcs = np.repeat(np.arange(len(self.width)), self.width) * base + self.third
        order = np.argsort(arcs, kind="stable")
        wanted = here[of] * base + asked.third[pick]
        at = np.searchsorted(arcs[order], wanted)
        found = np.append(arcs[order], -1)[at] == wanted
        return [first[of][found], second[of][found], asked.third[pick][found]], self.weight[order[at[found]]]


def _hashes(words: list[bytes]) -> np.ndarray:
    found = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    return np.where(found == 0, np.uint64(1), found)  # 0 is the end of a piece


class Shard:
    """Windows of texts of one language, counted."""

    def __init__(self) -> None:
        self.numbers, self.parts = _Numbers(), []
        self.numbers[_END] = 0

    def add(self, text: bytes) -> None:
        text = text.translate(_TABLE)
        at = 0
        while at < len(text):
            cut = len(text)
            if cut - at > PART_BYTES:  # after a space, so that no word is cut
                space = text.rfind(b" ", at, at + PART_BYTES)
                space = space if space >= 0 else text.find(b" ", at + PART_BYTES)
                cut = space + 1 if space >= 0 else cut
            words = text[at:cut].replace(_END, b" \xff ").split()
            self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
            at = cut
        self.parts.append(np.zeros(1, np.int32))

    def counted(self) -> tuple[list[bytes], np.ndarray, list[np.ndarray], np.ndarray]:
        """Words in order with their hashes (an empty word in front), sorted windows, counts."""
        numbers = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        words = list(self.numbers)[1:]
        hashes = _hashes(words)
        order = np.argsort(hashes, kind="stable")
        if len(order) and (np.diff(hashes[order]) == 0).any():
            order = np.array(sorted(range(len(words)), key=lambda i: (int(hashes[i]), words[i])))
        rank = np.zeros(len(words) + 1, np.int32)
        rank[order + 1] = np.arange(1, len(words) + 1)
        one = np.concatenate([rank[numbers], np.zeros(2, np.int32)])  # padded: every window has three places
        at = np.flatnonzero(one)
        two, three = one[at + 1], one[at + 2]
        three[two == 0] = 0
        windows, counts = _sorted_sums([one[at], two, three], None, len(words) + 1)
        return [b"", *(words[i] for i in order)], np.concatenate([[np.uint64(0)], hashes[order]]), windows, counts


def _places(windows: list[np.ndarray], hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of the sorted ``ends`` (rows of three hashes) each window reaches: its range. Only hashes decide."""
    if not len(ends) or not len(windows[0]):
        return np.zeros(len(windows[0]), np.int64)
    distinct, dense = np.unique(hashes, return_inverse=True)
    bits = _bits(len(distinct) + 1)
    at = np.searchsorted(distinct, ends)
    there = np.append(distinct, np.uint64(0))[at] == ends
    at[:, 1] = np.where(there[:, 0], at[:, 1], 0)  # a word that no window has: whatever follows it
    at[:, 2] = np.where(there[:, 0] & there[:, 1], at[:, 2], 0)
    if 3 * bits <= 63:
        key = lambda c: c[0].astype(np.int64) << 2 * bits | c[1].astype(np.int64) << bits | c[2]
        return np.searchsorted(key(at.T), key([dense[w] for w in windows]), side="right")
    rows = np.concatenate([at, np.stack([dense[w] for w in windows], axis=1)])
    order = np.lexsort((np.repeat([0, 1], [len(at), len(windows[0])]), rows[:, 2], rows[:, 1], rows[:, 0]))
    out = np.empty(len(rows), np.int64)
    out[order] = np.cumsum(order < len(at))
    return out[len(at) :]


def _united(pieces: Iterable[tuple[bytes, bytes]]) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """Words (an empty one in front), sorted windows and summed weights of the pieces of a range.

    Windows that came are added up whenever as many wait as are different, so memory follows the
    different windows of the range, however many pieces it has.
    """
    numbers = _Numbers()
    numbers[b""] = 0
    columns, counts, waiting, different = [np.zeros((WORDS, 0), np.int32)], [np.zeros(0, np.int64)], 0, 0
    for raw, arcs in pieces:
        to = np.array([numbers[w] for w in (b"", *raw.split(b"\n"))], np.int32)
        windows, weight = Transducer.unpacked(arcs).windows()
        columns.append(np.stack([to[w] for w in windows]))
        counts.append(weight)
        waiting += len(weight)
        if waiting >= max(WAITING, different):
            windows, weight = _sorted_sums(list(np.concatenate(columns, axis=1)), np.concatenate(counts), len(numbers))
            columns, counts, waiting, different = [np.stack(windows).astype(np.int32)], [weight], 0, len(weight)
    windows, weight = _sorted_sums(list(np.concatenate(columns, axis=1)), np.concatenate(counts), len(numbers))
    return list(numbers), windows, weight


_SHARD = ["lang", "n", "words", "arcs", "sample"]


def _shard_rows(lang: str, shard: Shard, seed: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """A shard, and every so many of its windows; where these begin is drawn, as alike shards would all have the same ones."""
    words, hashes, windows, counts = shard.counted()
    del shard  # counted, and nobody else's
    if not len(counts):
        return
    step = RANGE_WINDOWS // SAMPLES
    drawn = slice(int(np.random.default_rng(seed).integers(step)), None, step)
    sample = np.stack([hashes[w[drawn]] for w in windows], axis=1)
    arrays = [pa.array([lang]), pa.array([int(counts.sum())]), pa.array([b"\n".join(words[1:])], pa.large_binary()), pa.array([Transducer.of(windows, counts).packed()], pa.large_binary()), pa.array([sample.tobytes()], pa.binary())]
    yield pa.RecordBatch.from_arrays(arrays, _SHARD)


def _shards(batches) -> Iterator[pa.RecordBatch]:
    held: dict[str, Shard] = {}
    size, made, task = 0, 0, TaskContext.get().partitionId()

    def rows() -> Iterator[pa.RecordBatch]:
        nonlocal made
        while held:
            name = next(iter(held))
            yield from _shard_rows(name, held.pop(name), (task, made))
            made += 1

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            for lang, text in zip(part.column("lang").to_pylist(), text_bytes(part.column("text")), strict=True):
                if not text:
                    continue
                held.setdefault(lang, Shard()).add(text)
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield from rows()
                    size = 0
    yield from rows()


def _range_ends(shards: DataFrame) -> dict[str, np.ndarray]:
    """For each language the sorted windows, as three hashes each, at which a new range begins.

    One for ``RANGE_WINDOWS`` windows, 24 bytes each: 80 MB for the 100 TB of a corpus.
    """
    def rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, raw in zip(batch.column("lang").to_pylist(), batch.column("sample").to_pylist(), strict=True):
                sample = np.frombuffer(raw, "<u8").reshape(-1, 3)
                # as signed numbers in the same order
                signed = (sample ^ np.uint64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(sample), pa.string()), *(pa.array(signed[:, i]) for i in range(3))], ["lang", "a", "b", "c"])

    def every(batches) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at = np.arange(SAMPLES - 1 - seen % SAMPLES, batch.num_rows, SAMPLES)
            seen += batch.num_rows
            yield batch.take(pa.array(at))

    columns = ["lang", "a", "b", "c"]
    schema = "lang string, a long, b long, c long"
    samples = shards.select("lang", "sample").mapInArrow(rows, schema)
    # so few partitions that what is left over in each, less than SAMPLES rows, does not count
    partitions = max(1, shards.agg(F.sum(F.length("sample"))).first()[0] or 0) // (24 * 1000 * SAMPLES) + 1
    picked = samples.repartitionByRange(partitions, *columns).sortWithinPartitions(*columns).mapInArrow(every, schema)
    ends: dict[str, list] = {}
    for r in picked.distinct().toLocalIterator():
        ends.setdefault(r["lang"], []).append((r["a"], r["b"], r["c"]))
    return {lang: np.array(sorted(rows_), np.int64).view(np.uint64) ^ np.uint64(1 << 63) for lang, rows_ in ends.items()}


def frequent_phrases(shards: DataFrame, least: int) -> DataFrame:
    """All phrases of one to three words found ``least`` times or more: ``lang``, ``words``, ``phrase``, ``n``."""
    ends = _range_ends(shards)
    offsets, total = {}, 0
    for r in sorted(shards.select("lang").distinct().collect()):
        offsets[r["lang"]], total = total, total + len(ends.get(r["lang"], ())) + 1
    shared = shards.sparkSession.sparkContext.broadcast((ends, offsets))
    none = np.zeros((0, 3), np.uint64)

    def cut(batches) -> Iterator[pa.RecordBatch]:
        known, offset = shared.value
        for batch in batches:
            for lang, raw, arcs in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "arcs")), strict=True):
                words = [b"", *raw.split(b"\n")]
                windows, counts = Transducer.unpacked(arcs).windows()
                place = _places(windows, np.concatenate([[np.uint64(0)], _hashes(words[1:])]), known.get(lang, none))
                mark = np.zeros(len(words), bool)
                order = np.argsort(place, kind="stable")
                bounds = _runs(place[order])
                for lo, hi in zip(bounds, [*bounds[1:], len(order)], strict=True):
                    at = order[lo:hi]
                    held = [w[at] for w in windows]
                    if len(at) * 8 < len(words):
                        some = np.union1d([0], np.concatenate(held))
                        numbered = [np.searchsorted(some, w) for w in held]
                    else:
                        mark[:] = False
                        mark[0] = True
                        for w in held:
                            mark[w] = True
                        some, to = np.flatnonzero(mark), np.cumsum(mark) - 1
                        numbered = [to[w] for w in held]
                    piece = Transducer.of(numbered, counts[at])
                    arrays = [pa.array([offset[lang] + int(place[at[0]])], pa.int32()), pa.array([lang]), pa.array([b"\n".join(words[i] for i in some[1:])], pa.binary()), pa.array([piece.packed()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, ["place", "lang", "words", "arcs"])

    def unite(batches) -> Iterator[pa.RecordBatch]:
        known, offset = shared.value

        def answer(lang: str, place: int, pieces: Iterable[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
            words, windows, weight = _united(pieces)
            edges = known.get(lang, none)
            k = place - offset[lang]
            # where this range begins and ends: the prefixes of these windows have more in other ranges
            edges = edges[max(0, k - 1) : k + 1]
            hashes = np.concatenate([[np.uint64(0)], _hashes(words[1:])]) if len(edges) else none
            found: list[tuple[int, str, int]] = []
            for size in range(1, WORDS + 1):
                start = _runs(*windows[:size])
                n = np.add.reduceat(weight, start)
                keep = n >= least
                for edge in edges[:, :size] if size < WORDS else ():
                    keep |= np.all([hashes[w[start]] == h for w, h in zip(windows, edge)], axis=0)
                keep &= windows[size - 1][start] > 0
                rows = np.stack([w[start[keep]] for w in windows[:size]], axis=1).tolist()
                found += [(size, b" ".join([words[i] for i in row]).decode(), c) for row, c in zip(rows, n[keep].tolist(), strict=True)]
            for lo in range(0, len(found), 50_000):
                sizes, phrases, n = zip(*found[lo : lo + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(sizes, pa.int32()), pa.array(phrases), pa.array(n, pa.int64())], ["lang", "words", "phrase", "n"])

        rows = ([batch.column(c)[i].as_py() for c in ("lang", "place", "words", "arcs")] for batch in batches for i in range(batch.num_rows))
        for at, own in groupby(rows, lambda r: (r[0], r[1])):
            yield from answer(*at, ((raw, arcs) for _, _, raw, arcs in own))

    pieces = shards.select("lang", "words", "arcs").mapInArrow(cut, "place int, lang string, words binary, arcs binary")
    parted = pieces.repartitionById(max(1, total), "place").sortWithinPartitions("place", "lang")
    sums = parted.mapInArrow(unite, "lang string, words int, phrase string, n long")
    return sums.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _transducer(phrases: list[bytes], weights: np.ndarray, numbers: _Numbers) -> Transducer:
    """A transducer of phrases (end labels behind short ones)."""
    rows = np.zeros((3, len(phrases)), np.int64)
    for i, p in enumerate(phrases):
        for k, w in enumerate(p.split(b" ")):
            rows[k, i] = numbers[w]
    windows, sums = _sorted_sums(list(rows), weights, len(numbers))
    return Transducer.of(windows, sums)


def part_counts(frequent: DataFrame, asked: DataFrame) -> DataFrame:
    """``lang``, ``phrase``, ``n`` of the asked phrases, by composing acceptors of them with transducers of all counts.

    Both sides are distinct and dealt by a hash of the whole phrase, so no bucket is hot.
    """
    buckets = max(1, -(-frequent.count() // BUCKET))
    dealt = F.pmod(F.xxhash64("lang", "phrase"), F.lit(buckets)).alias("bucket")

    def compose(counts: pa.Table, questions: pa.Table) -> pa.Table:
        out = [pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.int64())]
        langs, found = sorted(set(questions["lang"].to_pylist())), []
        for lang in langs:
            numbers = _Numbers()
            numbers[b""] = 0
            mine, theirs = (t.filter(pc.equal(t["lang"], lang)) for t in (counts, questions))
            if not len(mine):
                continue
            spelled = [[p.encode() for p in t["phrase"].to_pylist()] for t in (mine, theirs)]
            transducer = _transducer(spelled[0], mine["n"].to_numpy(), numbers)
            windows, n = transducer.composed(_transducer(spelled[1], np.ones(len(theirs), np.int64), numbers))
            words = list(numbers)
            phrases = [b" ".join([words[i] for i in row if i]).decode() for row in np.stack(windows, axis=1).tolist()]
            found.append((pa.array([lang] * len(n)), pa.array(phrases, pa.string()), pa.array(n)))
        out = [pa.concat_arrays(list(x)) for x in zip(*found, strict=True)] if found else out
        return pa.Table.from_arrays(out, ["lang", "phrase", "n"])

    both = frequent.select(dealt, "lang", "phrase", "n").groupBy("bucket").cogroup(asked.select(dealt, "lang", "phrase").groupBy("bucket"))
    return both.applyInArrow(compose, "lang string, phrase string, n long")


def _cuts() -> Column:
    """The two parts of a phrase for each place it can be cut: ``k``, ``first``, ``rest``."""
    parts = F.split("phrase", " ")
    return F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(k.alias("k"), F.array_join(F.slice(parts, F.lit(1), k), " ").alias("first"), F.array_join(F.slice(parts, k + 1, F.col("words") - k), " ").alias("rest")),
    )


def scored(cuts: DataFrame) -> DataFrame:
    """``floor(1000000 * a * a / (l * r))`` as ``score``, exact up to ``a`` of ``10**16``."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    made = cuts.withColumns({"top": F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a")), "below": wide("l") * wide("r")})
    return made.withColumn("score", F.expr("top div below")).drop("top", "below")


def collocations(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut that scores least, ``n`` all
    words of the language; ``score`` is ``floor(1000000 * a * a / (l * r))``. A phrase inside a
    longer one that has ``covered`` percent of its count goes. Ties: score, then ``a``, then the
    phrase by its bytes. A null language is ``und``; null and empty texts have no words; a
    repeated row counts again; an empty table, or one without frequent phrases, gives no rows;
    further columns are not read. Shards hold about 12 MB of text, whole texts of any length;
    a range holds about a million windows, each once per shard at most, and adds them up as they come.
    Texts, shards and pieces reach Python about 2 MB at a time, however many rows that is.
    """
    rows = docs.select(F.coalesce(docs[lang_column].cast("string"), F.lit(UNDETERMINED)).alias("lang"), docs[text_column].cast("string").alias("text"))
    with arrow_batches(docs.sparkSession, BATCH_BYTES):
        shards = written(rows.mapInArrow(_shards, "lang string, n long, words binary, arcs binary, sample binary"), "shards", **LARGE_ROWS)
        frequent = written(frequent_phrases(shards, least), "phrases")
    phrases = frequent.filter("words > 1").withColumnRenamed("n", "a")
    longer = phrases.filter(F.col("words") == WORDS).select("lang", "a", F.explode(F.flatten(F.transform(_cuts(), lambda c: F.array(c["first"], c["rest"])))).alias("phrase"))
    held = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = phrases.join(held, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True))).drop("longer")
    cuts = written(left.select("lang", "phrase", "a", F.explode(_cuts()).alias("cut")).select("lang", "phrase", "a", "cut.*"), "cuts")
    asked = cuts.select("lang", F.explode(F.array("first", "rest")).alias("phrase")).distinct()
    parts = written(part_counts(frequent, asked), "parts")
    for name, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(name), F.col("n").alias(count)), ["lang", name])
    best = scored(cuts).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low")).select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    place = "partition by {} order by score desc, a desc, phrase"
    # a language may hold all phrases: each of 64 parts keeps its first ones before they meet
    best = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.expr(f"row_number() over ({place.format('lang, part')})")).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.expr(f"row_number() over ({place.format('lang')})").cast("long")).filter(F.col("rank") <= top)
    sizes = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
