"""Cross-entropy difference: how much better a target model predicts a text than the background model.

Two bigram models, one of the target documents and one of all documents, count real words and
pairs of words, each known by a 63-bit hash, so the models grow with the corpus and no counts
are shared. They are never held in one place: documents are dealt to blocks of bounded size by
a hash of the id, and each block counts its own texts. It sends its sorted keys and small
counts, packed, in one row per range of keys; a range adds up its keys over all blocks and
answers each block in the order of that block's own keys. So a frequent word or pair is one
entry of a block whatever its count, and no key travels back. Each document is scored by the
mean difference of the losses of its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text, native_words, text_bytes

#: Words at random are one of ``2**(WORD_BITS - 1)``, or of as many as the corpus has if those are more.
WORD_BITS = 16
#: Bytes of text of one block, about (a longer text is a block), and tokens of one range of keys.
BLOCK_BYTES, RANGE_TOKENS = 8 << 20, 1 << 20
#: Different words that a task of the first pass holds before it sends them on.
HELD_WORDS = 1 << 20
#: Weight of the unigram model in a bigram's estimate, in tokens.
PRIOR = 20.0
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(1)  # the last bit tells pairs from words


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_keys(words: list[bytes]) -> np.ndarray:
    """Key of each word: even and never 0, which is the start of a text."""
    keys = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words)) & ~_PAIR
    return np.where(keys == 0, np.uint64(2), keys)


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of each pair of words, given by their keys: odd."""
    x = (before ^ (before >> np.uint64(31))) * _SPREAD + word
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | _PAIR


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Whole numbers of one length, each array in as few bytes a number as its largest needs."""
    out = [np.array([len(arrays[0])], np.int64).tobytes()]
    for x in arrays:
        width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
        out += [bytes([width]), x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()]
    return b"".join(out)


def _unpacked(raw: bytes, count: int) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for _ in range(count):
        width = raw[at]
        x = np.zeros((n, 8), np.uint8)
        x[:, :width] = np.frombuffer(raw, np.uint8, n * width, at + 1).reshape(n, width)
        out.append(x.view("<u8").ravel())
        at += 1 + n * width
    return out


def range_starts(bits: int) -> np.ndarray:
    return np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)


def _packed_counts(counts: np.ndarray) -> bytes:
    """The four counts of each key in one byte if they are small, as most are; apart otherwise."""
    small = (counts[:2] < 8).all(axis=0) & (counts[2:] < 2).all(axis=0) & (counts[0] > 0)
    code = np.where(small, counts[0] | counts[1] << 3 | counts[2] << 6 | counts[3] << 7, 0).astype(np.uint8)
    return np.int64(len(code)).tobytes() + code.tobytes() + _packed(list(counts[:, ~small].view(np.uint64)))


def _unpacked_counts(raw: bytes) -> np.ndarray:
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    code = np.frombuffer(raw, np.uint8, n, 8).astype(np.int64)
    counts = np.stack([code & 7, code >> 3 & 7, code >> 6 & 1, code >> 7])
    counts[:, code == 0] = np.stack(_unpacked(raw[8 + n :], 4)).view(np.int64)
    return counts


def _numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct numbers, the place of each number among them, how often each occurs."""
    if not len(x):
        return x, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(x)
    x = x[order]
    new = np.concatenate([[True], x[1:] != x[:-1]])
    place = np.empty(len(x), np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return x[first], place, np.diff(np.append(first, len(x)))


class Counts:
    """Words and pairs of some texts: sorted keys, the place of every token's key, counts.

    Rows of ``counts`` are occurrences in all texts and in the target, and of these the ends of
    a text: a word has been a context as often as it occurs, less its ends. The start of a text
    has the key 0.
    """

    def __init__(self, texts: list[bytes], target: np.ndarray):
        numbers = _Numbers()
        parts = [np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)) for words in (t.split() for t in texts)]
        sizes = np.array([len(x) for x in parts], np.int64)
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        word = np.concatenate(parts) + 1 if parts else np.zeros(0, np.int32)
        before = np.zeros(len(word), np.int64)
        before[1:] = np.where(self.owner[1:] == self.owner[:-1], word[:-1], 0)
        ends = word[(np.cumsum(sizes) - 1)[sizes > 0]]
        names = np.concatenate([[np.uint64(0)], word_keys(list(numbers))])
        pairs, pair, _ = _numbered(before * len(names) + word)
        keys = np.concatenate([names, pair_keys(*(names[x] for x in np.divmod(pairs, len(names))))])
        self.keys, place, _ = _numbered(keys)
        self.word_at, self.context_at, self.pair_at = place[word], place[before], place[len(names) + pair]
        marked = target[self.owner]
        size = len(self.keys)
        self.counts = np.zeros((4, size), np.int64)
        for i, some in enumerate((slice(None), marked)):
            starts = np.flatnonzero(sizes > 0) if i == 0 else np.flatnonzero((sizes > 0) & target)
            self.counts[i] = np.bincount(self.word_at[some], minlength=size) + np.bincount(self.pair_at[some], minlength=size)
            self.counts[i, place[0]] += len(starts)
            last = ends if i == 0 else ends[target[sizes > 0]]
            self.counts[2 + i] = np.bincount(place[last], minlength=size)

    def ranges(self, bits: int) -> np.ndarray:
        """Where the keys of each of ``2**bits`` ranges begin, and the end."""
        return np.append(np.searchsorted(self.keys, range_starts(bits)), len(self.keys))

    def losses(self, target: np.ndarray, total: tuple[int, int], vocabulary: int) -> np.ndarray:
        """Loss of every token in nats under both models.

        A text is scored by what all other texts have counted: its own counts are taken out of
        the background, and out of the target if it belongs there.
        """
        own = [_own_counts(self.owner, at, len(self.keys)) for at in (self.word_at, self.context_at, self.pair_at)]
        size = np.bincount(self.owner, minlength=len(target))[self.owner]
        out = np.empty((2, len(self.owner)))
        # both models get the weight of the smaller one against the prior, so what differs is not their size
        matched = min(total) / np.maximum(np.array(total, float), 1.0)
        for i in range(2):
            part = np.ones(len(self.owner)) if i == 0 else target[self.owner].astype(float)
            tables = (self.counts[i][self.word_at], (self.counts[i] - self.counts[2 + i])[self.context_at], self.counts[i][self.pair_at])
            word, around, pair = ((t - part * o) * matched[i] for t, o in zip(tables, own, strict=True))
            alone = (word + 1.0) / ((total[i] - part * size) * matched[i] + vocabulary)
            out[i] = -np.log((pair + PRIOR * alone) / (around + PRIOR))
        return out


def _own_counts(owner: np.ndarray, at: np.ndarray, keys: int) -> np.ndarray:
    """For each token, how often its text has its key."""
    _, place, times = _numbered(owner * max(keys, 1) + at)
    return times[place]


def corpus_facts(source: DataFrame) -> tuple[int, int, int]:
    """Bytes of text, tokens, and different words of the column ``text``."""
    span = 12

    def words(batches) -> Iterator[pa.RecordBatch]:
        names = ["range", "keys", "bytes", "tokens"]
        totals, held = [0, 0], _Numbers()

        def flushed() -> pa.RecordBatch:
            keys = np.unique(word_keys(list(held)))
            held.clear()
            edges = np.append(np.searchsorted(keys, range_starts(span)), len(keys))
            some = np.flatnonzero(np.diff(edges))
            blobs = [_packed([np.diff(keys[edges[i] : edges[i + 1]], prepend=range_starts(span)[i])]) for i in some]
            facts = [[x, *[0] * (len(blobs))] for x in totals]
            totals[:] = [0, 0]
            return pa.RecordBatch.from_arrays([pa.array([-1, *some.tolist()], pa.int32()), pa.array([None, *blobs], pa.binary()), *(pa.array(x, pa.int64()) for x in facts)], names)

        for batch in batches:
            for text in text_bytes(batch.column("text")):
                split = text.split()
                held.update(dict.fromkeys(split, 0))
                totals[0] += len(text)
                totals[1] += len(split)
                if len(held) > HELD_WORDS:
                    yield flushed()
        yield flushed()

    def distinct(table: pa.Table) -> pa.Table:
        keys: np.ndarray = np.zeros(0, np.uint64)
        # keys from the start of their range, which is the same for all
        parts = [np.cumsum(_unpacked(raw, 1)[0], dtype=np.uint64) for raw in table["keys"].to_pylist() if raw]
        for lo in range(0, len(parts), 64):
            keys = np.unique(np.concatenate([keys, *parts[lo : lo + 64]]))
        sums = [pa.array([pc.sum(table[c]).as_py()], pa.int64()) for c in ("bytes", "tokens")]
        return pa.Table.from_arrays([pa.array([len(keys)], pa.int64()), *sums], ["words", "bytes", "tokens"])

    found = source.select("text").mapInArrow(words, "range int, keys binary, bytes long, tokens long")
    found = found.groupBy("range").applyInArrow(distinct, "words long, bytes long, tokens long")
    n = found.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words", "bytes", "tokens"))).first()
    return n["bytes"], n["tokens"], n["words"]


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_tokens``, ``target_loss``, ``background_loss``, ``score``.

    Losses are means over the tokens of the whole text; ``score`` is target minus background,
    low where a text looks like the target. Null and empty texts have no tokens and null losses.
    A text is scored without its own counts, so target documents gain nothing from having been
    counted. Without target documents the target model knows nothing and every loss is that of
    a word at random. Repeated rows give repeated results; an empty table gives an empty
    result; further columns are not read. A task holds one block of texts with its counts, or
    one range of keys; the driver gets four numbers. Texts are shuffled once, to the block
    of their id; counting and scoring read the same shuffle.
    """
    rows = id_and_text(docs, id_column, text_column)
    kind = rows.schema["doc_id"].dataType
    ids = target_ids.select(F.col(target_ids.columns[0]).cast(kind).alias("doc_id")).filter("doc_id is not null").distinct()
    size, tokens, words = corpus_facts(rows)
    in_target = rows.select("doc_id", F.size(native_words(F.col("text"))).alias("n")).join(ids, "doc_id", "left_semi")
    total = (tokens, in_target.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    vocabulary = max(words, 1 << WORD_BITS - 1)
    blocks, bits = -(-size // BLOCK_BYTES) or 1, max(0, (tokens // RANGE_TOKENS).bit_length())
    # target ids go to the blocks of their documents, so no text is moved to be marked
    both = rows.withColumn("is_id", F.lit(False)).unionByName(ids.select("doc_id", F.lit(None).cast("string").alias("text"), F.lit(True).alias("is_id")))
    source = both.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))

    def opened(block: pa.Table) -> tuple[pa.Table, np.ndarray, Counts]:
        """The documents of a block, which of them belong to the target, their counts."""
        texts = block.filter(pc.invert(block["is_id"]))
        wanted = block.filter(block["is_id"])["doc_id"]
        target = pc.is_in(texts["doc_id"], value_set=wanted.combine_chunks()).to_numpy()
        return texts, target, Counts(text_bytes(texts["text"]), target)

    def count(texts: pa.Table) -> pa.Table:
        _, _, here = opened(texts)
        edges, starts = here.ranges(bits), range_starts(bits)
        some = np.flatnonzero(np.diff(edges))
        blobs = []
        for i in some:
            part = slice(edges[i], edges[i + 1])
            blobs.append((_packed([np.diff(here.keys[part], prepend=starts[i])]), _packed_counts(here.counts[:, part])))
        block = pa.array([texts["block"][0].as_py()] * len(some), pa.int64())
        keys, counts = (pa.array([b[k] for b in blobs], pa.binary()) for k in (0, 1))
        return pa.Table.from_arrays([pa.array(some.astype(np.int64)), block, keys, counts], ["range", "block", "keys", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        # keys from the start of their range, which is the same for all
        deltas = [_unpacked(raw, 1)[0] for raw in rows["keys"].to_pylist()]
        keys, place, _ = _numbered(np.concatenate([np.cumsum(d, dtype=np.uint64) for d in deltas]))
        counts = np.concatenate([_unpacked_counts(raw) for raw in rows["counts"].to_pylist()], axis=1)
        sums = np.stack([np.bincount(place, c, len(keys)) for c in counts]).astype(np.int64)  # exact below 2**53
        ends = np.cumsum([len(d) for d in deltas])
        out = [_packed_counts(sums[:, place[e - len(d) : e]]) for d, e in zip(deltas, ends, strict=True)]
        return pa.Table.from_arrays([rows["range"].combine_chunks(), rows["block"].combine_chunks(), pa.array(out, pa.binary())], ["range", "block", "counts"])

    def score(texts: pa.Table, sums: pa.Table) -> pa.Table:
        texts, target, here = opened(texts)
        edges = here.ranges(bits)
        for i, raw in zip(sums["range"].to_pylist(), sums["counts"].to_pylist(), strict=True):
            here.counts[:, edges[i] : edges[i + 1]] = _unpacked_counts(raw)
        size = np.bincount(here.owner, minlength=len(target))
        means = [np.bincount(here.owner, weights=x, minlength=len(target)) / np.maximum(size, 1) for x in here.losses(target, total, vocabulary)]
        gone = size == 0
        values = [pa.array(x, mask=gone) for x in (means[1], means[0], means[1] - means[0])]
        return pa.Table.from_arrays([texts["doc_id"], pa.array(size), *values], ["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    counts = source.groupBy("block").applyInArrow(count, "range long, block long, keys binary, counts binary")
    sums = counts.groupBy("range").applyInArrow(add, "range long, block long, counts binary")
    both = source.groupBy("block").cogroup(sums.groupBy("block"))
    return both.applyInArrow(score, f"doc_id {kind.simpleString()}, n_tokens long, target_loss double, background_loss double, score double")
