"""Substring dedup: words inside windows of 35 words that start anywhere else in the corpus.

Work is dealt by anchors. The anchor of a window is the least hash of four words in it, so
equal windows share it wherever they stand; a run of windows with one anchor is a stretch.
Stretches whose anchor occurs once can't repeat and are never moved. Equal stretches become
one with a count. The different stretches of an anchor go to one shard, an FM-index over a
wavelet tree of word numbers, and are streamed through it: backward search gives the longest
match that ends at a word, and matches of a whole window found twice are reported. Windows of
an anchor with very many stretches are first counted by their hash; of each window found twice
two places go to a shard, and the answer is joined back to all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, word_hashes
from tidemark.session import written

WINDOW, ANCHOR_WORDS = 35, 4
#: Words of one shard, about; stretches of an anchor beyond which its windows are counted first.
SHARD_WORDS, HOT_STRETCHES = 200_000, 1000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Spelling:
    """Word hashes of some texts in a row, and a hash of any run of them."""

    def __init__(self, texts: list[bytes]):
        self.hashes, self.sizes = word_hashes(texts)
        self.starts = np.cumsum(self.sizes) - self.sizes
        n = len(self.hashes)
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))
        inverse = np.cumprod(np.full(n, _INVERSE))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.hashes * inverse)])

    def run_hash(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        rolled = (self.sums[start + size] - self.sums[start]) * self.power[start]
        return _mixed(rolled ^ _mixed(size.astype(np.uint64)))


def stretches(spelled: Spelling) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: owner, start in its text, windows, anchor, hash of the run's words."""
    h, owner = spelled.hashes, np.repeat(np.arange(len(spelled.sizes)), spelled.sizes)
    windows = len(h) - WINDOW + 1
    if windows <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    grams = np.zeros(len(h) - ANCHOR_WORDS + 1, np.uint64)
    for j in range(ANCHOR_WORDS):
        grams = grams * _BASE + h[j : len(h) - ANCHOR_WORDS + 1 + j]
    grams = _mixed(grams)
    at, least, reach, span = np.arange(len(grams)), grams, 1, WINDOW - ANCHOR_WORDS + 1
    while reach < span:  # leftmost least gram of each window, by doubling
        step = min(reach, span - reach)
        right = least[step:] < least[:-step]
        at, least = np.where(right, at[step:], at[:-step]), np.where(right, least[step:], least[:-step])
        reach += step
    whole = owner[:windows] == owner[WINDOW - 1 :]
    first = whole.copy()
    first[1:] &= ~(whole[:-1] & (at[1:windows] == at[: windows - 1]))
    start = np.flatnonzero(first)
    stops = np.append(np.flatnonzero(first | ~whole), windows)
    count = stops[np.searchsorted(stops, start, side="right")] - start
    return owner[start], start - spelled.starts[owner[start]], count, grams[at[start]], spelled.run_hash(start, count + WINDOW - 1)


class FMIndex:
    """Backward search over numbered words: a wavelet tree (as a matrix of levels) of the Burrows-Wheeler transform.

    Levels are bit vectors of 64-bit words with the set bits before each word.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        rank, step = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
        while True:  # suffix ranks by doubling
            follow = np.zeros(n, np.int64)
            follow[:-step] = rank[step:] + 1
            key = rank * (n + 2) + follow
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], (key[order][1:] != key[order][:-1]).astype(np.int64)]))
            step *= 2
            if rank[order[-1]] == n - 1 or step > n:
                break
        self.n = n
        levels = max(1, int(words.max()).bit_length())
        row = words[order - 1]  # the word before each suffix
        counts = np.bincount(words, minlength=1 << levels if levels < 8 else int(words.max()) + 1)
        place = np.zeros(len(counts), np.int64)
        self.levels = []
        numbers = np.arange(len(counts))
        for bit in range(levels - 1, -1, -1):
            bits = (row >> bit) & 1 == 1
            packed = np.packbits(np.concatenate([bits, np.zeros(-(n + 1) % 64 + 1, bool)]), bitorder="little").view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            zeros = n - int(bits.sum())
            level = (bit, packed, before, zeros)
            self.levels.append(level)
            place = self._down(level, place, numbers)
            row = np.concatenate([row[~bits], row[bits]])
        self.first = np.cumsum(counts) - counts - place

    @staticmethod
    def _down(level, at: np.ndarray, words: np.ndarray) -> np.ndarray:
        bit, packed, before, zeros = level
        block = at >> 6
        ones = before[block] + np.bitwise_count(packed[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
        return np.where((words >> bit) & 1 == 1, zeros + ones, at - ones)

    def extend(self, low: np.ndarray, high: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with one more word in front."""
        at, both = np.concatenate([low, high]), np.concatenate([words, words])
        for level in self.levels:
            at = self._down(level, at, both)
        at = at + self.first[both]
        return at[: len(low)], at[len(low) :]


def repeated_windows(sequences: list[np.ndarray], asked: np.ndarray) -> list[np.ndarray]:
    """For each asked sequence, which of its windows occur twice or more among all sequences.

    Open windows of a sequence are a range. The search from the end of the first one either
    matches it whole, or breaks at a word; every window that holds the broken match is then
    single. After a match the search from the end of the last open window settles all windows
    behind the word it breaks at. Sequences are searched side by side.
    """
    sizes = np.array([len(s) for s in sequences])
    joined = np.full(int(sizes.sum()) + len(sizes), np.uint64(0))
    starts = np.cumsum(sizes + 1) - sizes - 1
    inside = np.ones(len(joined), bool)
    inside[starts + sizes] = False
    joined[inside] = np.concatenate(sequences)
    words = np.zeros(len(joined), np.int64)
    words[inside] = np.unique(joined[inside], return_inverse=True)[1] + 1  # 0 ends a sequence
    index = FMIndex(words)
    lanes = np.flatnonzero(asked)
    first = starts[lanes].copy()  # open windows: from first to last
    last = first + sizes[lanes] - WINDOW
    repeated = np.zeros(len(joined) + 1, np.int64)  # differences of a cover
    target, end, whole = first.copy(), first + WINDOW - 1, np.zeros(len(lanes), bool)  # whole: searching from the last window
    at, low, high = end.copy(), np.zeros(len(lanes), np.int64), np.full(len(lanes), index.n)
    live = np.arange(len(lanes))
    while len(live):
        low[live], high[live] = index.extend(low[live], high[live], words[at[live]])
        broke = high[live] - low[live] < 2
        reached = ~broke & (at[live] == target[live])
        on = live[~broke & ~reached]
        at[on] -= 1
        done = live[reached]
        np.add.at(repeated, target[done], 1)  # all windows from target to the searched end
        np.add.at(repeated, end[done] - WINDOW + 2, -1)
        first[done] = end[done] - WINDOW + 2
        cut = live[broke]
        a = cut[~whole[cut]]
        first[a] = at[a] + 1
        b = cut[whole[cut]]
        behind = b[at[b] < last[b]]
        np.add.at(repeated, at[behind] + 1, 1)
        np.add.at(repeated, last[behind] + 1, -1)
        last[b] = np.minimum(at[b], last[b] - 1)
        again = live[broke | reached]
        whole[again] = False
        whole[done] = True
        left = again[first[again] <= last[again]]
        target[left] = first[left]
        end[left] = np.where(whole[left], last[left], first[left]) + WINDOW - 1
        at[left], low[left], high[left] = end[left], 0, index.n
        live = np.concatenate([on, left])
    cover = np.cumsum(repeated) > 0
    return [cover[starts[i] : starts[i] + sizes[i] - WINDOW + 1] for i in lanes]


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("string").alias("text"))
    return rows.withColumn("text_hash", F.xxhash64("text"))


def _joined(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    found = found.withColumnsRenamed({"doc_id": "f_id", "text_hash": "f_hash"})
    return rows.join(found, rows["doc_id"].eqNullSafe(found["f_id"]) & (rows["text_hash"] == found["f_hash"]), how).drop("f_id", "f_hash")


def _anchors(batches) -> Iterator[pa.RecordBatch]:
    for _, texts in pieces(batches):
        yield pa.RecordBatch.from_arrays([pa.array(stretches(Spelling(texts))[3].view(np.int64))], ["anchor"])


def _stretch_rows(batches) -> Iterator[pa.RecordBatch]:
    for part, texts in pieces(batches):
        owner, start, count, anchor, content = stretches(Spelling(texts))
        of = pa.array(owner)
        arrays = [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), part.column("doc_id").take(of), part.column("text_hash").take(of)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))], ["anchor", "content", "doc_id", "text_hash", "start", "count"])


def _hot_windows(batches) -> Iterator[pa.RecordBatch]:
    """Hash and place of every window of the wanted stretches, without words."""
    names = ["anchor", "window", "content", "first", "asked", "doc_id", "text_hash", "at"]
    for part, texts in pieces(batches):
        spelled = Spelling(texts)
        wanted = [(i, w) for i, ws in enumerate(part.column("wanted").to_pylist()) for w in ws]
        for lo in range(0, len(wanted), 2000):
            some = wanted[lo : lo + 2000]
            count = np.array([w["count"] for _, w in some], np.int64)
            of = np.repeat(np.arange(len(some)), count)
            first = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            owner, start, anchor, content = (np.array(x, np.int64)[of] for x in zip(*((i, w["start"], w["anchor"], w["content"]) for i, w in some), strict=True))
            at = start + first
            window = spelled.run_hash(spelled.starts[owner] + at, np.full(len(at), WINDOW)).view(np.int64)
            asked = np.array([w["asked"] for _, w in some], bool)[of]
            arrays = [*(pa.array(x) for x in (anchor, window, content, first, asked)), part.column("doc_id").take(pa.array(owner)), part.column("text_hash").take(pa.array(owner)), pa.array(at.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names)


def _spell_out(batches) -> Iterator[pa.RecordBatch]:
    """The words of wanted stretches and windows."""
    names = ["route", "anchor", "content", "first", "asked", "hot", "words"]
    for part, texts in pieces(batches):
        out = []
        spelled = Spelling(texts)
        for i, wanted in enumerate(part.column("wanted").to_pylist()):
            base = int(spelled.starts[i])
            for w in wanted:
                lo = base + w["start"]
                out.append((w["route"], w["anchor"], w["content"], w["first"], w["asked"], w["hot"], spelled.hashes[lo : lo + w["count"] + WINDOW - 1].tobytes()))
                if len(out) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names)


def _search(batches) -> Iterator[pa.RecordBatch]:
    """Sorted rows of shards: index each shard and stream its own stretches through it."""

    def answer(rows: list[tuple]) -> pa.RecordBatch:
        sequences = [np.frombuffer(r[3], np.uint64) for r in rows]
        asked = np.array([r[4] for r in rows])
        found = repeated_windows(sequences, asked) if asked.any() else []
        masks = [sum(1 << (r[2] + int(k)) for k in np.flatnonzero(hits)) for r, hits in zip([r for r in rows if r[4]], found, strict=True)]
        keep = [(r[0], r[1], m, r[5]) for r, m in zip([r for r in rows if r[4]], masks, strict=True) if m]
        columns = list(zip(*keep, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.bool_())], ["anchor", "content", "mask", "hot"])

    shard, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "anchor", "content", "first", "words", "asked", "hot")), strict=True):
            if row[0] != shard and held:
                yield answer(held)
                held = []
            shard = row[0]
            if not held or held[-1][:3] != row[1:4]:  # a repeated row is spelled twice
                held.append(row[1:])
    if held:
        yield answer(held)


def _window_pairs(rows: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All windows of wanted stretches, and two places of each window that has two: what goes on does not grow with the places."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    listed = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("anchor", "content", "start", "count", "asked")).alias("wanted"))
    windows = _joined(rows, listed, "inner").select("doc_id", "text_hash", "text", "wanted")
    windows = written(windows.mapInArrow(_hot_windows, f"anchor long, window long, content long, first long, asked boolean, doc_id {kind}, text_hash long, at int"), "windows")
    place = F.struct("content", "first", "doc_id", "text_hash", "at")
    pairs = windows.groupBy("anchor", "window").agg(F.min(place).alias("one"), F.max(place).alias("other"))
    return windows, written(pairs.filter("one.content != other.content or one.first != other.first"), "pairs")


def _both_places(pairs: DataFrame) -> DataFrame:
    """Rows that spell both places of a window, the first to be answered under the window's hash."""
    places = F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("first"), F.col(c).alias("place")) for i, c in enumerate(("one", "other")))))
    each = pairs.select("anchor", "window", places.alias("p"))
    asked = F.struct(
        F.col("window").alias("route"), "anchor", F.col("window").alias("content"), F.col("p.first").alias("first"), F.col("p.place.at").alias("start"), F.lit(1).alias("count"),
        (F.col("p.first") == 0).alias("asked"), F.lit(True).alias("hot"),
    )
    return each.select("p.place.doc_id", "p.place.text_hash", asked.alias("wanted"))


def repeated_stretches(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` and ``found`` (start, mask of repeated windows from there) of every text with a repeat."""
    rows = _keyed(docs, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    anchors = rows.select("text").mapInArrow(_anchors, "anchor long")
    anchors = written(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "anchors")
    every = rows.mapInArrow(_stretch_rows, f"anchor long, content long, doc_id {kind}, text_hash long, start int, count int")
    every = written(every.join(anchors, "anchor"), "stretches")
    groups = every.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_hash", "start", "count")).alias("rep"))
    groups = written(groups, "groups")
    several = groups.groupBy("anchor").agg(F.count("*").alias("different"), F.sum(F.col("rep.count") + WINDOW - 1).alias("words")).filter("different > 1")
    several = written(several, "several")
    several = several.withColumn("hot", F.col("different") > HOT_STRETCHES)
    known = {r["hot"]: r["words"] for r in several.groupBy("hot").agg(F.sum("words").alias("words")).collect()}
    words = known.get(False) or 0
    wanted = groups.join(several, "anchor").select("rep.doc_id", "rep.text_hash", "anchor", "content", "rep.start", "rep.count", (F.col("n") == 1).alias("asked"), "hot")
    whole = F.struct(F.col("anchor").alias("route"), "anchor", "content", F.lit(0).cast("long").alias("first"), "start", "count", "asked", "hot")
    sent = wanted.filter(~F.col("hot")).select("doc_id", "text_hash", whole.alias("wanted"))
    if True in known:
        windows, pairs = _window_pairs(rows, wanted.filter("hot"))
        words += 2 * WINDOW * pairs.count()
        sent = sent.unionAll(_both_places(pairs))
    shards = max(1, -(-words // SHARD_WORDS))
    sent = sent.groupBy("doc_id", "text_hash").agg(F.collect_list("wanted").alias("wanted"))
    spelled = _joined(rows, sent, "inner").select("text", "wanted").mapInArrow(_spell_out, "route long, anchor long, content long, first long, asked boolean, hot boolean, words binary")
    spelled = spelled.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
    found = spelled.repartition("shard").sortWithinPartitions("shard", "anchor", "content", "first").mapInArrow(_search, "anchor long, content long, mask long, hot boolean")
    if True in known:
        found = written(found, "found")
        twice = found.filter("hot").select("anchor", F.col("content").alias("window"))
        others = windows.filter("asked").join(twice, ["anchor", "window"]).select("anchor", "content", F.expr("shiftleft(1L, cast(first as int))").alias("mask"))
        found = found.filter("not hot").drop("hot").unionAll(others)
    else:
        found = found.drop("hot")
    copies = groups.filter("n > 1").select("anchor", "content", F.expr("shiftleft(1L, rep.count) - 1").alias("mask"))
    masks = written(found.unionAll(copies).groupBy("anchor", "content").agg(F.bit_or("mask").alias("mask")), "masks")
    hits = every.join(masks, ["anchor", "content"]).select("doc_id", "text_hash", F.struct("start", "mask").alias("hit"))
    return hits.groupBy("doc_id", "text_hash").agg(F.collect_set("hit").alias("found"))


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_text: bool = True) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept_text``.

    A word goes if any window over it starts anywhere else in the corpus, also in the same
    text; windows are judged on the input. Kept words are joined by a space. Null and empty
    texts and texts of fewer than 35 words lose nothing; a repeated row repeats every window
    of its text; further columns are not read.
    """
    from hashlib import sha256

    rows = _keyed(docs, id_column, text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    both = _joined(rows, repeated_stretches(docs, id_column, text_column), "left").select("doc_id", "text", "found")

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            n_words, n_removed, kept = [], [], []
            for text, found in zip(texts, part.column("found").to_pylist(), strict=True):
                words = text.split()
                edges = np.zeros(len(words) + 1, np.int64)
                for hit in found or ():
                    for k in range(hit["mask"].bit_length()):
                        if hit["mask"] >> k & 1:
                            edges[hit["start"] + k] += 1
                            edges[hit["start"] + k + WINDOW] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone, strict=True) if not g) if gone.any() else b" ".join(words))
            arrays = [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([sha256(x).hexdigest() for x in kept])]
            texts_out = pa.array([x.decode() if with_text else None for x in kept], pa.string())
            yield pa.RecordBatch.from_arrays([*arrays, texts_out], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    out = both.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out if with_text else out.drop("kept_text")
