"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and word beginnings that mark toxic texts is learned from counts over a
bounded sample of labelled texts. Features of a text are densities of the lexicon's hits, how near they stand to
a second person, and rates of capitals, punctuation and obfuscation. Trees are boosted on a
bounded sample; every sampled text is described by the lexicon of the other folds and scored
by the trees of the other folds, and those scores are calibrated to shares by isotonic
regression. Lexicon, trees and steps are broadcast; scoring is one scan without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, id_and_text
from tidemark.session import written

#: Labelled rows of each label that a model is fitted on, at most about: the lexicon counts all
#: of them, trees and calibration take at most about so many of their texts of each label.
LABELLED_ROWS, SAMPLE_TEXTS = 20_000, 12_000
#: Entries of the lexicon at most, toxic texts an entry occurs in at least, log odds it has at least.
LEXICON, LEAST_TEXTS, LEAST_ODDS = 5_000, 3, 2.0
#: Letters of the word beginnings that are counted besides whole words.
STEMS = (3, 4, 5, 6)
FOLDS = 3
DECIDE = 0.3
#: Words around a hit in which a second person counts.
NEAR = 6
FEATURES = (
    "lexicon", "strongest", "hits", "different", "stems", "second_person", "near_second_person", "capitals", "capital_words", "exclamations",
    "questions", "punctuation", "symbols", "obfuscated", "obfuscated_hits", "stretched", "words", "letters_per_word",
)
# Second persons of English, German, French and Spanish, and signs that stand for letters.
SECOND_PERSON = frozenset("you your yours yourself u ur ya du dich dir dein deine deiner deinem deinen euch euer tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
_LETTERS = str.maketrans("013457@$!", "oieastasi")

_SIGNS = "#*$%&|<>@^~"
#: Characters of text described at once, about, and tokens a worker remembers.
PART, REMEMBERED = 1 << 20, 300_000
_TOKEN = re.compile(r"[^\W_](?:[\w@$!*#'’+.-]*[\w])?", re.UNICODE)
_STRETCH = re.compile(r"(.)\1{2,}")
_INNER = re.compile(r"[^\W\d_][\d@$!*#+.\-_]+[^\W\d_]|[^\W\d_][@$!*#0-9]+$")


def held_out(key: Column) -> Column:
    """Whether a document is set aside for measuring: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def plain(token: str) -> str:
    """A token as it would be read: signs as the letters they stand for, stretches as one letter, nothing between letters."""
    out = token.translate(_LETTERS)
    return _STRETCH.sub(r"\1", "".join(c for c in out if c.isalpha()))


def forms(token: str) -> set[str]:
    """What the lexicon counts of a lower-case token: itself, how it reads, beginnings of that (they end in ``*``)."""
    w = token if token.isalpha() else plain(token)
    return {token, w, *(w[:k] + "*" for k in STEMS if len(w) > k)} - {""}


class Tokens:
    """Numbered tokens of texts, with a row of numbers for each; forgotten when there are too many."""

    def __init__(self, width: int, fact, fold: bool = False):
        self.width, self.fact, self.fold = width, fact, fold
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.facts = np.zeros((1 << 12, self.width))

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of every token, and how many tokens each text has."""
        out, sizes = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            for part in _parts(text):
                tokens = _TOKEN.findall(part.lower() if self.fold else part)
                new = list(set(tokens).difference(self.known))
                if new:
                    lo = len(self.known)
                    self.known.update(zip(new, range(lo, lo + len(new)), strict=True))
                    while len(self.facts) < len(self.known):
                        self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
                    self.facts[lo : lo + len(new)] = [self.fact(t) for t in new]
                out.append(np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens)))
                sizes[i] += len(tokens)
        return np.concatenate(out), sizes


class FormCounter:
    """In how many texts of each cell (twice the fold, plus the label) every form occurs."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.forms: dict[str, int] = {}
        self.tokens = Tokens(2 + len(STEMS), self._row, fold=True)
        self.counts = np.zeros((1 << 12, 2 * FOLDS), np.int64)

    def _row(self, token: str) -> list[int]:
        row = [self.forms.setdefault(f, len(self.forms)) for f in forms(token)]
        return row + [-1] * (2 + len(STEMS) - len(row))

    def add(self, texts: list[str], cells: np.ndarray) -> None:
        at, sizes = self.tokens.of(texts)
        owner = np.repeat(np.arange(len(texts)), sizes)
        owner, token = np.divmod(np.unique(owner * (len(self.tokens.known) + 1) + at), len(self.tokens.known) + 1)
        form = self.tokens.facts[token].astype(np.int64)
        pairs = np.unique((owner[:, None] * (len(self.forms) + 1) + form)[form >= 0])
        owner, form = np.divmod(pairs, len(self.forms) + 1)
        while len(self.counts) < len(self.forms):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        np.add.at(self.counts, (form, cells[owner]), 1)

    def rows(self) -> pa.RecordBatch:
        names = list(self.forms)
        form, cell = np.nonzero(self.counts[: len(names)])
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(form)), pa.array(cell.astype(np.int32)), pa.array(self.counts[form, cell])], ["entry", "cell", "n"])


def _parts(text: str) -> Iterator[str]:
    """A text in parts of bounded length, cut at spaces."""
    at = 0
    while len(text) - at > PART:
        cut = text.rfind(" ", at, at + PART)
        cut = cut if cut > at else text.find(" ", at + PART)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """For every code point what it is: bits for letter, capital, mark, sign, exclamation and question mark."""
    out = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        letter = c.isalpha()
        out[i] = letter + 2 * c.isupper() + 4 * (not letter and not c.isspace() and not c.isdigit())
    for c in _SIGNS:
        out[ord(c)] |= 8
    out[ord("!")] |= 16
    out[ord("?")] |= 32
    return out


class Describer:
    """Features of texts under a lexicon; what it finds out about a token it remembers, up to a bound."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.keys = {e: i for i, e in enumerate(lexicon)}
        self.tokens = Tokens(7, self._fact)

    def _fact(self, token: str) -> tuple[float, ...]:
        """Weight, place in the lexicon, found by its beginning, second person, all capitals, obfuscated, stretched."""
        t = token.lower()
        bare = t.isalpha()
        w = t if bare else plain(t)
        known = self.lexicon.get
        weight, key, stem = known(t, 0.0), t, False
        if not bare and known(w, 0.0) > weight:
            weight, key = known(w, 0.0), w
        if not weight:
            for k in STEMS:
                if len(w) > k and known(w[:k] + "*", 0.0) > weight:
                    key = w[:k] + "*"
                    weight, stem = known(key, 0.0), True
        hidden = not bare and _INNER.search(t) is not None
        return (weight, self.keys.get(key, -1), stem, t in SECOND_PERSON, len(token) > 1 and token.isupper(), hidden, bare and _STRETCH.search(t) is not None)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """One row of ``FEATURES`` per text."""
        out = [np.zeros((0, len(FEATURES)))]
        some = [t or "" for t in texts]
        for lo, hi in chunks(some, PART):
            if len(self.tokens.known) > REMEMBERED:
                self.tokens.forget()
            out.append(self._rows(some[lo:hi]))
        return np.concatenate(out)

    def _rows(self, texts: list[str]) -> np.ndarray:
        n = len(texts)
        at, size = self.tokens.of(texts)
        owner = np.repeat(np.arange(n), size)
        weight, key, stem, second, capital, hidden, stretched = self.tokens.facts[at].T
        total = lambda x, of=owner: np.bincount(of, x, n)
        place = np.arange(len(at)) + owner * (NEAR + 1)  # texts apart
        hit = weight > 0
        persons = np.concatenate([[-NEAR - 1], place[second > 0], [len(at) + (n + 1) * (NEAR + 1)]])
        after = np.searchsorted(persons, place[hit])
        near = np.minimum(persons[after] - place[hit], place[hit] - persons[after - 1]) <= NEAR
        strongest = np.zeros(n)
        np.maximum.at(strongest, owner[hit], weight[hit])
        different = np.unique(owner[hit] * (len(self.keys) + 1) + key[hit].astype(np.int64)) // (len(self.keys) + 1)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = _kinds()[codes]
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]

        def held(bit: int) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(kinds & bit > 0)])
            return (sums[ends] - sums[starts]).astype(float)

        words, length, letters = np.maximum(size, 1), np.maximum(ends - starts, 1), held(1)
        return np.stack([
            total(weight) / words, strongest, total(hit) / words, np.bincount(different, minlength=n).astype(float), total(stem) / words, total(second) / words,
            np.bincount(owner[hit][near], minlength=n) / words, held(2) / np.maximum(letters, 1), total(capital) / words, held(16) / words, held(32) / words, held(4) / length,
            held(8) / length, total(hidden) / words, total(hidden * hit) / words, total(stretched) / words, np.log1p(size), letters / words,
        ], axis=1)


class Tree(NamedTuple):
    """A tree of fixed depth in breadth-first order; a node without a split sends everything left."""

    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(len(self.leaf).bit_length() - 1):
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.limit[node])
        return self.leaf[node - len(self.feature)]


def _tree(binned: np.ndarray, limits: list[np.ndarray], gradient: np.ndarray, curve: np.ndarray, depth: int, prior: float, least: float) -> Tree:
    """Newton steps: the split that lowers the loss most, node by node, from sums over bins."""
    n, width = binned.shape
    bins = max(len(x) for x in limits) + 1
    feature, limit = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
    node = np.zeros(n, np.int64)
    for level in range(depth):
        first, count = 2**level - 1, 2**level
        gain = np.zeros(count)
        for f in range(width):
            at = (node - first) * bins + binned[:, f]
            g = np.bincount(at, gradient, count * bins).reshape(count, bins)
            h = np.bincount(at, curve, count * bins).reshape(count, bins)
            left_g, left_h = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
            all_g, all_h = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
            better = left_g**2 / (left_h + prior) + (all_g - left_g) ** 2 / (all_h - left_h + prior) - all_g**2 / (all_h + prior)
            better = np.where((left_h >= least) & (all_h - left_h >= least), better, 0.0)[:, : len(limits[f])]
            if better.shape[1]:
                best = better.argmax(1)
                value = better[np.arange(count), best]
                new = value > gain + 1e-12
                gain = np.where(new, value, gain)
                feature[first + np.flatnonzero(new)] = f
                limit[first + np.flatnonzero(new)] = limits[f][best[new]]
        cut = np.array([np.searchsorted(limits[f], x) if np.isfinite(x) else bins for f, x in zip(feature[first : first + count], limit[first : first + count])])
        node = 2 * node + 1 + (binned[np.arange(n), feature[node]] > cut[node - first])
    node -= 2**depth - 1
    g, h = np.bincount(node, gradient, 2**depth), np.bincount(node, curve, 2**depth)
    return Tree(feature, limit, -g / (h + prior))


class Trees(NamedTuple):
    start: float
    rate: float
    trees: list[Tree]

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += self.rate * t.scores(x)
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, prior: float = 1.0, least: float = 0.5) -> Trees:
    """Trees boosted on the log loss of weighted rows; features are cut at quantiles."""
    limits = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    limits = [q[q < c.max()] if len(c) else q for q, c in zip(limits, x.T)]
    binned = np.stack([np.searchsorted(q, c) for q, c in zip(limits, x.T)], axis=1)
    share = (y @ weight + 0.5) / (weight.sum() + 1)
    start = float(np.log(share / (1 - share)))
    margin, trees = np.full(len(x), start), []
    for _ in range(rounds if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        tree = _tree(binned, limits, weight * (p - y), weight * p * (1 - p), depth, prior, least)
        trees.append(tree)
        margin += rate * tree.scores(x)
    return Trees(start, rate, trees)


class Steps(NamedTuple):
    """A rising function through points, straight in between, level outside."""

    at: np.ndarray
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.interp(x, self.at, self.value)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Steps:
    """The rising steps nearest to ``y`` (pool adjacent violators); rows of one ``x`` are one."""
    if not len(x):
        return Steps(np.zeros(1), np.zeros(1))
    at, of = np.unique(x, return_inverse=True)
    w = np.bincount(of, weight)
    mean = np.bincount(of, weight * y) / w
    pools: list[list[float]] = []  # mean, weight, first and last place
    for i, (m, size) in enumerate(zip(mean.tolist(), w.tolist(), strict=True)):
        pools.append([m, size, i, i])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m2, s2, _, last = pools.pop()
            m1, s1, first, _ = pools.pop()
            pools.append([(m1 * s1 + m2 * s2) / (s1 + s2), s1 + s2, first, last])
    ends = np.array([[p[2], p[3]] for p in pools], np.int64).ravel()
    return Steps(at[ends], np.repeat([p[0] for p in pools], 2))


class Model(NamedTuple):
    lexicon: dict[str, float]
    trees: Trees
    steps: Steps

    def scores(self, described: np.ndarray) -> np.ndarray:
        return np.clip(self.steps(self.trees.margins(described)), 0.0, 1.0)


def _weights(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log odds of entries from texts with them (clean, toxic), 0 where too few or too weak.

    One text is added to each side; the evidence counts by its lower end, one deviation below.
    """
    clean, toxic = counts.T + 0.5
    odds = np.log(toxic / (sizes[1] + 1)) - np.log(clean / (sizes[0] + 1))
    odds -= np.sqrt(1 / toxic + 1 / clean) * 0.5
    return np.where((counts[:, 1] >= LEAST_TEXTS) & (odds >= LEAST_ODDS), odds, 0.0)


def _lexicon(words: list[str], counts: np.ndarray, sizes: np.ndarray) -> dict[str, float]:
    weights = _weights(counts, sizes)
    best = sorted(np.flatnonzero(weights), key=lambda i: (-counts[i, 1] * weights[i], words[i]))[:LEXICON]
    return {words[i]: float(weights[i]) for i in best}


def labelled_texts(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, tuple[float, float]]:
    """Different texts of a sample of the labels, stored: ``text``, ``hash``, ``toxic``, ``fold``; and the share of each label drawn.

    Labels are drawn by a hash of their id; the ids of about ``2 * LABELLED_ROWS`` at most are
    broadcast, so only their texts move. Labels other than 0 and 1 are not read; a text with
    several labels has that of most, toxic in a tie. Copies share their hash and with it their
    fold.
    """
    rows = id_and_text(docs, id_column, text_column).filter("text is not null")
    marks = labels.select(labels["doc_id"].alias("marked_id"), labels["toxic"].cast("int").alias("toxic")).filter("marked_id is not null and toxic in (0, 1)")
    counts = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    shares = tuple(min(1.0, LABELLED_ROWS / counts.get(y, 1)) for y in (0, 1))
    drawn = marks.filter(F.pmod(F.xxhash64("marked_id", F.lit(2)), F.lit(1 << 30)) < F.when(F.col("toxic") == 1, int(shares[1] * (1 << 30))).otherwise(int(shares[0] * (1 << 30))))
    both = rows.join(F.broadcast(drawn), rows["doc_id"] == drawn["marked_id"]).withColumn("hash", F.xxhash64("text"))
    texts = both.groupBy("hash").agg(F.first("text").alias("text"), F.avg("toxic").alias("share"))
    fold = F.pmod(F.xxhash64("hash"), F.lit(FOLDS)).cast("int")
    return written(texts.select("text", "hash", (F.col("share") >= 0.5).cast("int").alias("toxic"), fold.alias("fold")), "labelled"), shares


def _entry_counts(texts: DataFrame) -> DataFrame:
    """``entry``, ``cell`` (twice the fold, plus the label), ``n`` texts that hold it, for entries of toxic texts."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        counter = FormCounter()
        for batch in batches:
            some = batch.column("text").to_pylist()
            cells = 2 * batch.column("fold").to_numpy().astype(np.int64) + batch.column("toxic").to_numpy()
            for lo, hi in chunks(some, PART):
                counter.add(some[lo:hi], cells[lo:hi])
                if len(counter.forms) > REMEMBERED:
                    yield counter.rows()
                    counter.forget()
        yield counter.rows()

    return texts.select("text", "toxic", "fold").mapInArrow(run, "entry string, cell int, n long").groupBy("entry", "cell").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """The model of the labelled rows of ``docs``; without both labels every score is the share of toxic ones.

    The driver gets at most ``2 * LEXICON`` entries, and features of about ``2 * SAMPLE_TEXTS``
    sampled texts. Trees and steps weigh a text by how many labels it stands for.
    """
    texts, part = labelled_texts(docs, labels, id_column, text_column)
    sizes = np.zeros((FOLDS, 2), np.int64)
    for r in texts.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect():
        sizes[r["fold"], r["toxic"]] = r["n"]
    clean, toxic = sizes.sum(axis=0).tolist()
    cell = lambda label: F.coalesce(F.sum(F.when(F.col("cell") % 2 == label, F.col("n"))), F.lit(0))
    counts = _entry_counts(texts).groupBy("entry").agg(cell(0).alias("clean"), cell(1).alias("toxic"), F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("cells"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    # an entry that passes without one fold has nearly these odds in all
    likely = counts.filter((F.col("toxic") >= LEAST_TEXTS) & (odds >= LEAST_ODDS - 1)).orderBy((-F.col("toxic") * odds), "entry").limit(2 * LEXICON).collect()
    words = [r["entry"] for r in likely]
    by_fold = np.array([[[r["cells"].get(2 * k + y, 0) for y in (0, 1)] for k in range(FOLDS)] for r in likely], np.int64).reshape(-1, FOLDS, 2)
    lexicon = _lexicon(words, by_fold.sum(axis=1), sizes.sum(axis=0))
    others = [_lexicon(words, by_fold.sum(axis=1) - by_fold[:, k], sizes.sum(axis=0) - sizes[k]) for k in range(FOLDS)]
    shared = docs.sparkSession.sparkContext.broadcast(others)
    shares = [min(1.0, SAMPLE_TEXTS / max(1, n)) for n in (clean, toxic)]
    drawn = F.pmod(F.xxhash64("hash", F.lit(1)), F.lit(1 << 30)) < F.when(F.col("toxic") == 1, int(shares[1] * (1 << 30))).otherwise(int(shares[0] * (1 << 30)))

    def described(batches) -> Iterator[pa.RecordBatch]:
        by_fold = [Describer(x) for x in shared.value]
        for batch in batches:
            fold = batch.column("fold").to_numpy()
            for k in range(FOLDS):
                some = batch.filter(pa.array(fold == k))
                x = by_fold[k](some.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([some.column("hash"), some.column("toxic"), some.column("fold"), pa.array(list(x), pa.list_(pa.float64()))], ["hash", "toxic", "fold", "x"])

    sample = texts.filter(drawn).mapInArrow(described, "hash long, toxic int, fold int, x array<double>").collect()
    sample.sort(key=lambda r: r["hash"])
    x = np.array([r["x"] for r in sample], float).reshape(-1, len(FEATURES))
    y, fold = (np.array([r[c] for r in sample], float) for c in ("toxic", "fold"))
    weight = np.where(y == 1, 1 / (shares[1] * part[1]), 1 / (shares[0] * part[0]))
    margin = np.zeros(len(x))
    for k in range(FOLDS):
        here = fold == k
        margin[here] = boost(x[~here], y[~here], weight[~here]).margins(x[here])
    return Model(lexicon, boost(x, y, weight), isotonic(margin, y, weight))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", decide: float = DECIDE) -> DataFrame:
    """One row per input row: ``doc_id``, ``score`` (share of such texts that are toxic), ``predicted``.

    Null texts are scored as empty ones, which have no hits; whole texts are read; repeated
    rows give repeated results, ties equal ones; further columns are not read; an empty table
    gives an empty result. No shuffle.
    """
    source = id_and_text(docs, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator[pa.RecordBatch]:
        describe = Describer(shared.value.lexicon)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = shared.value.scores(describe(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found), pa.array((found >= decide).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, score double, predicted int")
