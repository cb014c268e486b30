"""Language identification by cross-parsing entropy.

A suffix automaton of each language's sample accepts every substring of it. A text is parsed
greedily into the longest phrases an automaton accepts; the fewer phrases, weighed by the
bits that point into the sample, the closer the language. Texts are cut into segments that
are parsed side by side, so one numpy step moves thousands of parses by one letter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, id_and_text

#: Bounds of the labelled sample: letters per language, and over all languages together;
#: texts per language, and characters of a text that may serve as a sample.
SAMPLE_LETTERS, ALL_LETTERS, SAMPLE_TEXTS, SAMPLE_TEXT_CHARS = 40_000, 1_000_000, 200, 20_000
SEGMENT = 2048
CHUNK = 4 << 20
UNDETERMINED = "und"
_GAP, _OTHER = 0, 1  # classes of everything but letters, and of letters no sample has


def plain(text: str) -> str:
    """Lower-case letters, each run of anything else one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the smallest automaton of all suffixes (Blumer et al. 1985); 0 is the root."""
    moves, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new, p = len(moves), last
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


class Parser:
    """Automata of all languages in one table of moves by (state, letter class).

    A missing move holds the complement of the state that the next phrase starts with.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        letters = sorted(set("".join(samples.values())) - {" "})
        self.classes = {" ": _GAP} | {c: i + 2 for i, c in enumerate(letters)}
        self.width = len(letters) + 2
        self.bits = np.array([math.log2(len(samples[x]) + 2) for x in self.languages])
        tables, roots, base = [], [], 0
        for language in self.languages:
            moves = suffix_automaton(samples[language])
            table = np.full((len(moves), self.width), -1, np.int32)
            for state, row in enumerate(moves):
                for c, to in row.items():
                    table[state, self.classes[c]] = to + base
            first = np.where(table[0] < 0, base, table[0])
            table = np.where(table < 0, ~first, table).astype(np.int32)
            table[0] = ~first  # whatever is read at the root begins a phrase
            tables.append(table)
            roots.append(base)
            base += len(moves)
        self.moves = np.concatenate([t.ravel() for t in tables]) if tables else np.zeros(0, np.int32)
        self.roots = np.array(roots, np.int32)

    def letter_classes(self) -> np.ndarray:
        """Class of every code point, upper case as lower case."""
        known = np.fromiter((_OTHER if chr(i).isalpha() else _GAP for i in range(0x110000)), np.uint16, 0x110000)
        for c, k in self.classes.items():
            known[ord(c)] = k
            if len(c.upper()) == 1:
                known[ord(c.upper())] = k
        return known

    def phrases(self, texts: list[str], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text in each language; letters of each text."""
        sizes = np.array([len(t) for t in texts])
        classes = known[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        owner = np.repeat(np.arange(len(texts)), sizes)
        letters = np.bincount(owner[classes != _GAP], minlength=len(texts))
        keep = classes != _GAP  # a gap stays only right after a letter of the same text
        keep[1:] |= (classes[:-1] != _GAP) & (owner[1:] == owner[:-1])
        classes, owner = classes[keep], owner[keep]
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        if not len(classes):
            return out, letters
        sizes = np.bincount(owner, minlength=len(texts))
        starts = np.cumsum(sizes) - sizes
        cuts = [(d, s, min(SEGMENT, starts[d] + sizes[d] - s)) for d in np.flatnonzero(sizes) for s in range(starts[d], starts[d] + sizes[d], SEGMENT)]
        of, start, length = (np.array(x) for x in zip(*sorted(cuts, key=lambda x: -x[2]), strict=True))
        active = np.searchsorted(-length, -np.arange(length[0]), side="left")  # segments longer than each step
        state = np.tile(self.roots, (len(of), 1))
        count = np.zeros_like(state)
        for step in range(length[0]):
            n = active[step]
            to = self.moves.take(state[:n] * self.width + classes[start[:n] + step][:, None])
            missed = to >> 31
            count[:n] -= missed
            state[:n] = to ^ missed
        np.add.at(out, of, count)
        return out, letters


def sample_texts(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, str]:
    """A bounded labelled sample of each language, drawn by a hash of the text.

    Different texts of a language, each once, pass a hash threshold set from their count; the
    driver gets about ``2 * SAMPLE_TEXTS`` short texts of each. A language that has only longer
    texts is drawn from their pieces of ``SAMPLE_TEXT_CHARS`` from the first letter on. Copies
    are told by a 64-bit hash.
    """
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(text).alias("hash"), (F.length(text) > SAMPLE_TEXT_CHARS).alias("long"))
    counts: dict[str, dict[bool, int]] = {}
    for r in rows.select("lang", "long", "hash").distinct().groupBy("lang", "long").agg(F.count("*").alias("n")).collect():
        counts.setdefault(r["lang"], {})[r["long"]] = r["n"]
    if not counts:
        return {}
    share = F.lit(0)
    for language, n in sorted(counts.items()):
        only_long = False not in n
        share = F.when((F.col("lang") == language) & (F.col("long") == only_long), int(min(1.0, 2 * SAMPLE_TEXTS / n[only_long]) * (1 << 30))).otherwise(share)
    piece = F.when(F.col("long"), F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{SAMPLE_TEXT_CHARS - 1}}}", 0)).otherwise(F.col("text"))
    drawn = rows.withColumn("draw", F.pmod("hash", F.lit(1 << 30))).filter(F.col("draw") < share)
    drawn = drawn.groupBy("lang", "hash", "draw").agg(F.min(piece).alias("text"))
    letters = min(SAMPLE_LETTERS, ALL_LETTERS // len(counts))
    samples: dict[str, list[str]] = {}
    for row in drawn.orderBy("draw", "text").toLocalIterator():
        samples.setdefault(row["lang"], []).append(plain(row["text"]))
    joined = {x: " ".join(some)[:letters] for x, some in samples.items()}
    return {x: s for x, s in joined.items() if s.strip()}


def identify(docs: DataFrame, samples: dict[str, str], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``lang_pred``, ``score``, ``n_letters``, ``phrases_per_letter``.

    ``score`` is the runner-up's weighed phrases over those of the winner and the runner-up
    (0.5 a tie, 1 if one language is known); ties go to the first name. Null texts, texts
    without a letter and empty samples give ``und`` and 0. Repeated rows give repeated results;
    further columns are not read; whole texts are parsed. No shuffle.
    """
    source = id_and_text(docs, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(Parser(samples))

    def run(batches) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        known = parser.letter_classes()
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for lo, hi in chunks(texts, CHUNK):
                counts, letters = parser.phrases(texts[lo:hi], known)
                cost = counts * parser.bits
                found = (letters > 0) & (len(parser.languages) > 0)
                names, score, rate = [UNDETERMINED] * (hi - lo), np.zeros(hi - lo), np.zeros(hi - lo)
                if len(parser.languages):
                    best = cost.argmin(axis=1)
                    names = [parser.languages[b] if ok else UNDETERMINED for b, ok in zip(best, found, strict=True)]
                    least = cost.min(axis=1)
                    second = np.partition(cost, 1, axis=1)[:, 1] if len(parser.languages) > 1 else least
                    if len(parser.languages) == 1:
                        score = found.astype(float)
                    else:
                        score = np.where(found, second / np.maximum(least + second, 1e-9), 0.0)
                    rate = np.where(found, counts.min(axis=1) / np.maximum(letters, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(score), pa.array(letters), pa.array(rate)],
                    ["doc_id", "lang_pred", "score", "n_letters", "phrases_per_letter"],
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, n_letters long, phrases_per_letter double")


def keep_identified(docs: DataFrame, samples: dict[str, str], text_column: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language: null texts and texts without a letter go.

    If no language is known, no row is rejected. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Parser(samples))

    def run(batches) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        known = parser.letter_classes()
        for batch in batches:
            texts = [x or "" for x in batch.column(text_column).to_pylist()]
            kept = [np.zeros(0, bool)]
            for lo, hi in chunks(texts, CHUNK):
                counts, letters = parser.phrases(texts[lo:hi], known)
                kept.append((letters > 0) & (counts.sum(axis=1) > 0))
            yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema) if samples else docs


def held_out(key: Column) -> Column:
    """Whether a document is set aside for measuring: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))
