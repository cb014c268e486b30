"""Repetition coverage: which share of a text lies inside repeated n-grams and lines.

Rolling hashes over word numbers are built one word at a time, so one pass gives every
length. A window can only be repeated if both windows one word shorter are, so each length
looks at what the length before left over; in prose that is little after two words. Equal
hashes are checked word by word. Several texts share a numpy pass, told apart by the hash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import id_and_text, pieces

#: Percent of the word characters that the most frequent n-gram may hold (found thrice or more).
TOP_LIMITS = {2: 20, 3: 18, 4: 16}
#: Percent of the word characters that may lie inside n-grams found twice or more.
DUPLICATE_LIMITS = {5: 25, 6: 24, 7: 23, 8: 22, 9: 21, 10: 20}
#: Percent of the lines, and of their characters, that may repeat an earlier line.
LINE_LIMIT, LINE_CHARS_LIMIT = 50, 25
BASE_WORDS, BASE_REPEAT, BASE_LENGTH, TOP_LEAST = 10, 20, 5, 3
SYMBOLS = b"#*$%&|<>"
LENGTHS = range(2, 11)
_BASE = np.uint64(0x9E3779B97F4A7C15)

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = ["dup_line_chars", *(f"top_{n}_chars" for n in TOP_LIMITS), *(f"dup_{n}_chars" for n in DUPLICATE_LIMITS)]
SCHEMA = ", ".join(
    ["doc_id {id}", *(f"{c} long" for c in COLUMNS), "base_failed boolean", "kept boolean", *(f"{c} long" for c in MEASURES)]
)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well-spread bits for each number (the splitmix64 finaliser)."""
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _equal_windows(keys: np.ndarray, starts: np.ndarray, words: np.ndarray, owner: np.ndarray, n: int):
    """Starts in an order that puts equal windows side by side, and the number of each one's group."""
    order = np.argsort(keys, kind="stable")
    keys, starts = keys[order], starts[order]
    same = keys[1:] == keys[:-1]
    at = np.flatnonzero(same)
    true = owner[starts[at]] == owner[starts[at + 1]]
    for j in range(n):
        true &= words[starts[at] + j] == words[starts[at + 1] + j]
    if not true.all():  # unequal windows share a hash: order by the words themselves
        order = np.lexsort([words[starts + j] for j in range(n)] + [owner[starts]])
        starts = starts[order]
        same = owner[starts[1:]] == owner[starts[:-1]]
        for j in range(n):
            same &= words[starts[1:] + j] == words[starts[:-1] + j]
    return starts, np.concatenate([[0], np.cumsum(~same)]) if len(starts) else starts


def measure(texts: list[bytes]) -> dict[str, np.ndarray]:
    """All counts of each text; see ``repetition``."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    split = [t.split() for t in texts]
    n_words = np.array([len(x) for x in split], np.int64)
    words = np.fromiter((numbers[w] for x in split for w in x), np.int64, int(n_words.sum()))
    owner = np.repeat(np.arange(len(texts)), n_words)
    sizes = np.fromiter((len(w.decode()) for w in numbers), np.int64, len(numbers))[words]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    total = lambda mask: np.bincount(owner[mask], weights=sizes[mask], minlength=len(texts)).astype(np.int64)
    out = {"n_words": n_words, "word_chars": total(np.ones(len(words), bool))}
    out["n_symbols"] = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)
    lines = [[x for x in t.split(b"\n") if x.split(None, 1)] for t in texts]
    out["n_lines"] = np.array([len(x) for x in lines], np.int64)
    out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], np.int64)
    chars = lambda some: sum(len(x.decode()) for x in some)
    out["line_chars"] = np.array([chars(x) for x in lines], np.int64)
    out["dup_line_chars"] = out["line_chars"] - np.array([chars(set(x)) for x in lines], np.int64)

    hashes = _mixed(words.astype(np.uint64))
    rolled = hashes ^ _mixed(owner.astype(np.uint64) + np.uint64(1 << 40))  # the first word also names the text
    alive = np.arange(len(words))  # where a window of the length before is repeated
    repeated = np.ones(len(words) + 1, bool)
    for n in LENGTHS:
        alive = alive[alive + n <= len(words)]
        alive = alive[(owner[alive] == owner[alive + n - 1]) & repeated[alive + 1]]
        rolled = rolled[: max(0, len(words) - n + 1)] * _BASE + hashes[n - 1 :]
        starts, group = _equal_windows(rolled[alive], alive, words, owner, n)
        times = np.bincount(group)[group] if len(group) else group
        if n in TOP_LIMITS:
            held = (upto[starts + n] - upto[starts]) * times * (times >= TOP_LEAST)
            out[f"top_{n}_chars"] = np.zeros(len(texts), np.int64)
            np.maximum.at(out[f"top_{n}_chars"], owner[starts], held)
        alive = np.sort(starts[times > 1])
        repeated = np.zeros(len(words) + 1, bool)
        repeated[alive] = True
        if n in DUPLICATE_LIMITS:
            edges = np.bincount(alive, minlength=len(words) + 1) - np.bincount(alive + n, minlength=len(words) + 1)
            inside = np.cumsum(edges)[: len(words)] > 0
            out[f"dup_{n}_chars"] = total(inside)
            if n == BASE_LENGTH:
                out["n_repeat_words"] = np.bincount(owner[inside], minlength=len(texts)).astype(np.int64)
    return out


def verdicts(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) in whole numbers, so SQL can say the same."""
    failed = (m["n_words"] < BASE_WORDS) | (100 * m["n_repeat_words"] > BASE_REPEAT * m["n_words"])
    bad = (100 * m["n_dup_lines"] > LINE_LIMIT * m["n_lines"]) | (100 * m["dup_line_chars"] > LINE_CHARS_LIMIT * m["line_chars"])
    for n, limit in TOP_LIMITS.items():
        bad |= 100 * m[f"top_{n}_chars"] > limit * m["word_chars"]
    for n, limit in DUPLICATE_LIMITS.items():
        bad |= 100 * m[f"dup_{n}_chars"] > limit * m["word_chars"]
    return failed, ~failed & ~bad


def repetition(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: repetition counts, ``base_failed`` and ``kept``.

    ``dup_n_chars`` counts characters of words inside n-grams found twice or more in the text
    (first included, each word once), ``top_n_chars`` those of the n-gram that holds most,
    ``dup_line_chars`` those of lines equal to an earlier one. Null and empty texts have no
    words: all counts 0, base_failed. Repeated rows give repeated results, further columns are
    not read, an empty table gives an empty result. No shuffle; memory is that of a chunk of
    about a megabyte or of one text.
    """
    source = id_and_text(docs, id_column, text_column)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            m = measure(texts)
            failed, kept = verdicts(m)
            arrays = [part.column("doc_id"), *(pa.array(m[c]) for c in COLUMNS), pa.array(failed), pa.array(kept)]
            names = ["doc_id", *COLUMNS, "base_failed", "kept", *MEASURES]
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(m[c]) for c in MEASURES)], names)

    return source.mapInArrow(run, SCHEMA.format(id=source.schema["doc_id"].dataType.simpleString()))
