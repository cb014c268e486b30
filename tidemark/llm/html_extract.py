"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of a page.

A page is read into blocks, the runs of text between block elements, each with the elements it
stands in. Ancestor tags, words of their class and id, and shape of the text are the features;
the field is trained on labelled pages (``labelled_pages``) and decoded by Viterbi.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template title textarea noscript iframe".split())
#: In these, and for these themselves, a tag that ends in a slash is an empty element.
FOREIGN = ("svg", "math")
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
#: A start tag ends an open element of these kinds, unless one of the second kinds lies between.
ENDS = {t: ("p", frozenset("td th button dialog".split())) for t in BLOCK - {"button", "label", "option", "optgroup", "select", "body", "html", "head", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}}
ENDS |= {"li": ("li", frozenset("ul ol menu".split())), "option": ("option", frozenset(["select"])), "tr": ("tr", frozenset(["table"])), "td": ("td", frozenset("tr table".split())), "th": ("th", frozenset("tr table".split()))}
ENDS |= {"dt": ("dd", frozenset(["dl"])), "dd": ("dt", frozenset(["dl"]))}
_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+>|(/?)([A-Za-z][^\s/>]*+)(?:((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)|([^>]*+))>)", re.S)
#: The same where quotes have no meaning.
_BARE_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+>|(/?)([A-Za-z][^\s/>]*+)([^>]*+)()>)", re.S)
_RAW_END = {t: re.compile(f"</{t}", re.I | re.A) for t in RAW}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_MARK = re.compile(r"\bdata-main\b", re.I)
_SUBWORD = re.compile(r"[a-z]{2,}")


@dataclass
class Block:
    text: str
    tags: frozenset[str]
    block: str  # the innermost block element
    names: frozenset[str]
    linked: int  # characters inside links
    main: bool  # an ancestor carries ``data-main``: the label of a training page


@dataclass
class _Reader:
    """Open elements at any depth, with their places by tag and counts of their names, so that a tag costs the elements it closes."""

    known: frozenset[str] | None = None  # features to keep, all by default
    stack: list[tuple[str, tuple[str, ...], bool]] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)
    names: dict[str, int] = field(default_factory=dict)
    open_blocks: list[str] = field(default_factory=list)
    mains: int = 0
    parts: list[tuple[str, bool]] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)

    def flush(self) -> None:
        text = " ".join("".join(p for p, _ in self.parts).split())
        if text:
            linked = sum(len(p) for p, link in self.parts if link)
            tags = frozenset(self.places if self.known is None else [t for t in self.places if f"in:{t}" in self.known])
            block = self.open_blocks[-1] if self.open_blocks else "none"
            self.blocks.append(Block(text, tags, block, frozenset(self.names), min(linked, len(text)), self.mains > 0))
        self.parts.clear()

    def open(self, tag: str, names: tuple[str, ...], main: bool) -> None:
        if self.known is not None:
            names = tuple(n for n in names if f"name:{n}" in self.known)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, names, main))
        for n in names:
            self.names[n] = self.names.get(n, 0) + 1
        if tag in BLOCK:
            self.open_blocks.append(tag)
        self.mains += main

    def close(self, tag: str, stop: frozenset[str] = frozenset()) -> None:
        if tag not in self.places:
            return
        place = self.places[tag][-1]
        if any(self.places[t][-1] > place for t in stop if t in self.places):
            return
        while len(self.stack) > place:
            last, names, main = self.stack.pop()
            self.places[last].pop()
            if not self.places[last]:
                del self.places[last]
            for n in names:
                self.names[n] -= 1
                if not self.names[n]:
                    del self.names[n]
            if last in BLOCK:
                self.open_blocks.pop()
            self.mains -= main

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append((html.unescape(raw) if "&" in raw else raw, "a" in self.places))


def _is_empty(attributes: str) -> bool:
    """Whether a tag ends in a slash that does not belong to a value without quotes."""
    return attributes.endswith("/") and (attributes[-2:-1] in "\"'" or "=" not in attributes.split()[-1])


def read_blocks(page: str, known: frozenset[str] | None = None) -> list[Block]:
    """Leaf blocks in page order; comments, scripts, styles and other raw elements have no text.

    A raw element without an end tag reaches to the end of the page, as in a browser; ``svg``,
    ``math`` and ``object`` are elements like others. After a tag whose quotes leave no end of
    it, quotes mean nothing any more; a ``<`` behind the last ``>`` begins no tag. Both keep the
    reading of a page proportional to its length. Of ``tags`` and ``names`` only those in
    ``known`` are kept, if given.
    """
    reader, at, pattern, stop = _Reader(known), 0, _TAG, page.rfind(">") + 1
    while found := pattern.search(page, at, stop):
        reader.text(page[at : found.start()])
        at = found.end()
        if found[0].startswith("<!--") and not found[0].endswith("-->"):
            at = stop = len(page)
            break
        attributes = found[3] if found[3] is not None else found[4]
        if found[4] is not None:
            pattern = _BARE_TAG
        if not found[2]:
            continue
        tag = found[2].lower()
        if tag in BLOCK:
            reader.flush()
        if found[1]:
            reader.close(tag)
            continue
        if (tag in FOREIGN or any(t in reader.places for t in FOREIGN)) and _is_empty(attributes):
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = len(page) if end is None else end.start()
            continue
        if ended := ENDS.get(tag):
            reader.close(*ended)
            if tag in ("dt", "dd"):
                reader.close(tag, frozenset(["dl"]))
        if tag == "br":
            reader.parts.append((" ", False))
        if tag not in VOID:
            names = tuple(w for m in _NAMES.finditer(attributes) for w in _SUBWORD.findall((m[1] or m[2] or m[3] or "").lower())) if "=" in attributes else ()
            reader.open(tag, names, bool(_MARK.search(attributes)))
    open_comment = page.find("<!--", at)
    reader.text(page[at:] if open_comment < 0 else page[at:open_comment])
    reader.flush()
    return reader.blocks


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that hold for each block."""
    out = []
    for i, b in enumerate(blocks):
        words = b.text.split()
        n = len(words)
        rows = [f"in:{t}" for t in b.tags - {"html", "body"}] + [f"name:{w}" for w in b.names]
        rows += ["bias", f"block:{b.block}", f"words:{min(6, n.bit_length())}", f"links:{min(4, 4 * b.linked // len(b.text))}"]
        rows.append("ends" if b.text[-1] in ".!?:;。！？…\"”»" else "open")
        rows += ["first"] if i == 0 else []
        rows += ["last"] if i == len(blocks) - 1 else []
        rows += [f"block:{b.block}+words:{min(6, n.bit_length())}"]
        out.append(rows)
    return out


class Field:
    """Weights of the two labels (0 other, 1 main) and of each step between neighbours."""

    def __init__(self, emit: dict[str, float], start: np.ndarray, step: np.ndarray):
        self.known = frozenset(emit)
        self.emit, self.start, self.step = emit, [float(x) for x in start], [[float(x) for x in row] for row in step]

    def decode(self, rows: list[list[str]]) -> list[bool]:
        """The likeliest labels (Viterbi); ties go to the label other."""
        if not rows:
            return []
        score = [sum(self.emit.get(f, 0.0) for f in r) for r in rows]  # of main against other
        best = [self.start[0], self.start[1] + score[0]]
        back = []
        for s in score[1:]:
            from0 = 0 if best[0] + self.step[0][0] >= best[1] + self.step[1][0] else 1
            from1 = 0 if best[0] + self.step[0][1] >= best[1] + self.step[1][1] else 1
            back.append((from0, from1))
            best = [best[from0] + self.step[from0][0], best[from1] + self.step[from1][1] + s]
        label = 1 if best[1] > best[0] else 0
        labels = [label]
        for pair in reversed(back):
            label = pair[label]
            labels.append(label)
        return [x == 1 for x in reversed(labels)]


def train(pages: list[str], rounds: int = 300, decay: float = 2e-3, rate: float = 0.05) -> Field:
    """The field that makes the labels of ``pages`` (elements with ``data-main``) likeliest.

    Gradients of the log likelihood come from forward and backward sums; a bounded number of
    pages, each held whole, is fitted on the driver.
    """
    read = [b for b in map(read_blocks, pages) if b]
    rows = [features(b) for b in read]
    names = {f: i for i, f in enumerate(sorted({f for page in rows for block in page for f in block}))}
    longest = max(map(len, rows), default=0)
    x = np.zeros((len(rows), longest, len(names)), np.float32)
    y = np.zeros((len(rows), longest), np.int64)
    sizes = np.array([len(r) for r in rows])
    for p, page in enumerate(rows):
        for t, block in enumerate(page):
            x[p, t, [names[f] for f in block]] = 1
            y[p, t] = read[p][t].main
    real = np.arange(longest)[None] < sizes[:, None]
    theta = np.zeros(len(names) + 6)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    both = real[:, 1:] & real[:, :-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
    for k in range(1, rounds + 1 if len(rows) else 1):
        w, start, step = theta[:-6], theta[-6:-4], theta[-4:].reshape(2, 2)
        score = np.stack([np.zeros(y.shape), x @ w], axis=-1)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(forward[:, t - 1, :, None] + step, axis=1) + score[:, t]
            forward[:, t] = np.where(real[:, t, None], new, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(step + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(real[:, t + 1, None], new, 0.0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        chance = np.exp(forward + backward - total[:, None, None]) * real[:, :, None]
        pair = forward[:, :-1, :, None] + step + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected = (np.exp(np.minimum(pair, 0)) * both[:, :, None, None]).sum(axis=(0, 1))
        gradient = np.concatenate([
            np.tensordot((y * real - chance[:, :, 1]), x, axes=2), np.bincount(y[:, 0], minlength=2) - chance[:, 0].sum(axis=0), (seen - expected).ravel(),
        ]) / len(rows) - decay * theta
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        theta = theta + rate * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.999**k)) + 1e-8)
    return Field({f: float(theta[i]) for f, i in names.items()}, theta[-6:-4], theta[-4:].reshape(2, 2))


def main_text(page: str, field_: Field) -> str:
    """Blocks labelled main, joined by a line break."""
    blocks = read_blocks(page, field_.known)
    return "\n".join(b.text for b, keep in zip(blocks, field_.decode(features(blocks)), strict=True) if keep)


@lru_cache(maxsize=1)
def default_field() -> Field:
    from tidemark.llm.labelled_pages import pages

    return train(pages())


def extract(pages: DataFrame, model: Field | None = None, html_column: str = "html") -> DataFrame:
    """The rows of ``pages`` without the html, with ``text``, ``n_chars`` and ``n_blocks`` (all blocks of the page).

    Null, empty and tag-only pages have an empty text. Repeated rows give repeated results;
    a column named ``text``, ``n_chars`` or ``n_blocks`` of the input gives way. No shuffle;
    a task holds one page at a time.
    """
    model = model or default_field()
    made = ["text", "n_chars", "n_blocks"]
    others = [c for c in pages.columns if c != html_column and c not in made]
    source = pages.select(*others, pages[html_column].cast("string").alias(html_column))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts, sizes = [], []
                for page in part.column(html_column).to_pylist():
                    blocks = read_blocks(page or "", model.known)
                    sizes.append(len(blocks))
                    texts.append("\n".join(b.text for b, keep in zip(blocks, model.decode(features(blocks)), strict=True) if keep))
                arrays = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in others), *arrays], [*others, *made])

    schema = source.select(*others).schema.add("text", "string").add("n_chars", "long").add("n_blocks", "long")
    return source.mapInArrow(run, schema)
