"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass takes together; a longer text goes alone.
CHUNK_BYTES = 1 << 20
#: Words are runs of everything but these bytes: exactly what ``bytes.split()`` splits on.
WORD_SPACE = r"[\x20\x09-\x0D]+"


_BASE = np.uint64(0xD1B54A32D192ED03)
_INVERSE = np.uint64(pow(0xD1B54A32D192ED03, -1, 1 << 64))
#: A number for each byte, drawn once from a fixed seed; and which bytes stand between words.
_BYTES = np.random.default_rng(11).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in a row, and how many words each text has.

    Words are those of ``bytes.split()``. Bytes are summed with powers of a base, so the hash
    of a word is a difference of two sums; a part of about ``CHUNK_BYTES`` is worked on at once.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _IS_SPACE[joined]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[0::2], edges[1::2]
    out = np.zeros(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + CHUNK_BYTES, side="right")))
        base, size = int(starts[lo]), int(ends[hi - 1] - starts[lo])
        powers = np.ones(size, np.uint64)
        powers[1:] = _BASE
        np.cumprod(powers, out=powers)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTES[joined[base : base + size]] * powers, out=sums[1:])
        first = starts[lo:hi] - base
        inverse = np.full(size, _INVERSE)
        inverse[0] = 1
        found = (sums[ends[lo:hi] - base] - sums[first]) * np.cumprod(inverse)[first]
        out[lo:hi] = mixed(found ^ mixed((ends[lo:hi] - starts[lo:hi]).astype(np.uint64)))
        lo = hi
    sizes = np.diff(np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)])))
    return out, sizes


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a test table; the path is only ever opened by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text, empty for null."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def pieces(batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of incoming batches with the bytes of their column ``text``."""
    for batch in batches:
        texts = text_bytes(batch.column("text"))
        for lo, hi in chunks(texts, limit):
            yield batch.slice(lo, hi - lo), texts[lo:hi]


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names."""
    return docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("string").alias("text"))


def native_words(text: Column) -> Column:
    """The words of a text as an array, empty for null or blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPACE), lambda w: w != "")
