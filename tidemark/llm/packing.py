"""Concatenate and cut: documents become one stream of token ids, cut into windows of equal length.

The first pass tokenizes each partition and stores, with every document, the tokens before it
in its partition. Prefix sums over the partitions' totals give each partition its place in the
stream; the second pass reads the stored ids and cuts them where windows end. No document is
moved: the only rows shuffled are one total per partition.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import id_and_text, pieces
from tidemark.session import written

LENGTH, END_ID = 2048, 1
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Words of one call to the tokenizer.
TOGETHER = 500
#: Encoded words a worker remembers; when there are more it keeps those of the texts at hand.
REMEMBERED = 600_000
#: A full stop or comma that ends a word and follows an ASCII letter or digit.
_STOP = re.compile(rb"([.,])(?<=[a-z0-9][.,])(?![^\x20\x09-\x0D])")


class WordEncoder:
    """Ids of texts, encoded word by word with a memory.

    White space ends every token of this tokenizer and leaves none, so the ids of a text are
    those of its words in turn; a full stop or comma after an ASCII letter or digit is a token
    apart, and capitals are read as small letters. So texts are lowered and such stops set
    apart first, which leaves fewer different words to encode. A text that may hold one of the
    tokenizer's own marks is left as it is. Ids are little-endian, two bytes each if the
    vocabulary allows.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.end = np.array([END_ID], self.dtype).tobytes()
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(self.tokenizer.get_vocab_size())])
        self.known: dict[bytes, bytes] = {}

    def _learn_runs(self, words: list[bytes]) -> list[bytes]:
        """Encode words of letters alone, many to a call, cut where a token ends a word; the words of a call that cut otherwise are left."""
        left: list[bytes] = []
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, self.dtype)
            cuts = (np.flatnonzero(self.ends_word[ids]) + 1) * self.dtype.itemsize
            if len(cuts) == len(group):  # otherwise some word is more than one run of letters to the tokenizer
                raw, ends = ids.tobytes(), cuts.tolist()
                self.known.update(zip(group, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
            else:
                left += group
        return left

    def learn(self, words: set[bytes]) -> None:
        new = list(words.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:  # the words of the texts at hand stay, the frequent ones among them
            self.known = {w: self.known[w] for w in words if w in self.known}
        letters = [w for w in new if w.isalpha() or not w.isascii() and w.decode().isalpha()]
        rest = self._learn_runs(letters) + list(set(new).difference(letters))
        alone = self.tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
        self.known.update((w, np.array(x.ids, self.dtype).tobytes()) for w, x in zip(rest, alone, strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text and the end id."""
        split = [(t if b"<|" in t else _STOP.sub(rb" \1 ", t.lower())).split() for t in texts]
        self.learn(set().union(*split))
        return [b"".join(map(self.known.__getitem__, x)) + self.end for x in split]


_ENCODERS: dict[str, WordEncoder] = {}  # one for each Python worker: its memory serves later tasks too


def tokenized(docs: DataFrame, tokenizer: str = TOKENIZER, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Stored ids of every document: ``part``, ``row``, ``doc_id``, ``before``, ``doc_tokens``, ``ids``.

    ``part`` and ``row`` say where the document was read, ``before`` counts the tokens of its
    part before it. The place of a row in its input file fixes all of them, so a task run again
    writes the same.
    """
    source = id_and_text(docs, id_column, text_column)
    definition = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = WordEncoder(definition.value)
        encoder = _ENCODERS[tokenizer]
        part, row, before = TaskContext.get().partitionId(), 0, 0
        for batch, texts in pieces(batches):
            ids = encoder.encode(texts)
            n = np.array([len(x) // encoder.dtype.itemsize for x in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), part, np.int32)), pa.array(row + np.arange(len(ids))), batch.column("doc_id"),
                    pa.array(before + np.cumsum(n) - n), pa.array(n), pa.array(ids, pa.binary()), pa.array(np.full(len(ids), encoder.dtype.itemsize, np.int32)),
                ],
                ["part", "row", "doc_id", "before", "doc_tokens", "ids", "id_bytes"],
            )
            row, before = row + len(ids), before + int(n.sum())

    kind = source.schema["doc_id"].dataType.simpleString()
    return written(source.mapInArrow(run, f"part int, row long, doc_id {kind}, before long, doc_tokens long, ids binary, id_bytes int"), "tokens")


def packed(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and, if asked for, ``ids``.

    Sequence ``k`` is tokens ``k * length`` up to ``(k + 1) * length`` of the stream; only the
    last one can be shorter. Null and empty texts are the end id alone; repeated rows are packed
    each; further columns are not read; an empty table has no pieces.
    """
    stored = tokenized(docs, tokenizer, id_column, text_column)
    totals = stored.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # one row per input partition, so one task sums them and every task may hold them
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("place"))
    rows = stored.join(F.broadcast(places), "part").select("doc_id", (F.col("place") + F.col("before")).alias("at"), "doc_tokens", "ids", "id_bytes")

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                of, out = [], []
                for i, row in enumerate(some.select(["at", "doc_tokens", "ids", "id_bytes"]).to_pylist()):
                    ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4")
                    start, at, n = 0, row["at"], row["doc_tokens"]
                    while start < n:
                        took = min(n - start, length - at % length)
                        raw = ids[start : start + took].tobytes()
                        of.append(i)
                        out.append((start, took, zlib.crc32(raw), n, at // length, at % length, raw if with_ids else None))
                        start, at = start + took, at + took
                columns = list(zip(*out, strict=True)) or [[]] * 7
                arrays = [some.column("doc_id").take(pa.array(of, pa.int64())), *(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def sequences(found: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """One row per sequence: ``sequence_id``, ``input_ids``, ``doc_ids``, ``doc_offsets``, ``n_tokens``.

    The ids of its pieces (at most ``length`` of them, so groups are bounded) are joined and
    padded to ``length``; a shorter one whose size is a power of two stays as it is.
    """
    kind = found.schema["doc_id"].dataType.simpleString()
    group = found.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))

    def joined(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = [], []
            for parts in batch.column("parts").to_pylist():
                one = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32)
                pad = 0 if len(one).bit_count() == 1 else length - len(one)
                sizes.append(len(one))
                ids.append(np.pad(one, (0, pad), constant_values=pad_id))
            arrays = [batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int32())), batch.column("doc_ids"), batch.column("doc_offsets"), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["sequence_id", "input_ids", "doc_ids", "doc_offsets", "n_tokens"])

    rows = group.select("sequence_id", "parts", F.col("parts.doc_id").alias("doc_ids"), F.col("parts.offset").alias("doc_offsets"))
    return rows.mapInArrow(joined, f"sequence_id long, input_ids array<int>, doc_ids array<{kind}>, doc_offsets array<long>, n_tokens int")
