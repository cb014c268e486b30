"""Phrases against brute force; transducers against plain counting."""

import random
import re
import tracemalloc
import weakref
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import collocations
from tidemark.llm.collocations import Shard, Transducer


def brute(rows, least=10, top=2000):
    counts = defaultdict(Counter)
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        longer = Counter()
        for g, a in f.items():
            if len(g) == 3 and a >= least:
                for part in (g[:2], g[1:]):
                    longer[part] = max(longer[part], a)
        found = []
        for g, a in f.items():
            if len(g) < 2 or a < least or 100 * longer[g] >= 50 * a:
                continue
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(found[:top])]
    return sorted(out)


def drawn(n=400, seed=2):
    draw = random.Random(seed)
    words = ["The", "the", "a", "cat", "Straße", "ÉTÉ", "東京", "\x00", "x-y", "\U0001f600", *(f"w{i}" for i in range(5))]
    rows = []
    for i in range(n):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " ! ", "\x0b"]) for _ in range(draw.randint(0, 60)))
        rows.append((text + draw.choice(["", "New York City", "of the cat"]), draw.choice(["en", "de", None, "und"])))
    return [*rows, (None, "en"), ("", "fr"), (" \n.", None), rows[0], ("x" * 9000 + " of the cat", "en")]


def found(spark, rows, **options):
    frame = spark.createDataFrame([(t, x, 1, "p", 5) for t, x in rows], "text string, lang string, n int, phrase string, place long")
    return sorted(tuple(r) for r in collocations.collocations(frame, **options).collect())


@pytest.mark.parametrize("many", [False, True])
def test_phrases(spark, monkeypatch, many):
    if many:  # ranges, shards, parts of texts and buckets of a few windows each
        for name, value in {"RANGE_WINDOWS": 256, "SAMPLES": 4, "BLOCK_BYTES": 3000, "PART_BYTES": 50, "BUCKET": 20}.items():
            monkeypatch.setattr(collocations, name, value)
    rows = drawn()
    want = brute(rows)
    assert len(want) > 50 and found(spark, rows) == want


def test_limits_and_ties(spark):
    rows = drawn(120, 5)
    assert found(spark, rows, least=3, top=7) == brute(rows, 3, 7)


def test_no_phrases(spark, odd, empty):
    assert collocations.collocations(empty).collect() == [] and found(spark, [("one two", "en")]) == []
    assert {r.lang for r in collocations.collocations(odd).collect()} <= {"en", "und"}


def test_scores_beyond_64_bits(spark):
    a, l, r = 7_000_000_000_001, 9_000_000_000_003, 8_000_000_000_007
    frame = spark.createDataFrame([(a, l, r), (10, 3_000_000_000_000, 4_000_000_000_000)], "a long, l long, r long")
    assert [x.score for x in collocations.scored(frame).collect()] == [1000000 * a * a // (l * r), 0]


def test_transducers(monkeypatch):
    draw = random.Random(1)
    shard = Shard()
    texts = [" ".join(draw.choice("abcdefghijklmnopqrst") for _ in range(draw.randint(0, 30))) for _ in range(60)]
    for t in texts:
        shard.add(t.encode())
    words, hashes, windows, counts = shard.counted()
    want = Counter()
    for t in texts:
        w = t.encode().split()
        want.update(tuple([*w, b"", b""][i : i + 3]) for i in range(len(w)))
    made = Transducer.unpacked(Transducer.of(windows, counts).packed())
    paths, weights = made.windows()
    assert {tuple(words[i] for i in row): c for *row, c in zip(*(p.tolist() for p in paths), weights.tolist(), strict=True)} == want
    assert sum(made.width) < len(weights)  # states with one equal arc are shared
    some = np.flatnonzero(np.arange(len(counts)) % 3 == 0)
    asked = [np.append(w[some], x) for w, x in zip(windows, (len(words), 1, 1), strict=True)]
    got, n = made.composed(Transducer.of(asked, np.ones(len(some) + 1, np.int64)))
    assert [g.tolist() for g in got] == [w[some].tolist() for w in windows] and n.tolist() == counts[some].tolist()
    ends = np.stack([hashes[w[5::11]] for w in windows], axis=1)
    places = collocations._places(windows, hashes, ends)
    keys = [tuple(int(hashes[i]) for i in row) for row in zip(*windows, strict=True)]
    assert places.tolist() == [sum(tuple(int(x) for x in e) <= k for e in ends) for k in keys]
    monkeypatch.setattr(collocations, "_bits", lambda size: 22)  # keys too wide for one number
    assert collocations._places(windows, hashes, ends).tolist() == places.tolist()
    again = shard.counted()
    assert [w.tolist() for w in again[2]] == [w.tolist() for w in windows] and again[3].tolist() == counts.tolist()


def test_memory_of_a_range_follows_its_different_windows(monkeypatch):
    shard = Shard()
    draw = random.Random(4)
    shard.add(" ".join(f"w{draw.randrange(3000)}" for _ in range(20_000)).encode())
    words, _, windows, counts = shard.counted()
    piece = (b"\n".join(words[1:]), Transducer.of(windows, counts).packed())
    monkeypatch.setattr(collocations, "WAITING", 1000)

    def peak(pieces):
        tracemalloc.start()
        united = collocations._united(piece for _ in range(pieces))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most, united

    few, _ = peak(3)
    many, (names, found, weight) = peak(60)
    assert many < 1.5 * few
    assert names == words and weight.tolist() == (60 * counts).tolist() and [f.tolist() for f in found] == [w.tolist() for w in windows]
    assert len(collocations._united(iter(()))[2]) == 0
    assert collocations.RANGE_WINDOWS <= 1 << 20


def test_alike_shards_tell_of_different_windows(monkeypatch):
    monkeypatch.setattr(collocations, "RANGE_WINDOWS", 6400)
    monkeypatch.setattr(collocations, "SAMPLES", 64)
    draw = random.Random(6)
    text = " ".join(f"w{draw.randrange(500)}" for _ in range(3000)).encode()
    samples = set()
    for i in range(200):
        shard = Shard()
        shard.add(text)
        rows = [r for batch in collocations._shard_rows("en", shard, (0, i)) for r in batch.to_pylist()]
        found = np.frombuffer(rows[0]["sample"], "<u8").reshape(-1, 3)
        assert 28 <= len(found) <= 31
        samples |= {tuple(w) for w in found.tolist()}
    assert len(samples) > 1500  # of 3,000 windows; shards that begin alike would tell of 30


def test_a_small_shard_beside_others(spark):
    """A shard may be too small for a sample of its windows."""
    rows = [("one two three " * 12, lang) for lang in ("en", "de", None)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("before", [None, "12345678"])
def test_batches_of_texts_are_limited_by_their_bytes(spark, monkeypatch, before):
    """10,000 texts of any length are not held at once by an executor and by Python."""
    key, rows, batches = "spark.sql.execution.arrow.maxBytesPerBatch", 4000, []

    class Seen(Exception):
        pass

    def probe(found):
        for b in found:
            none = pa.array([b""], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([str(b.num_rows)]), pa.array([b.nbytes]), none, none, none], collocations._SHARD)

    def look(frame, label, **options):
        batches.extend((int(r.lang), r.n) for r in frame.collect())
        raise Seen

    monkeypatch.setattr(collocations, "_shards", probe)
    monkeypatch.setattr(collocations, "written", look)
    texts = spark.range(0, rows, 1, 1).select(F.repeat(F.lit("word "), 1000).alias("text"), F.lit("en").alias("lang"))
    if before:
        spark.conf.set(key, before)
    try:
        with pytest.raises(Seen):
            collocations.collocations(texts)
        assert sum(n for n, _ in batches) == rows
        assert max(size for _, size in batches) < 3 << 20
        assert spark.conf.get(key, None) == before  # other queries keep their own
    finally:
        spark.conf.unset(key)


def test_languages_of_a_block_are_let_go_one_by_one(monkeypatch):
    """While a language is counted, those counted before it are no longer held."""
    alive, made = weakref.WeakSet(), []

    class Watched(Shard):
        def __init__(self):
            super().__init__()
            alive.add(self)

        def counted(self):
            made.append(len(alive))
            return super().counted()

    class Task:
        get = classmethod(lambda cls: cls)
        partitionId = classmethod(lambda cls: 0)

    monkeypatch.setattr(collocations, "Shard", Watched)
    monkeypatch.setattr(collocations, "TaskContext", Task)
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de", "fr", "en"], "text": ["one two three"] * 4})
    assert [r["n"] for b in collocations._shards(iter([batch])) for r in b.to_pylist()] == [6, 3, 3]
    assert made == [3, 2, 1]


def test_shards_fill_a_page_each(spark, monkeypatch):
    """Codecs hold a whole page in memory beside the heap, so pages do not hold all shards of a task."""
    size, rows = 2 << 20, 6

    class Seen(Exception):
        pass

    def probe(found):
        for _ in found:
            for _ in range(rows):
                yield pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([1]), *(pa.array([x], pa.binary()) for x in (b"", random.randbytes(size), b""))], collocations._SHARD)

    def look(frame, label, **options):
        files.extend(session.written(frame, label, **options).inputFiles())
        raise Seen

    files = []
    monkeypatch.setattr(collocations, "_shards", probe)
    monkeypatch.setattr(collocations, "written", look)
    with pytest.raises(Seen):
        collocations.collocations(spark.range(0, 10, 1, 1).select(F.lit("one").alias("text"), F.lit("en").alias("lang")))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(files[0]), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    try:
        columns = {c.getPath().toDotString(): c for c in reader.getFooter().getBlocks()[0].getColumns()}
        assert reader.readOffsetIndex(columns["arcs"]).getPageCount() == rows
    finally:
        reader.close()
