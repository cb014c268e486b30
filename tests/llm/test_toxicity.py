"""Features and steps against plain versions, the model by held-out rows."""

import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import TEXTS
from tidemark.llm import queries, toxicity

LEXICON = {"idiot": 4.0, "stup*": 3.0, "stupi*": 3.5, "trash": 2.0}


def plain_features(text):
    """A few features, word by word."""
    tokens = toxicity._TOKEN.findall(text or "")
    hits = []
    for i, token in enumerate(tokens):
        t = token.lower()
        w = t if t.isalpha() else toxicity.plain(t)
        weight = max(LEXICON.get(t, 0), LEXICON.get(w, 0) if w != t else 0) or max((LEXICON.get(w[:k] + "*", 0) for k in toxicity.STEMS if len(w) > k), default=0)
        if weight:
            hits.append((i, weight))
    persons = [i for i, t in enumerate(tokens) if t.lower() in toxicity.SECOND_PERSON]
    near = sum(any(abs(i - p) <= toxicity.NEAR for p in persons) for i, _ in hits)
    n = max(1, len(tokens))
    letters = sum(c.isalpha() for c in text or "")
    return {
        "lexicon": sum(w for _, w in hits) / n, "strongest": max((w for _, w in hits), default=0), "hits": len(hits) / n, "second_person": len(persons) / n,
        "near_second_person": near / n, "capitals": sum(c.isupper() for c in text or "") / max(1, letters), "exclamations": (text or "").count("!") / n,
        "words": np.log1p(len(tokens)), "symbols": sum(c in "#*$%&|<>@^~" for c in text or "") / max(1, len(text or "")),
    }


def test_features(monkeypatch):
    texts = [*TEXTS, "You IDIOT!! you st*pid 1d10t", "stupidity of the trash", "a b c d e f g h i j idiot", "idiot a b c d e f g you", "i.d.i.o.t", "Stuuuuupid?"]
    got = toxicity.Describer(LEXICON)(texts)
    for text, row in zip(texts, got, strict=True):
        for name, value in plain_features(text).items():
            assert row[toxicity.FEATURES.index(name)] == pytest.approx(value), (name, text)
    monkeypatch.setattr(toxicity, "PART", 50)
    monkeypatch.setattr(toxicity, "REMEMBERED", 3)
    assert np.allclose(toxicity.Describer(LEXICON)(texts), got)
    assert toxicity.Describer({})(texts)[:, :5].max() == 0 and toxicity.Describer({})([]).shape == (0, len(toxicity.FEATURES))


def test_form_counts():
    texts = [t or "" for t in TEXTS[:9]] * 2
    cells = np.arange(len(texts)) % 4
    counter = toxicity.FormCounter()
    for i in range(0, len(texts), 5):
        counter.add(texts[i : i + 5], cells[i : i + 5])
    want = {}
    for text, cell in zip(texts, cells.tolist(), strict=True):
        for f in set().union(*(toxicity.forms(t) for t in re.findall(toxicity._TOKEN, text.lower()))):
            want[f, cell] = want.get((f, cell), 0) + 1
    rows = counter.rows().to_pydict()
    assert dict(zip(zip(rows["entry"], rows["cell"], strict=True), rows["n"], strict=True)) == want


def test_isotonic():
    draw = np.random.default_rng(1)
    x, w = np.round(draw.random(60), 1), draw.random(60) + 0.5
    y = (draw.random(60) < x).astype(float)
    steps = toxicity.isotonic(x, y, w)
    fit = steps(x)
    assert (np.diff(steps.value) >= 0).all() and abs((fit * w).sum() - (y * w).sum()) < 1e-9
    for _ in range(200):  # no other rising function is nearer
        other = np.sort(draw.random(11))[(x * 10).round().astype(int)]
        assert (w * (fit - y) ** 2).sum() <= (w * (other - y) ** 2).sum() + 1e-9
    assert toxicity.isotonic(x[:0], y[:0], w[:0])(np.array([1.0])).tolist() == [0.0]


def test_boosting_lowers_the_loss():
    draw = np.random.default_rng(2)
    x = draw.random((600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    trees = toxicity.boost(x, y, np.ones(600))
    new = draw.random((600, 4))
    truth = (new[:, 0] > 0.5) ^ (new[:, 1] > 0.3)
    assert ((trees.margins(new) > 0) == truth).mean() > 0.95
    flat = toxicity.boost(x, np.zeros(600), np.ones(600))
    assert not flat.trees and len(set(flat.margins(new))) == 1


def drawn(n=600, seed=4):
    draw = random.Random(seed)
    words = [f"word{i}" for i in range(300)] + ["you", "the"]
    rows = []
    for i in range(n):
        toxic = i % 7 == 0
        text = [draw.choice(words) for _ in range(draw.randint(3, 60))]
        for _ in range(draw.randint(1, 4) if toxic else 0):
            text.insert(draw.randrange(len(text)), draw.choice(["idiot", "zorb" + draw.choice("abcdefgh") + draw.choice("xyz"), "Sc*m"]))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_learns_words_and_beginnings(spark, monkeypatch):
    rows = drawn()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, 7), (None, 1), (99_999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs.filter("doc_id % 3 != 0"), labels)
    assert "idiot" in model.lexicon and any(e.startswith("zorb") and e.endswith("*") for e in model.lexicon)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    wrong = sum(found[i].predicted != y for i, _, y in rows if i % 3 == 0)
    assert wrong <= 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    monkeypatch.setattr(toxicity, "SAMPLE_TEXTS", 60)
    monkeypatch.setattr(toxicity, "LABELLED_ROWS", 70)
    smaller = toxicity.train(docs, labels)
    assert smaller.lexicon.keys() >= {"idiot"} and sum(r.predicted for r in toxicity.score(docs, smaller).collect()) > 40


def test_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(1, 0), (3, 0)], none.schema), spark.createDataFrame([(6, 1), (7, 0), (4, 1)], none.schema)):
        model = toxicity.train(odd, labels)
        rows = toxicity.score(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (6, 7)}) == 1
        assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(empty, none).lexicon == {}


def test_held_out_rows_of_the_documents(spark, sf_dir):
    found = {r.doc_id: r for r in queries.QUERIES["op13_toxicity"](spark, sf_dir).collect()}
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())


def test_accuracy_at_ten_times_the_size(spark):
    folder = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in queries.QUERIES["op13_toxicity"](spark, folder).collect()}
    held = [(found[r.doc_id].score, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if found[r.doc_id].held_out]
    toxic, clean = ([s for s, y in held if y == k] for k in (1, 0))
    ahead = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert ahead > 0.98 and sum(s >= 0.3 for s in toxic) > 0.9 * len(toxic) and sum(s >= 0.3 for s in clean) < 0.01 * len(clean)
