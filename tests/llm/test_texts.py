"""Operators on single texts against brute force."""

import re
from collections import Counter
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import TEXTS
from tidemark.llm import language, packing, quality, sanitise

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute_repetition(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines))}
    for n in quality.LENGTHS:
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        times = Counter(grams)
        inside = {i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(n)}
        if n == 5:
            out["n_repeat_words"] = len(inside)
        if n in quality.DUPLICATE_LIMITS:
            out[f"dup_{n}_chars"] = sum(len(words[i]) for i in inside)
        if n in quality.TOP_LIMITS:
            out[f"top_{n}_chars"] = max((k * sum(map(len, g)) for g, k in times.items() if k >= quality.TOP_LEAST), default=0)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "bb", "cé", "\n", "d|", "a\nb"]), max_size=40).map(" ".join), min_size=1, max_size=4))
def test_repetition_counts(texts):
    found = quality.measure([t.encode() for t in texts])
    for i, t in enumerate(texts):
        for name, value in brute_repetition(t).items():
            assert found[name][i] == value, (name, t)


def test_unequal_windows_with_one_hash_are_told_apart():
    import numpy as np

    words, owner = np.array([1, 2, 3, 4, 1, 2]), np.zeros(6, np.int64)
    starts, group = quality._equal_windows(np.zeros(5, np.uint64), np.arange(5), words, owner, 2)
    assert sorted(Counter(group).values()) == [1, 1, 1, 2] and len(starts) == 5


def test_repetition_rows(odd, empty):
    found = {r.doc_id: r for r in quality.repetition(odd).collect()}
    assert quality.repetition(odd).count() == odd.count() and quality.repetition(empty).count() == 0
    for i, t in enumerate(TEXTS):
        want = brute_repetition(t)
        assert {k: found[i][k] for k in want} == want
    assert found[0].base_failed and not found[0].kept


def longest_matches(text, sample):
    """Phrases of the greedy parse by plain search."""
    at = n = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at, n = at + size, n + 1
    return n


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="abc ", min_size=1, max_size=60), st.text(alphabet="abcd ", min_size=1, max_size=90))
def test_phrases_are_longest_matches(sample, text):
    sample = language.plain(sample)
    if not sample:
        return
    parser = language.Parser({"x": sample})
    found, letters = parser.phrases([text, ""], parser.letter_classes())
    plain = re.sub(r" +", " ", text).lstrip(" ")
    assert letters[0] == sum(c != " " for c in text)
    if letters[0]:
        assert found[0][0] == longest_matches(plain, sample)
    assert found[1][0] == 0


def test_language_on_held_out_rows(spark, sf_dir):
    from tidemark.llm.queries import op5_language

    found = op5_language(spark, "/root/testdata/sf0.01").filter("held_out")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.join(docs, "doc_id").selectExpr("avg(int(lang = lang_pred)) as a", "min(score) as lo", "max(score) as hi").first()
    assert right.a > 0.97 and 0 <= right.lo <= right.hi <= 1


def test_language_rows(odd, empty):
    found = {r.doc_id: r for r in language.identify(odd, {"en": "same text here for two rows", "xx": "zürich straße"}).collect()}
    assert [found[i].lang_pred for i in (0, 1, 2, 8)] == ["und"] * 4 and found[8].score == 0
    assert found[6].lang_pred == "en"
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}
    assert language.identify(empty, {"en": "abc"}).count() == 0 and language.sample_texts(empty) == {}
    assert set(language.sample_texts(odd)) == {"en"}
    kept = language.keep_identified(odd, {"en": "abc"})
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == set(range(12)) - {0, 1, 2, 8} | {None}


def test_samples_of_copies_and_long_texts(spark):
    """Copies count once, and a language of long texts only has a sample."""
    rows = [("the copied text " * 40, "en")] * 3000 + [(f"another text of its own {'abcdefghij'[i % 10] * (i % 17 + 2)} {'klmnopqrst'[i // 10 % 10]}", "en") for i in range(100)]
    rows += [("1 " * 15_000 + "lange wörter hier " * 2000, "de"), ("1 " * 15_000, "xx")]
    found = language.sample_texts(spark.createDataFrame(rows, "text string, lang string"))
    assert set(found) == {"en", "de"} and len(found["de"]) <= language.SAMPLE_TEXT_CHARS and found["de"].startswith("lange wörter hier lange")
    assert found["en"].count("the copied text") == 40 and found["en"].count("another text of its own") == 100



def brute_base(text):
    """The four kinds by the plain patterns."""
    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0

    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub(r"[^0-9]", "", m)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"[^0-9]", "", m)) <= 15),
    }
    spans = [(m.start(), i, m.end(), k) for i, (k, (p, ok)) in enumerate(kinds.items()) for m in re.finditer(p, text or "") if ok(m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


PII = [
    "a.b@c.d_x@y.zz.q, me@x.org. @a.b x@y", "é\U0001f600 1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 49927398716 4012888888881881 5",
    "+1 (017) 555-7713 +44 20 7946 0958- +12 +123456789012345678", "card +4111111111111111 and 10.0.0.1@x.y", "a@b." + "c." * 3000 + "d", "x" * 50_000 + "@y.z", None, "",
]


def test_pattern_spans(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(PII)], "doc_id long, text string")
    found = {r.doc_id: r for r in sanitise.digest(sanitise.findings(rows)).collect()}
    for i, t in enumerate(PII):
        want = brute_base(t)
        assert found[i].spans == want and found[i].base_sha256 == sha256(want.encode()).hexdigest(), t
        assert found[i].n_email == want.count("email")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="a.@-+ 12(4", max_size=30), min_size=30, max_size=30))
def test_pattern_spans_of_any_text(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.s for r in rows.select("doc_id", sanitise.spelled(sanitise.base_spans(rows.text)).alias("s")).collect()}
    assert found == {i: brute_base(t) for i, t in enumerate(texts)}


def test_words_that_disclose_an_entity(spark):
    texts = [f"report {i}: Zorblatt wrote from z@corp.org about the budget" for i in range(4)]
    texts += [f"plain note {i} about the budget" for i in range(9)] + ["Zorblatt again, no address; zorblatts differ"]
    texts += [f"the budget of {c}@else.org" for c in "abcdef"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in sanitise.digest(sanitise.findings(rows)).collect()}
    assert "term:10:18" in found[0] and found[13].startswith("term:0:8") and "term" not in found[5] and "term" not in found[14]
    clean = {r.doc_id: r.text for r in sanitise.sanitised(rows).collect()}
    assert clean[0] == "[TERM] 0: [TERM] [TERM] [TERM] [EMAIL] about the budget" and clean[5] == texts[5]


def test_copies_are_one_witness(spark):
    rows = spark.createDataFrame([(i, "Zorblatt at z@corp.org") for i in range(9)], "doc_id long, text string")
    assert {r.n_terms for r in sanitise.digest(sanitise.findings(rows)).collect()} == {0}


def test_sanitise_rows(odd, empty):
    assert sanitise.findings(odd).count() == odd.count() and sanitise.findings(empty).count() == 0
    clean = sanitise.sanitised(odd)
    assert clean.columns == odd.columns and rows_of(clean) == rows_of(odd)


def whole_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(["Don't", "it's.", "<|endoftext|>", "a<|startoftext|>b", "İ", "é", "é", "x,", "12.", "ΑΣ", "\x1c", "\x85", "İi.", "日本"])).map(" ".join))
def test_word_by_word_ids(text):
    from pathlib import Path

    ids = whole_ids()
    encoder = test_word_by_word_ids.__dict__.setdefault("encoder", None) or packing.WordEncoder(Path(packing.TOKENIZER).read_text())
    test_word_by_word_ids.encoder = encoder
    import numpy as np

    assert np.frombuffer(encoder.encode([text.encode()])[0], encoder.dtype).tolist() == ids(text)


def test_packing_round_trip(odd, empty):
    import zlib

    import numpy as np

    ids = whole_ids()
    pieces = packing.packed(odd.repartition(3)).collect()
    assert packing.packed(empty).count() == 0
    for p in pieces:
        assert zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length
    by_doc = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        by_doc.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
    for i, t in enumerate(TEXTS):
        assert by_doc[i] == ids(t) * (2 if i == 7 else 1)
    ends = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert ends[p.sequence_id] == p.offset
        ends[p.sequence_id] += p.length
    assert all(ends[k] == 2048 for k in range(len(ends) - 1)) and ends[len(ends) - 1] <= 2048


def test_sequences_are_padded(spark):
    rows = spark.createDataFrame([(1, "a " * 3000), (2, "b")], "doc_id long, text string")
    found = sorted(packing.sequences(packing.packed(rows)).collect(), key=lambda r: r.sequence_id)
    assert [len(r.input_ids) for r in found] == [2048, 2048] and found[0].n_tokens == 2048 and found[1].doc_ids == [1, 2]
    eight = packing.sequences(packing.packed(spark.createDataFrame([(1, "a a a a a a a")], "doc_id long, text string"))).first()
    assert len(eight.input_ids) == 8 == eight.n_tokens
