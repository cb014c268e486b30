"""Operators over whole corpora against brute force."""

import random
import time
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import TEXTS
from tests.llm.test_registered import same
from tests.llm.test_texts import rows_of
from tidemark.llm import common, decontaminate, html_extract, labelled_pages, lm_score, near, oracles, packing, passages, preference, queries


def shingles(text):
    words = (text or "").encode().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_links(texts):
    """Ids linked to each id, over an inverted index."""
    sets, holders = {i: shingles(t) for i, t in texts.items()}, defaultdict(set)
    for i, s in sets.items():
        for g in s:
            holders[g].add(i)
    links = {}
    for i, s in sets.items():
        common = Counter(j for g in s for j in holders[g] if j != i)
        links[i] = {j for j, n in common.items() if 9 * n >= 4 * (len(s) + len(sets[j]))}
    return links


def brute_classes(links):
    least = {i: i for i in links}
    while True:
        new = {i: min([least[i], *(least[j] for j in js)]) for i, js in links.items()}
        if new == least:
            return least
        least = new


def near_texts(n=260, seed=3):
    """Base texts with copies whose changed words bring them near the threshold from both sides."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    bases = [[draw.choice(words) for _ in range(draw.randint(5, 160))] for _ in range(12)]
    texts = {}
    for i in range(n):
        text = list(draw.choice(bases))
        for _ in range(draw.randint(0, 5)):
            text[draw.randrange(len(text))] = draw.choice(words)
        texts[i] = " ".join(text)
    return texts


def check_near(spark, texts):
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in near.jaccard_join(rows).collect()}
    links = brute_links(texts)
    classes = brute_classes(links)
    assert {i: found[i].n_links for i in texts} == {i: len(x) for i, x in links.items()}
    assert {i: found[i].class_id for i in texts} == classes


def test_near_links_and_classes(spark):
    check_near(spark, near_texts())


def test_near_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_TEXTS", 7)
    check_near(spark, near_texts(120, 4))


def test_near_on_the_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check_near(spark, {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})


def test_near_rows(odd, empty):
    found = {r.doc_id: r for r in near.jaccard_join(odd).collect()}
    assert near.jaccard_join(odd).count() == odd.count() and near.jaccard_join(empty).count() == 0
    assert [found[i].class_id for i in (0, 1, 2)] == [0, 1, 2] and found[0].n_links == 0
    assert found[6].class_id == found[7].class_id == 6 and found[6].copies == 3 and found[6].n_links == 2
    left = near.one_of_each(odd)
    assert left.columns == odd.columns and sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 5, 6, 8, 9, 10, 11]
    assert near.one_of_each(empty).count() == 0


def test_texts_of_few_words(spark):
    texts = [" ".join("abcdef"[:n]) for n in range(7)]
    for some in (*([t] for t in texts), [texts[1], texts[2]], [texts[2], texts[1]], texts, texts[::-1], [texts[3], "", texts[3]]):
        values, sizes = near.shingle_sets([t.encode() for t in some])
        assert sizes.tolist() == [len(shingles(t)) for t in some] and len(values) == sum(sizes)
        ends = np.cumsum(sizes)
        sets = [frozenset(values[e - n : e].tolist()) for e, n in zip(ends, sizes, strict=True)]
        assert all((sets[i] == sets[j]) == (shingles(a) == shingles(b)) for i, a in enumerate(some) for j, b in enumerate(some))
    one = near.jaccard_join(spark.createDataFrame([(5, "a b c")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.class_id, r.n_links) for r in one] == [(5, 5, 0)]
    check_near(spark, dict(enumerate(texts)))


def test_word_hashes(monkeypatch):
    draw = random.Random(3)
    monkeypatch.setattr(common, "CHUNK_BYTES", 64)
    texts = [b"", b" ", b"a", b"\x0b\x0c", b" lead", b"trail ", b"x" * 500] + [bytes(draw.choice(b"ab \t\n\x1f\x00\xc3\xa9") for _ in range(draw.randint(0, 90))) for _ in range(2000)]
    hashes, sizes = common.word_hashes(texts)
    assert sizes.tolist() == [len(t.split()) for t in texts]
    pairs = set(zip([w for t in texts for w in t.split()], hashes.tolist(), strict=True))
    assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})
    assert [len(x) for x in common.word_hashes([])] == [0, 0]


def test_prefix_depth_follows_the_target():
    depths = [near.depth_for(t) for t in (0.5, 0.99, 0.999, 1 - 1e-9)]
    assert depths == sorted(depths, reverse=True) and 1 - (1 - 0.8 ** near.depth_for()) ** near.TREES >= near.TARGET_RECALL


def test_components(spark):
    edges = [(str(i).encode(), str(i + 1).encode()) for i in range(100, 160)] + [(b"7", b"9"), (b"9", b"8")]
    found = dict(near.components(spark.createDataFrame(edges, "u binary, v binary")).collect())
    assert {bytes(v) for v in found.values()} == {b"100", b"7"} and len(found) == 64


def test_components_of_any_shape(spark):
    draw, labels = random.Random(8), list(range(1000, 1400))
    draw.shuffle(labels)
    pairs = [(labels[i], labels[draw.randrange(max(0, i - 9), i + 1)]) for i in range(1, 200)]  # long, with loops on itself
    pairs += [(labels[200], x) for x in labels[201:280]] + [(x, labels[300]) for x in labels[301:380]]  # a node with many ends
    pairs += [(a, b) for a in labels[380:390] for b in labels[380:390]] + pairs[:40]  # all pairs, repeats, both ways
    pairs += [(a, b) for a, b in zip(labels[390:399:2], labels[391:400:2], strict=True)]
    links = defaultdict(set)
    for a, b in pairs:
        links[a].add(b)
        links[b].add(a)
    links = {a: x - {a} for a, x in links.items() if x - {a}}
    rows = [(str(a).encode(), str(b).encode()) for a, b in pairs]
    found = near.components(spark.createDataFrame([*rows, (None, b"1"), (b"2", None)], "u binary, v binary")).collect()
    assert len(found) == len(links) and {int(n): int(x) for n, x in found} == brute_classes(links)


def test_components_that_are_found_take_no_step(spark, monkeypatch):
    tables, write = [], near.written
    monkeypatch.setattr(near, "written", lambda df, label: tables.append(label) or write(df, label))
    stars = [(f"{i}", f"0{i % 7}") for i in range(10, 90)]
    for rows, steps in (([], 0), (stars, 0), ([*stars, ("95", "15")], 1), ([*stars, ("06", "05"), ("05", "04")], 1), ([*stars, *((f"0{i + 1}", f"0{i}") for i in range(6))], 2)):
        tables.clear()
        found = dict(near.components(spark.createDataFrame(rows, "u string, v string")).collect())
        assert all(found[u] == found[v] <= v for u, v in rows) and len(tables) == 1 + 2 * steps


def test_near_writes_few_tables(spark, monkeypatch):
    """Each table costs a task for every shuffle partition, however few its rows."""
    tables, write = [], near.written
    monkeypatch.setattr(near, "written", lambda df, label: tables.append(label) or write(df, label))
    check_near(spark, near_texts())
    assert len(tables) <= 17


def brute_contamination(texts, items):
    import re

    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n and i is not None else 0):
            grams[tuple(w[k : k + n])].add(i)
    out = {}
    for i, t in texts:
        w, hit, found = split(t), set(), set()
        for n in range(1, 11):
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in grams:
                    hit |= set(range(k, k + n))
                    found |= grams[g]
        out[i] = (len(w), len(hit), sorted(found))
    return out


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and runs away at once"), (2, "short ITEM"), (3, "the lazy dog and runs away at once or not"), (4, None), (5, "..."), (None, "one"), (2, "short item"), (11, "东京 Straße")]
DOCS = [
    (0, "xx the QUICK brown, fox jumps over the lazy dog and runs away at once yy"), (1, "a short item here; short-item"), (2, "nothing of it"), (3, None), (4, ""), (5, "short"),
    (6, "the lazy dog and runs away at once or not short item 东京 straße the quick brown fox jumps over the lazy dog"),
]


@pytest.mark.parametrize("marks", [1 << 16, 1])
def test_contamination(spark, monkeypatch, marks):
    monkeypatch.setattr(decontaminate, "LEAST_MARKS", marks)
    monkeypatch.setattr(decontaminate, "MOST_MARKS", marks)
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in decontaminate.contamination(docs, items).collect()}
    assert found == brute_contamination(DOCS, ITEMS)
    assert sorted(r.doc_id for r in decontaminate.remove_documents(docs, items).collect()) == [2, 3, 4, 5]
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, items).collect()}
    assert cut[0] == "xx yy" and cut[1] == "a here" and cut[2] == "nothing of it" and cut[3] is None


def test_contamination_rows(odd, empty, spark):
    items = spark.createDataFrame([(1, "same text here for two rows")], "item_id long, text string")
    found = decontaminate.contamination(odd, items)
    assert found.count() == odd.count() and found.filter("contaminated").count() == 3
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(odd, items.filter("false")).filter("contaminated").count() == 0
    assert decontaminate.remove_documents(odd, items).columns == odd.columns == decontaminate.remove_spans(odd, items).columns


def brute_passages(texts):
    seen = Counter(tuple(w[k : k + 35]) for t in texts for w in [(t or "").encode().split()] for k in range(len(w) - 34))
    out = []
    for t in texts:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone |= set(range(k, k + 35))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), sha256(kept).hexdigest()))
    return out


def passage_texts(seed=1):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(900)]
    some = lambda n: [draw.choice(words) for _ in range(n)]
    shared = [some(n) for n in (34, 35, 36, 80, 200)]
    texts = [" ".join(some(draw.randint(0, 60)) + draw.choice(shared) + some(draw.randint(0, 60)) + draw.choice(shared)[draw.randint(0, 30) :]) for _ in range(60)]
    return [*texts, "is on " * 60, "x " * 34, "x " * 35, "y " * 36, None, "", " ".join(shared[4]), texts[0]]


@pytest.mark.parametrize("hot, shard", [(1000, 200_000), (2, 200), (10, 2000)])
def test_passages(spark, monkeypatch, hot, shard):
    monkeypatch.setattr(passages, "HOT_STRETCHES", hot)
    monkeypatch.setattr(passages, "SHARD_WORDS", shard)
    texts = passage_texts(hot)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted(passages.without_repeats(rows).collect())
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in found] == brute_passages(texts)


def test_a_window_in_many_surroundings_is_searched_twice(spark, monkeypatch):
    """What a shard gets of one window does not grow with the texts that hold it."""
    monkeypatch.setattr(passages, "HOT_STRETCHES", 5)
    search = passages._search

    def counted(batches):
        seen = Counter()

        def told():
            for batch in batches:
                seen.update(batch.column("route").to_pylist())
                assert max(seen.values(), default=0) <= 5, "places of one window in one shard"
                yield batch

        yield from search(told())

    monkeypatch.setattr(passages, "_search", counted)
    shared = " ".join(f"s{i}" for i in range(45))
    texts = [" ".join([*(f"a{i}x{j}" for j in range(40)), shared, *(f"b{i}x{j}" for j in range(40))]) for i in range(150)]
    texts += [texts[0], shared, shared + " " + shared, "z " * 40, None]
    found = sorted(passages.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in found] == brute_passages(texts)


def test_fm_index_counts_matches():
    draw = np.random.default_rng(2)
    words = np.concatenate([draw.integers(1, 5, 300), [0]])
    index = passages.FMIndex(words)
    text = words.tolist()
    for size in (1, 2, 3, 5):
        for _ in range(40):
            pattern = draw.integers(1, 5, size)
            low, high = np.array([0]), np.array([len(words)])
            for w in pattern[::-1]:
                low, high = index.extend(low, high, np.array([w]))
            assert max(0, high[0] - low[0]) == sum(text[i : i + size] == pattern.tolist() for i in range(300 - size + 1))


def test_passage_rows(odd, empty):
    found = passages.without_repeats(odd)
    assert found.count() == odd.count() and passages.without_repeats(empty).count() == 0
    texts = [r.text for r in odd.collect()]
    assert sorted((r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()) == sorted(brute_passages(texts))


def test_blocks_of_a_page():
    page = "<!-- x --><p>a&amp;b <i>c</i>\n d<br>e<p>f<script>if (a<b) '</p>'</script><ul><li>g<li>h</ul><style>p{}</style><a href='>'>i</a> 1 < 2 <div>j"
    assert [b.text for b in html_extract.read_blocks(page)] == ["a&b c d e", "f", "g", "h", "i 1 < 2", "j"]
    assert html_extract.read_blocks("") == [] and html_extract.read_blocks("<p") [0].text == "<p"
    assert html_extract.read_blocks("<div title='x>y' class=ad>t</div>")[0].names == {"ad"}


def test_nothing_behind_an_element_is_lost():
    texts = lambda page: [b.text for b in html_extract.read_blocks(page)]
    assert texts('<p>a<svg viewBox="0 0 1 1"/>b<p>c<math/>d<object data=x />e<p>f<svg width=3/>g') == ["ab", "cde", "fg"]
    assert texts("<p>x <math><mi>y</mi></math> z<object><p>inside</object><p>behind") == ["x y z", "inside", "behind"]
    assert texts("<svg><style/><path d='m'/><title/>t</svg><p>u<script>no</script><p>v") == ["t", "u", "v"]
    deep = html_extract.read_blocks("<div class=ad>" + "<i>" * 600 + "<nav><p>n</p></nav><footer>f</footer><div>x</div>y</div>z")
    assert [b.text for b in deep] == ["n", "f", "x", "y", "z"]
    assert [("nav" in b.tags, "footer" in b.tags, "ad" in b.names) for b in deep] == [(True, False, True), (False, True, True), (False, False, True), (False, False, True), (False, False, False)]


def test_pages_that_do_not_end_well():
    texts = lambda page: [b.text for b in html_extract.read_blocks(page)]
    assert texts("<p>İ</p><SCRIPT>x</SCRIPT><p>after</p>") == ["İ", "after"] and texts("<p>ſ<Style>x</STYLE>k<p>K") == ["ſk", "K"]
    assert texts("<p>a<!-- x") == ["a"] and texts("<p>a</p><!-- x <p>b</p>") == ["a"] and texts("<p>a <!-- c --> b > c <!-- d") == ["a b > c"]
    assert texts("a < b <c") == ["a < b <c"] and texts("<p title='x>y'>z</p>") == ["z"] and texts("<p title='x>y</p><p>q</p>") == ["y", "q"]
    for odd in ("<a ", "<p a='", "<p a=\"", "<a '>", "<!-- ", "<![", "</a"):
        for end in ("", ">", "'"):
            start = time.monotonic()
            texts(odd * (1_000_000 // len(odd)) + end)
            assert time.monotonic() - start < 10


def test_field_on_other_pages():
    field = html_extract.default_field()
    pages = labelled_pages.pages()
    right = [b.main == k for p in pages for b, k in zip(html_extract.read_blocks(p), field.decode(html_extract.features(html_extract.read_blocks(p))), strict=True)]
    assert np.mean(right) > 0.99
    other = [x for i, x in enumerate(pages) if i % 4]  # trained without every fourth page
    left = [x for i, x in enumerate(pages) if not i % 4]
    field = html_extract.train(other)
    right = [b.main == k for p in left for b, k in zip(html_extract.read_blocks(p), field.decode(html_extract.features(html_extract.read_blocks(p))), strict=True)]
    assert np.mean(right) > 0.97


def test_viterbi_is_the_best_labelling():
    from itertools import product

    field = html_extract.Field({"a": 0.7, "b": -0.4, "c": -1.1}, np.array([0.1, -0.2]), np.array([[0.5, -0.3], [-0.6, 0.8]]))
    rows = [["a"], ["b"], ["a", "c"], ["b"], ["a"]]

    def score(labels):
        total = field.start[labels[0]] + sum(sum(field.emit[f] for f in r) for r, y in zip(rows, labels) if y)
        return total + sum(field.step[x][y] for x, y in zip(labels, labels[1:]))

    assert field.decode(rows) == [bool(y) for y in max(product((0, 1), repeat=5), key=score)]


def test_main_text_of_the_pages(spark, sf_dir):
    """What the article element holds, by plain cutting."""
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = {r.page_id: r for r in queries.op3_html(spark, sf_dir).collect()}
    assert len(found) == len(pages)
    for i, page in pages.items():
        body = re.search(r"<article>(.*)</article>", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1|div|ul|li)\b[^>]*>", body)]
        assert found[i].text == "\n".join(b for b in blocks if b) and found[i].n_chars == len(found[i].text)


def test_page_rows(spark):
    pages = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "<p>" * 3000 + "x y z", 1), (3, "<b>", 2), (4, "&#0;&bogus;<p>&lt;p&gt;", 2)], "page_id long, html string, text long")
    found = html_extract.extract(pages)
    assert found.columns == ["page_id", "text", "n_chars", "n_blocks"] and found.count() == 5 and found.filter("text is null").count() == 0
    assert html_extract.extract(pages.filter("false")).count() == 0


def test_losses_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b a b c"), (2, "a b"), (3, "d e f a"), (4, None), (5, " "), (1, "a b a b c")], "doc_id long, text string")
    found = lm_score.cross_entropy_difference(docs, spark.createDataFrame([(1,), (1,), (None,)], "i long")).collect()
    texts, target = [["a", "b", "a", "b", "c"], ["a", "b"], ["d", "e", "f", "a"], [], [], ["a", "b", "a", "b", "c"]], {0, 5}
    number = lambda w: int(lm_score.word_keys([w.encode()])[0])
    vocabulary = 1 << lm_score.WORD_BITS - 1

    def model(rows):
        word, context, pair = Counter(), Counter(), Counter()
        for r in rows:
            for a, b in zip([None, *r], r):
                word[number(b)] += 1
                context[a and number(a)] += 1
                pair[a, b] += 1
        return word, context, pair

    def loss(row, rows, weight):
        word, context, pair = model(rows)
        total = sum(word.values())
        out = []
        for a, b in zip([None, *row], row):
            alone = (word[number(b)] * weight + 1) / (total * weight + vocabulary)
            around = context[a and number(a)] * weight
            out.append(-np.log((pair[a, b] * weight + lm_score.PRIOR * alone) / (around + lm_score.PRIOR)))
        return np.mean(out)

    sizes = [sum(map(len, texts)), sum(len(texts[i]) for i in target)]
    want = []
    for i, row in enumerate(texts):
        if row:
            back = loss(row, [r for j, r in enumerate(texts) if j != i], min(sizes) / sizes[0])
            goal = loss(row, [r for j, r in enumerate(texts) if j in target and j != i], min(sizes) / sizes[1])
            want.append((len(row), goal, back))
    got = sorted((r.n_tokens, r.target_loss, r.background_loss) for r in found if r.n_tokens)
    assert np.allclose(got, sorted(want), rtol=1e-5)
    assert sum(r.score is None for r in found) == 2


def test_scores_tell_good_from_bad(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = queries.op6_lm_score(spark, "/root/testdata/sf0.01").join(labels, "doc_id").toPandas()
    good, bad = (found[found.quality == q].score.to_numpy() for q in (1, 0))
    assert (good[:, None] < bad[None]).mean() > 0.6


def test_models_grow_with_the_corpus(spark, monkeypatch):
    """More words than any fixed number of classes, in many blocks, against counts of the words themselves."""
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 50_000)
    rng = np.random.default_rng(5)
    texts = [" ".join(["the same start", *(f"w{x}" for x in rng.integers(0, 60_000, 400)), "of the end"]) for _ in range(400)]
    target = set(range(0, 400, 3))
    found = lm_score.cross_entropy_difference(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), spark.createDataFrame([(i,) for i in target], "i long")
    ).toPandas().set_index("doc_id")
    counts = [[Counter(), Counter(), Counter()] for _ in range(2)]
    rows = [list(zip([None, *t.split()], t.split())) for t in texts]
    for i, row in enumerate(rows):
        for model in counts[: 1 + (i in target)]:
            for table, keys in zip(model, ([b for _, b in row], [a for a, _ in row], row)):
                table.update(keys)
    total, vocabulary = [sum(m[0].values()) for m in counts], len(counts[0][0])
    assert vocabulary > 1 << lm_score.WORD_BITS - 1
    for i, row in enumerate(rows[:40]):
        own = [Counter(b for _, b in row), Counter(a for a, _ in row), Counter(row)]
        want = []
        for k in range(2):
            part, weight = int(k == 0 or i in target), min(total) / total[k]
            word, around, pair = (lambda key, t=t, o=o: (t[key] - part * o[key]) * weight for t, o in zip(counts[k], own))
            alone = [(word(b) + 1) / ((total[k] - part * len(row)) * weight + vocabulary) for _, b in row]
            want.append(np.mean([-np.log((pair((a, b)) + lm_score.PRIOR * p) / (around(a) + lm_score.PRIOR)) for (a, b), p in zip(row, alone)]))
        assert np.allclose([found.background_loss[i], found.target_loss[i]], want, rtol=1e-9)


def test_lm_rows(odd, empty, spark):
    ids = spark.createDataFrame([(6,)], "i long")
    assert lm_score.cross_entropy_difference(odd, ids).count() == odd.count()
    assert lm_score.cross_entropy_difference(empty, ids).count() == 0
    assert lm_score.cross_entropy_difference(odd, ids.filter("false")).count() == odd.count()


def test_preference_pairs(spark):
    turns = [
        (1, "chosen", 0, "user", "hi"), (1, "chosen", 1, "assistant", "yes"), (1, "rejected", 0, "user", "hi"), (1, "rejected", 1, "assistant", "no\U0001f600"), (1, "rejected", 2, "user", "?"),
        (2, "chosen", 0, "user", "a"), (2, "rejected", 0, "user", "a"), (3, "chosen", None, None, None), (4, "chosen", 0, "assistant", "<|im_end|>"), (4, "rejected", 0, "user", "<|im_end|>"),
    ]
    found = {r.pair_id: r for r in preference.preference_pairs(spark.createDataFrame(turns, "pair_id long, side string, turn long, role string, text string")).collect()}
    one = found[1]
    assert one.n_prompt_turns == 1 and one.prompt == "<|im_start|>user\nhi<|im_end|>\n" and one.usable
    assert [one.chosen[s.start : s.end] for s in one.chosen_spans] == ["yes<|im_end|>"] and [one.rejected[s.start : s.end] for s in one.rejected_spans] == ["no\U0001f600<|im_end|>"]
    assert found[2].n_prompt_turns == 1 and found[2].chosen == "" and not found[2].usable
    assert found[3].n_prompt_turns == 0 and found[3].chosen == "<|im_start|>\n<|im_end|>\n" and found[3].rejected == "" and not found[3].usable
    assert found[4].n_prompt_turns == 0 and found[4].chosen.count("<|im_end|>") == 1


def test_replaced_answers(spark):
    turns = [
        (0, 0, "user", "q"), (0, 1, "assistant", "x"), (0, 2, "user", "later"), (0, None, "system", "first"), (1, 0, "assistant", "y"),
        (2, 0, "assistant", "alone"), (3, 0, "user", "no answer"), (4, 1, "user", "u"), (4, 2, "assistant", None), (5, 0, "user", "only"),
        (None, 0, "user", "n"), (None, 1, "assistant", "a"), (-2, None, "assistant", "m"), (-1, 0, None, "r"), (-1, 1, "assistant", "m2"),
    ]
    rows = spark.createDataFrame([(*t, "pick", 1) for t in turns], "conv_id long, turn long, role string, text string, side string, last_turn int")
    found = {r.pair_id: r for r in preference.preference_pairs(preference.replaced_answers(rows)).collect()}
    assert set(found) == {0, 1, 2, 3, 4, 5, None, -1, -2}  # every conversation has a row
    assert [(i, found[i].n_prompt_turns, found[i].usable) for i in (0, 1, 2, 3, 4, 5, None, -1, -2)] == [
        (0, 2, True), (1, 0, True), (2, 0, False), (3, 1, False), (4, 1, False), (5, 1, False), (None, 1, False), (-1, 1, True), (-2, 0, True),
    ]
    assert "y" in found[0].rejected and "x" in found[0].chosen and found[0].prompt.startswith("<|im_start|>system\nfirst") and "later" not in found[0].chosen
    assert "alone" in found[2].chosen and found[2].rejected == "" and found[3].chosen == found[3].rejected == "" and "no answer" in found[3].prompt
    con = duckdb.connect()
    con.register("conversations", rows.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    pairs = preference.preference_pairs(preference.replaced_answers(rows)).withColumnRenamed("pair_id", "conv_id")
    same(pairs.withColumns({c: preference.spans_text(F.col(c)) for c in ("chosen_spans", "rejected_spans")}), con, oracles.SQL["op8_preference"])
    assert preference.preference_pairs(preference.replaced_answers(rows.filter("false"))).count() == 0


def test_every_conversation_has_a_row(spark):
    folder = "/root/testdata/sf0.1"
    assert queries.QUERIES["op8_preference"](spark, folder).count() == spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id").distinct().count()


def test_native_operators_run_no_python(spark, sf_dir, capsys):
    for name in ("op4_decontaminate", "op8_preference", "op10_pii"):
        queries.QUERIES[name](spark, sf_dir).explain()
        plan = capsys.readouterr().out
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_only_read_columns_reach_the_scan(spark, sf_dir, capsys):
    queries.op1_quality(spark, sf_dir).explain()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in capsys.readouterr().out


def test_pipeline(spark, sf_dir):
    """Every stage against brute force on its own input, then run() against the stages."""
    import corpus_pipeline
    from tidemark.session import written

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(written(stage(spark, steps[-1], sf_dir), name))
    texts = [{r.doc_id: r.text for r in s.select("doc_id", "text").collect()} for s in steps[:-1]]
    assert all(s.columns == docs.columns for s in steps[:-1])
    assert set(texts[1]) == {i for i, t in texts[0].items() if any(c.isalpha() for c in t or "")}
    assert set(texts[2]) == set(brute_classes(brute_links(texts[1])).values())
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(texts[3]) == {i for i, (_, n, _) in brute_contamination(texts[2].items(), items).items() if not n}
    assert set(texts[4]) == set(texts[3]) and sum(texts[4][i] != texts[3][i] for i in texts[4]) > 0
    lengths = {r.doc_id: r.n for r in steps[5].groupBy("doc_id").sum("length").withColumnRenamed("sum(length)", "n").collect()}
    assert lengths == {r.doc_id: r.doc_tokens for r in packing.tokenized(steps[4]).collect()}
    assert rows_of(corpus_pipeline.run(spark, sf_dir)) == rows_of(steps[5])


def test_pipeline_stages_take_odd_rows(odd, empty, spark, sf_dir):
    import corpus_pipeline

    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
        docs.collect()


def test_pieces_of_texts():
    from tidemark.llm.common import chunks

    assert list(chunks([b"", b"abc", b"d", b"e" * 9, b""], 4)) == [(0, 3), (3, 4), (4, 5)] and list(chunks([])) == [] and len(TEXTS) == 12
