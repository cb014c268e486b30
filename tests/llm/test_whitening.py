"""Whitening against numpy's own solver and whole-number arithmetic."""

import math

import numpy as np
import pytest

from tidemark.llm import queries, whitening

GOOD = [[0.5, -1.25, 3.0], [0.5, 2.5, 3.0], [-0.75, 0.0, 3.0], [0.5, -1.25, 3.0]]
ODD = [None, [], [None, 1.0, 2.0], [float("nan"), 0.0, 1.0], [math.inf, 0.0, 1.0], [1.0, 2.0]]


def brute(vectors):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    centred = (x * n - sums).astype(float) / n
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, values[::-1], columns[:, ::-1]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("spectrum", ["random", "equal", "falling", "two", "singular"])
def test_eigenpairs(n, spectrum):
    draw = np.random.default_rng(n)
    q = np.linalg.qr(draw.standard_normal((n, n)))[0]
    values = {
        "random": draw.random(n), "equal": np.ones(n), "falling": 10.0 ** -np.arange(n).clip(0, 14), "two": np.repeat([1.0, 2.0], [n // 2, n - n // 2]),
        "singular": np.r_[np.zeros(n // 2), draw.random(n - n // 2)],
    }[spectrum]
    a = (q * values) @ q.T
    found, vectors = whitening.eigenpairs(a)
    size = np.linalg.norm(a)
    assert np.abs(found - np.linalg.eigvalsh((a + a.T) / 2)[::-1]).max() <= 1e-14 * size
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13 and np.abs(a @ vectors - vectors * found).max() <= 1e-14 * size


def test_polar_is_the_sign_of_the_spectrum():
    draw = np.random.default_rng(1)
    q = np.linalg.qr(draw.standard_normal((20, 20)))[0]
    values = np.r_[10.0 ** -np.arange(10), -(10.0 ** -np.arange(10))]
    assert np.abs(whitening.polar((q * values) @ q.T) - (q * np.sign(values)) @ q.T).max() < 1e-6


def check(spark, rows, found):
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v) and len(v) == len(rows[0][1])]
    deviation, centred, values, columns = brute([v for _, v in usable])
    some = min(32, int((values > whitening.LEAST_SHARE * values[0]).sum()))
    assert len(found) == len(usable) * some
    by_key = {}
    for r in found:
        by_key.setdefault(r.vec_id, {})[r.component] = r
    assert set(by_key) == {i for i, _ in usable}
    for k in range(some):
        got = np.array([by_key[i][k + 1].whitened for i, _ in usable])
        want = centred @ columns[:, k] / np.sqrt(values[k])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6
    for (i, _), d in zip(usable, deviation, strict=True):
        r = by_key[i][1]
        assert int(r.deviation) == d and r.n == len(usable) and abs(r.explained - values[0] / values.sum()) < 1e-9 and r.identity_error < 1e-6


def test_whitening_on_the_embeddings(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = queries.QUERIES["op11_whitening"](spark, sf_dir)
    assert dict(found.dtypes)["deviation"] == "bigint"
    check(spark, rows, found.collect())


def test_odd_vectors(spark):
    rows = list(enumerate(GOOD)) + [(10 + i, v) for i, v in enumerate(ODD)]
    frame = spark.createDataFrame([(i, v, 1.0, 7) for i, v in rows], "vec_id long, embedding array<double>, vector double, n int")
    found = whitening.whiten(frame)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(spark, rows, found.collect())
    again = frame.unionAll(frame.filter("vec_id = 0"))
    assert whitening.whiten(again).filter("vec_id = 0 and component = 1").count() == 2


def test_no_usable_vectors(spark):
    for rows in ([], [(1, None), (2, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []


def test_whole_numbers_of_any_size_stay_exact(spark):
    rows = [(i, [c, -c / 3]) for i, c in enumerate([1e30, 2.0**33, 1e9, -1e9, 0.25, 7.0])]
    found = {r.vec_id: int(r.deviation) for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = [[min(max(math.floor(64 * c), -whitening.LARGEST), whitening.LARGEST) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert found == {i: sum((len(x) * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
