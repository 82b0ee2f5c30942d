"""Whitening against the library's eigenvectors and exact integers."""

import math

import pytest

pytest.importorskip("plainweave.llm")

import numpy as np  # noqa: E402
from plainweave.llm import queries, whitening  # noqa: E402


def spectrum(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [5.0], [2, 1], [3, 3, 3], [0, 0, 0, 0], [4, 4, 1, 1, 0], list(range(40, 0, -1)), [1e8, 1, 1e-8], [2, 2, 2, 1, 1, 1, 1],
        [10**-k for k in range(20)], [1 + 1e-9 * k for k in range(12)], [7] + [0] * 30, [3, 2, 1] * 20, [100, *np.linspace(1, 1.001, 63)],
    ],
)
@pytest.mark.parametrize("wanted", [1, 3, 8, 64])
def test_components(values, wanted):
    v = spectrum(values)
    got, vectors = whitening.components(v, min(wanted, len(v)))
    expected = np.sort(np.linalg.eigvalsh(v))[::-1][:wanted]
    scale = max(np.linalg.norm(v), 1e-300)
    assert np.all(np.abs(got - expected) <= 1e-13 * scale)
    assert np.abs(v @ vectors - vectors * got).max() <= 1e-13 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() <= 1e-13


def test_polar():
    m = spectrum([5, 3, 1e-6, -1e-9, -2, -7])
    u = whitening.polar(m)
    e, q = np.linalg.eigh(m)
    assert np.abs(u - (q * np.sign(e)) @ q.T).max() < 1e-6 and np.abs(u @ u - np.eye(6)).max() < 1e-12
    m = spectrum([5, 3, 2, -1, -2, -7])
    e, q = np.linalg.eigh(m)
    assert np.abs(whitening.polar(m) - (q * np.sign(e)) @ q.T).max() < 1e-14


def plain(rows, wanted=8):
    """Per id: exact deviation, and whitened coordinates up to their sign."""
    whole = [(i, [math.floor(1024 * c) + 100000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(whole), len(whole[0][1])
    sums = [sum(x[k] for _, x in whole) for k in range(d)]
    away = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for _, x in whole])
    v = away.T @ away / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:wanted], q[:, ::-1][:, :wanted]
    w = away @ q / np.sqrt(e)
    return n, {i: (sum((n * c - s) ** 2 for c, s in zip(x, sums)), w[k]) for k, (i, x) in enumerate(whole)}, e / np.trace(v)


def check(found, rows):
    n, expected, shares = plain(rows)
    assert len(found) == len(expected) * len(shares) and {r["n"] for r in found} == {n}
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    signs = None
    for i, (deviation, w) in expected.items():
        got = np.array([by[i][k + 1]["whitened"] for k in range(len(w))])
        if signs is None or i == first:
            first = i
            signs = np.sign(got) * np.sign(w)
        assert {by[i][k + 1]["deviation"] for k in range(len(w))} == {deviation}
        assert np.abs(got * signs - w).max() < 1e-8
        assert np.allclose([by[i][k + 1]["explained"] for k in range(len(w))], shares, rtol=1e-9)
    (error,) = {r["identity_error"] for r in found}
    assert error < 1e-10


def test_given_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.op13_embedding_whitening(spark, sf).collect(), rows)


def test_odd_rows(spark, tmp_path):
    draw = np.random.default_rng(3)
    good = [(k, [float(c) for c in draw.normal(size=5) * [9, 5, 3, 2, 1]]) for k in range(60)]
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 0.0, 0.0]), (103, [nan] * 5), (104, [0.0, inf, 0.0, 0.0, 0.0]), (105, [-inf, 1.0, 1.0, 1.0, 1.0])]
    other = [(106, [1.0, 2.0]), (107, [1.0] * 9)]  # not of the commonest length
    repeated = [(7, good[7][1]), (None, good[8][1])]
    frame = spark.createDataFrame(good + odd + other + repeated, "vec_id long, embedding array<double>").repartition(4)
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op13_embedding_whitening(spark, str(tmp_path)).collect()
    n, expected, _ = plain(good + repeated)
    assert len(found) == 5 * 62 and {r["n"] for r in found} == {62}
    assert {r["vec_id"]: r["deviation"] for r in found} == {i: x[0] for i, x in expected.items()}
    assert max(r["identity_error"] for r in found) < 1e-10


def test_flat_and_few(spark):
    def coordinates(rows):
        frame = spark.createDataFrame(rows, "v array<float>, k int, n int, whitened int, i int, k0 int")
        return whitening.coordinates(frame, "v").collect()

    one = coordinates([([1.5, 2.5], 4, 0, 0, 5, 6)])
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in one] == [(1, 1, 0, None, None), (2, 1, 0, None, None)]
    assert {(r["k"], r["i"], r["k0"]) for r in one} == {(4, 5, 6)} and one[0]["identity_error"] is None
    line = coordinates([([float(k), 2.0 * k, 1.0], k, 0, 0, 0, 0) for k in range(10)])
    assert [r["whitened"] is None for r in line] == [False, True, True] * 10
    assert abs(line[0]["explained"] - 1) < 1e-12 and line[0]["identity_error"] < 1e-12
    assert coordinates([(None, 1, 1, 1, 1, 1)]) == []


def test_great_entries(spark):
    rows = [([3e30, 1.0], 1), ([-3e30, 2.0], 2), ([0.5, 4.0], 3)]
    made, values, _ = whitening.whiten(spark.createDataFrame(rows, "v array<float>, id int"), "v")
    top = (1 << 62) + 100000
    xs = [[top, 1024 + 100000], [-(1 << 62) + 100000, 2048 + 100000], [512 + 100000, 4096 + 100000]]
    sums = [sum(x[k] for x in xs) for k in range(2)]
    got = {r["id"]: r["deviation"] for r in made.collect()}
    exact = {k + 1: sum((3 * c - s) ** 2 for c, s in zip(x, sums)) for k, x in enumerate(xs)}
    assert {k: None if v >= 10**38 else v for k, v in exact.items()} == {k: None if v is None else int(v) for k, v in got.items()}
    assert np.all(np.isfinite(values))


def test_many_rows(spark):
    x = spark.range(20_000).select("id", F_list()).repartition(7)
    made, values, shares = whitening.whiten(x, "v", 3)
    rows = made.collect()
    w = np.array([r["whitened"] for r in rows])
    assert len(rows) == 20_000 and abs(np.cov(w.T, bias=True) - np.eye(3)).max() < 1e-9
    assert values[0] > values[1] > values[2] and 0 < sum(shares) <= 1


def F_list():
    from pyspark.sql import functions as F

    return F.array(*[(F.xxhash64("id", F.lit(k)) % 1000 / (1000.0 * (k + 1))) for k in range(6)]).alias("v")
