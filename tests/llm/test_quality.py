"""Estimates of the quality rules against plain ones that sort all rows."""

import pytest

pytest.importorskip("plainweave.llm")

import numpy as np  # noqa: E402
from plainweave.llm import quality as Q  # noqa: E402

SCHEMA = "g long, " + ", ".join(f"x{i} long" for i in range(Q.DIMS))


def steps(x, mean, scatter, share=Q.H, most=200):
    """Concentration on exactly the nearest rows, until they stay the same."""
    h, before = int(np.ceil(share * len(x))), None
    for _ in range(most):
        away = x - mean
        d = np.einsum("ij,jk,ik->i", away, np.linalg.inv(scatter), away)
        near = np.argsort(d, kind="stable")[:h]
        if before is not None and set(near) == before:
            break
        before = set(near)
        mean, scatter = x[near].mean(axis=0), Q.held(Q.consistency(share) * np.cov(x[near].T, bias=True))
    return mean, scatter


def plain(x, starts=40):
    """Least determinant over many random starts, then all rows within 0.975."""
    draw = np.random.default_rng(0)
    best = None
    for _ in range(starts):
        few = x[draw.choice(len(x), Q.DIMS + 1, replace=False)]
        mean, scatter = steps(x, few.mean(axis=0), Q.held(np.cov(few.T, bias=True)))
        det = np.linalg.det(scatter / Q.SCALE**2)
        if best is None or det < best[0]:
            best = (det, mean, scatter)
    det, mean, scatter = best
    away = x - mean
    d = np.einsum("ij,jk,ik->i", away, np.linalg.inv(scatter), away)
    good = x[d <= Q.chi2_quantile(0.975, Q.DIMS)]
    return det, good.mean(axis=0), Q.held(Q.consistency(0.975) * np.cov(good.T, bias=True))


def groups(seed=1):
    draw = np.random.default_rng(seed)
    mix = draw.normal(size=(5, 5)) * 600 + np.diag([2500, 1500, 1800, 2200, 900])
    clean = draw.normal(size=(900, 5)) @ mix + 4000
    tight = draw.normal(size=(180, 5)) * 300 + [20000, -15000, 9000, 0, 8000]
    spread = draw.normal(size=(60, 5)) * 30000
    flat = draw.normal(size=(300, 5)) * [2000, 900, 0, 40, 1500]
    few = draw.normal(size=(9, 5)) * 1000
    return {k: x.round() for k, x in enumerate([np.vstack([clean, tight, spread]), clean, flat, few, clean[:1], np.vstack([flat, tight[:60]])])}


def test_as_plain(spark):
    data = groups()
    rows = [(g, *map(int, r)) for g, x in data.items() for r in x]
    got = {r["g"]: r for r in Q.estimates(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert set(got) == set(data)
    for g in (0, 1, 2, 5):
        x = data[g]
        det, mean, scatter = plain(x)
        r = got[g]
        found = Q._square([r[c] for c in Q.SCATTER])
        assert r["n"] == len(x)
        assert np.all(np.abs(np.array([r[c] for c in Q.CENTRE]) - mean) <= 0.1 * np.sqrt(np.diag(scatter)))
        assert np.all(np.abs(np.diag(found) / np.diag(scatter) - 1) < 0.15)
        inverse = Q._square([r[c] for c in Q.INVERSE])
        assert np.allclose(inverse @ found, np.eye(5), atol=1e-6)
        limit = Q.chi2_quantile(Q.KEEP_QUANTILE, Q.DIMS)
        verdict = lambda m, i: np.einsum("ij,jk,ik->i", x - m, i, x - m) <= limit
        ours, theirs = verdict(np.array([r[c] for c in Q.CENTRE]), inverse), verdict(mean, np.linalg.inv(scatter))
        assert (ours != theirs).mean() < 0.01
    floor = np.array(Q.FLOOR) * Q.SCALE
    assert got[2]["v22"] == pytest.approx(floor[2] ** 2, rel=0.05) and got[2]["v33"] == pytest.approx(floor[3] ** 2, rel=0.05)
    assert got[2]["v00"] > 1.5 * floor[0] ** 2
    assert [got[4][c] for c in Q.CENTRE] == list(data[4][0])


def test_weighed_with_larger_groups(spark):
    draw = np.random.default_rng(5)
    square = lambda: (lambda a: a @ a.T + np.eye(5) * 1e6)(draw.normal(size=(5, 5)) * 2000)
    given = {k: (n, draw.normal(size=5) * 1000, square()) for k, n in (("a", 7), ("b", 400), ("c", 9000))}
    fields = {f"{k}_n": n for k, (n, _, _) in given.items()}
    for k, (_, m, v) in given.items():
        fields |= {f"{k}_c{i}": float(m[i]) for i in range(5)} | {f"{k}_v{i}{j}": float(v[i, j]) for i, j in Q.PAIRS}
    frame = spark.createDataFrame([("en", "web", *fields.values())], ["l", "s", *fields])
    (r,) = Q.shrunk(frame).collect()
    (na, ma, va), (nb, mb, vb), (_, mc, vc) = given.values()
    wa, wb = na**2 / (na**2 + Q.SHRINK**2), nb**2 / (nb**2 + Q.SHRINK**2)
    mean = wa * ma + (1 - wa) * (wb * mb + (1 - wb) * mc)
    scatter = Q.held(wa * va + (1 - wa) * (wb * vb + (1 - wb) * vc))
    assert np.allclose([r[c] for c in Q.CENTRE], mean)
    assert np.allclose(Q._square([r[c] for c in Q.INVERSE]) @ scatter, np.eye(5), atol=1e-6)


def test_sources_are_estimated_by_themselves(spark):
    """What is usual in one source is an outlier in another of its language."""
    draw = np.random.default_rng(2)
    word = lambda n: " ".join("".join(draw.choice(list("abcdefgh"), n)) for _ in range(int(draw.integers(60, 200))))
    rows = [(k, word(4), "en", "short") for k in range(300)] + [(1000 + k, word(30), "en", "long") for k in range(300)]
    rows += [(5000, word(30), "en", "short"), (5001, word(4), "en", "long"), (5002, word(4), "en", None), (5003, word(30), "de", "new")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    got = {r["doc_id"]: r for r in Q.judge(frame, keep_columns=["doc_id"]).collect()}
    assert not got[5000]["kept"] and not got[5001]["kept"]
    assert all(got[k]["kept"] for k in [*range(300), *range(1000, 1300)])
    assert len(got) == len(rows)


def test_free_memory_goes_back(monkeypatch):
    import pyarrow as pa
    from plainweave.llm import words as W

    given = []
    monkeypatch.setattr(W, "give_back", lambda: given.append(1), raising=False)
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 9, ""])], ["text"])
    found = [t for s in W.slices([batch, batch], "text", 4) for t in s.column("text").to_pylist()]
    assert found == 2 * ["ab", None, "c" * 9, ""] and given == [1]
