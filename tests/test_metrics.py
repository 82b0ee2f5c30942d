"""Alignments, corpus scores, packing and resampling against plain versions."""

import math
import random
from collections import Counter

import pytest
from plainweave import queries
from plainweave.operators import alignment, corpus, overlap, packing, resampling


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


@pytest.mark.parametrize(("block", "band"), [(8192, 64), (3, 0), (3, 2), (1, 0), (7, 64)])
def test_alignments_as_plain(monkeypatch, block, band):
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "BAND", band)
    draw = random.Random(block * 100 + band)
    for _ in range(1500):
        a = [draw.choice("abcd") for _ in range(draw.randint(0, 14))]
        b = [draw.choice("abcd") for _ in range(draw.randint(0, 14))]
        if draw.random() < 0.5:
            b = list(a)
            for _ in range(draw.randint(0, 3)):
                b.insert(draw.randint(0, len(b)), draw.choice("xy"))
        assert alignment.common_length(a, b) == common(a, b)
        assert alignment.distance(a, b) == edits(a, b)


def test_long_alignments():
    draw = random.Random(1)
    a = [str(draw.randrange(3000)) for _ in range(20_000)]
    near = list(a)
    for k in range(0, 20_000, 700):
        near[k] = "new"
    assert alignment.distance(a, near) == 29
    assert alignment.common_length(a, near) == 20_000 - 29
    far = a[10_000:] + a[:10_000]
    assert alignment.common_length(a, far) >= 10_000 and 0 < alignment.distance(a, far) <= 20_000


PAIRS = [
    (1, "the cat sat", "the cat sat on the mat"), (2, "The CAT", "a dog"), (3, "", "words here"), (4, "words", ""), (5, "", ""),
    (6, None, "x"), (7, "x", None), (8, "b a", "a b"), (8, "b a", "a b"), (9, "É é 日本 x_1", "é é x_1 日本"), (10, "w " * 5000, "w " * 4000 + "v"),
]


def test_rouge_on_odd_texts(spark):
    frame = spark.createDataFrame(PAIRS, "id int, prediction string, reference string").repartition(3)
    got = sorted((r["id"], r["rouge_l_precision"], r["rouge_l_recall"], r["rouge_l"]) for r in alignment.rouge_l(frame).collect())
    for i, p, r, f in got:
        a, b = next((a, b) for k, a, b in PAIRS if k == i)
        if a is None or b is None:
            assert (p, r, f) == (None, None, None)
            continue
        a, b = a.lower().split(), b.lower().split()
        n = common(a, b) if i != 10 else 4000
        assert (p, r, f) == pytest.approx((100 * n / len(a), 100 * n / len(b), 200 * n / (len(a) + len(b))) if n else (0, 0, 0))
    assert len(got) == len(PAIRS) and alignment.rouge_l(frame.limit(0)).count() == 0


def test_rouge_of_documents(spark, tmp_path):
    rows = [(k, " ".join(random.Random(k).choices("ab cd ef, gh. ij".split(), k=k % 50)), "en", "s", 0) for k in range(120)]
    spark.createDataFrame([*rows, (500, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    got = {r["doc_id"]: r for r in queries.rouge_l_documents(spark, str(tmp_path)).collect()}
    for i, t, *_ in rows:
        first = t.split(".")[0].replace(",", "").split()
        every = t.replace(",", "").replace(".", "").split()
        n = common(first, every)
        assert got[i]["rouge_l"] == pytest.approx(200 * n / (len(first) + len(every)) if n else 0, abs=1e-5)
    assert got[500]["rouge_l"] is None


def test_order_of_words_counts(spark):
    frame = spark.createDataFrame([(1, "a b c d", "d c b a"), (2, "a b c d", "a b c"), (3, "", ""), (4, "x", None)], "id int, prompt string, result string")
    got = {r["id"]: r["difference"] for r in corpus.difficulty_order(frame, ["id"], corpus.edit_difference).collect()}
    assert got == {1: 1.0, 2: 0.25, 3: 0.0, 4: None}


def grams(tokens, n):
    return Counter(tuple(tokens[k : k + n]) for k in range(len(tokens) - n + 1))


def plain_bleu(rows):
    c = r = 0
    match, total = [0] * 4, [0] * 4
    for p, refs in rows:
        p, refs = p.split(), [x.split() for x in refs]
        c += len(p)
        r += min((abs(len(x) - len(p)), len(x)) for x in refs)[1]
        for n in range(1, 5):
            mine, best = grams(p, n), Counter()
            for x in refs:
                best |= grams(x, n)
            match[n - 1] += sum((mine & best).values())
            total[n - 1] += sum(mine.values())
    if 0 in total:
        return 0.0
    zeros, logs = 0, 0.0
    for m, t in zip(match, total):
        zeros += m == 0
        logs += math.log(m / t if m else 1 / (2**zeros * t))
    return 100 * (math.exp(1 - r / c) if c < r else 1) * math.exp(logs / 4)


def plain_chrf(rows):
    def stats(p, ref):
        p, ref = "".join(p.split()), "".join(ref.split())
        return [(sum((grams(p, n) & grams(ref, n)).values()), max(0, len(p) - n + 1), max(0, len(ref) - n + 1)) for n in range(1, 7)]

    def score(three):
        both = [(m, h, r) for m, h, r in three if h and r]
        if not both:
            return 0.0
        p, r = sum(m / h for m, h, _ in both) / len(both), sum(m / r for m, _, r in both) / len(both)
        return 5 * p * r / (4 * p + r) if p + r else 0.0

    total = [(0, 0, 0)] * 6
    for p, refs in rows:
        best = max((stats(p, x) for x in refs), key=score)
        total = [tuple(a + b for a, b in zip(x, y)) for x, y in zip(total, best)]
    return 100 * score(total)


CORPUS = [
    ("a", "the cat sat on the mat", ["the cat sat on a mat", "a cat is on the mat here"]), ("a", "the the the the", ["the cat"]),
    ("a", "", ["the cat"]), ("a", "one two three four five", ["one two three four five"]), ("a", "the the the the", ["the cat"]),
    ("b", "x y z w", ["p q r s"]), ("b", "p x q", ["p q r s", ""]), ("c", "short", ["short"]), (None, "a b c d e", ["a b c d f"]),
    (None, "", [""]), ("b", None, ["x"]), ("b", "x", None), ("b", "x", []), ("b", "x", ["x", None]), ("d", None, ["x"]),
]


def test_corpus_scores_as_plain(spark):
    rows = [(k, *r) for k, r in enumerate(CORPUS)]
    frame = spark.createDataFrame(rows, "id int, g string, prediction string, references array<string>").repartition(3)
    whole = {}
    for g, p, refs in CORPUS:
        if p is not None and refs and None not in refs:
            whole.setdefault(g, []).append((p, refs))
    bleu = {r["g"]: r["bleu"] for r in overlap.bleu(frame, ["id"], ["g"]).collect()}
    chrf = {r["g"]: r["chrf"] for r in overlap.chrf(frame, ["id"], ["g"]).collect()}
    assert bleu == pytest.approx({g: plain_bleu(rs) for g, rs in whole.items()})
    assert chrf == pytest.approx({g: plain_chrf(rs) for g, rs in whole.items()})
    every = [x for rs in whole.values() for x in rs]
    assert overlap.bleu(frame, ["id"]).first()["bleu"] == pytest.approx(plain_bleu(every))
    assert overlap.chrf(frame, ["id"], partitions=2).first()["chrf"] == pytest.approx(plain_chrf(every))
    assert overlap.bleu(frame.limit(0), ["id"]).first()["bleu"] == 0 and overlap.bleu(frame.limit(0), ["id"], ["g"]).count() == 0


def plain_fit(lengths, size):
    blocks, out = [], [None] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        fitting = [(free, b) for b, free in enumerate(blocks) if free >= lengths[k]]
        if fitting and lengths[k] <= size:
            b = min(fitting)[1]
        else:
            b = len(blocks)
            blocks.append(size)
        blocks[b] -= lengths[k]
        out[k] = b
    return out


def test_best_fit_as_plain():
    draw = random.Random(4)
    for _ in range(400):
        size = draw.choice([1, 2, 7, 16, 50])
        lengths = [draw.randint(1, size + (draw.random() < 0.1)) for _ in range(draw.randint(0, 60))]
        assert packing.best_fit(lengths, size) == plain_fit(lengths, size)


def test_rows_are_packed_whole(spark):
    draw = random.Random(9)
    rows = [(k, [f"{k}.{j}" for j in range(draw.choice([0, 1, 3, 8, 13, 20, 25]))]) for k in range(230)] + [(900, None)]
    frame = spark.createDataFrame(rows, "id int, toks array<string>").repartition(5)
    packed = packing.pack_whole(frame, ["id"], "toks", 20, shard_rows=50).collect()
    full = [(k, t) for k, t in rows if t]
    for shard in range(-(-len(full) // 50)):
        part = full[50 * shard : 50 * shard + 50]
        expected = {}
        for (_, t), b in zip(part, plain_fit([len(t) for _, t in part], 20)):
            expected.setdefault(b, []).extend(t)
        got = {r["block"]: r["tokens"] for r in packed if r["shard"] == shard}
        assert got == expected
    assert all(r["n_tokens"] == len(r["tokens"]) and (r["n_tokens"] <= 20 or r["n_rows"] == 1) for r in packed)
    fills = packing.fill_rate(spark.createDataFrame(packed), 20).collect()
    assert sum(r["blocks"] for r in fills) == len(packed) and all(0.5 < r["fill"] <= 1 for r in fills)
    assert packing.pack_whole(frame.limit(0), ["id"], "toks", 20).count() == 0


def test_packed_queries(spark, sf):
    packed = queries.pack_whole(spark, sf).collect()
    rate = {r["shard"]: r for r in queries.pack_fill_rate(spark, sf).collect()}
    tokens = sum(r["n_tokens"] for r in packed)
    assert tokens == sum(len(r["tokens"]) for r in queries._conversations(spark, sf).collect())
    assert sum(r["blocks"] for r in rate.values()) == len(packed)


def test_resampling(spark):
    draw = random.Random(3)
    rows = []
    for k in range(400):
        base = draw.gauss(50, 10)
        rows += [("r", k, "good", base + 2 + draw.gauss(0, 1)), ("r", k, "fair", base + draw.gauss(0, 1)), ("r", k, "twin", base + 2 + draw.gauss(0, 8))]
    rows += [("r", 1000, "good", None), ("r", 1000, "fair", 1.0), ("r", 1001, "fair", 2.0), (None, 1, "a", 1.0), (None, 1, "b", 1.0), ("e", 1, "a", None)]
    scores = spark.createDataFrame(rows, "run string, id int, model string, sari double").repartition(3)
    got = {(r["run"], r["other"]): r for r in resampling.bootstrap(scores, ["id"], ["run"], replicates=300).collect()}
    best = got[("r", "fair")]["best"]
    fair = got[("r", "fair")]
    assert set(got) == {("r", "fair"), ("r", "twin" if best == "good" else "good"), (None, "b")}
    assert fair["rows"] == 400 and fair["ci_low"] < fair["difference"] < fair["ci_high"] and fair["not_ahead"] == 0
    # the interval of a mean of paired differences is that of the normal distribution
    scored = {(m, k): s for g, k, m, s in rows if g == "r"}
    d = [scored[(best, k)] - scored[("fair", k)] for k in range(400)]
    mean = sum(d) / 400
    half = 1.96 * (sum((x - mean) ** 2 for x in d) / 400) ** 0.5 / 20
    assert fair["difference"] == pytest.approx(mean) and (fair["ci_high"] - fair["ci_low"]) / 2 == pytest.approx(half, rel=0.2)
    assert got[(None, "b")]["difference"] == 0 and got[(None, "b")]["not_ahead"] == 1
    again = resampling.bootstrap(scores.repartition(7), ["id"], ["run"], replicates=300).collect()
    assert {(r["run"], r["other"]): round(r["ci_low"], 9) for r in again} == {k: round(r["ci_low"], 9) for k, r in got.items()}


def test_draws_are_spread_and_made_once(spark, monkeypatch):
    from plainweave.operators import resampling

    log = spark.range(400).selectExpr(
        "id div 2 AS k", "1 AS run_id", "if(id % 2 = 0, 'a', 'b') AS model", "cast(pmod(id * 37, 101) AS double) AS sari"
    )
    whole = resampling.bootstrap(log, ["k"], ["run_id"], replicates=20)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and "Repartition" in plan
    monkeypatch.setattr(resampling, "DRAWS", 100)
    spread = resampling.bootstrap(log, ["k"], ["run_id"], replicates=20)
    assert "Repartition 42" in spread._jdf.queryExecution().optimizedPlan().toString()
    one, other = whole.collect()[0].asDict(), spread.collect()[0].asDict()
    assert one["rows"] == other["rows"] == 200
    assert all(one[c] == pytest.approx(other[c]) if isinstance(one[c], float) else one[c] == other[c] for c in one)
    assert resampling.bootstrap(log.where("k < 0"), ["k"], ["run_id"], replicates=2).count() == 0


def test_unlike_texts_skip_the_diagonals(monkeypatch):
    looked = []
    few = alignment._few_edits
    monkeypatch.setattr(alignment, "_few_edits", lambda a, b, most: looked.append(most) or few(a, b, most))
    assert alignment.distance(list(range(100)), list(range(100, 190))) == 100
    assert not looked
    same = list(range(300))
    assert alignment.distance([*same, 7, *same], [*same, 8, *same]) == 1

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    draw = random.Random(5)
    for _ in range(200):
        a = [draw.randrange(6) for _ in range(draw.randrange(40))]
        b = [x for x in a if draw.random() < 0.8] if draw.random() < 0.5 else [draw.randrange(6) for _ in range(draw.randrange(40))]
        assert alignment.distance(a, b) == plain(a, b)


def test_compared_texts_are_spread(spark, monkeypatch):
    monkeypatch.setattr(corpus, "PART_BYTES", 200)
    frame = spark.range(200).selectExpr("id", "concat('a b ', id) AS prompt", "concat('a ', id) AS result").coalesce(1)
    seen = []
    monkeypatch.setattr(corpus, "stage", lambda df: seen.append(df.rdd.getNumPartitions()) or df)
    got = corpus.difficulty_order(frame, ["id"], corpus.edit_difference).collect()
    assert seen[0] > 8
    assert len(got) == 200 and {r["difference"] for r in got} == {1 / 3}
