import random
from collections import Counter

import pytest
from plainweave.operators.sari import metric, sari
from pyspark.sql import functions as F


def plain_sari(source, prediction, references):
    """SARI from its definition, on white-space tokens."""
    keep = delete = add = 0.0

    def grams(t, n):
        words = t.split(" ")
        return Counter(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))

    def f1(p, r):
        return 2 * p * r / (p + r) if p + r else 0.0

    def share(a, b):
        return a / b if b else 1.0

    for n in (1, 2, 3, 4):
        times = len(references)
        s = Counter({g: c * times for g, c in grams(source, n).items()})
        c = Counter({g: k * times for g, k in grams(prediction, n).items()})
        r = sum((grams(x, n) for x in references), Counter())
        kept, keepable = s & c, s & r
        good = kept & r
        keep += f1(
            share(sum(good[g] / kept[g] for g in good), len(kept)),
            share(sum(good.values()), sum(keepable.values())),
        )
        gone = s - c
        rightly = gone - r
        delete += share(sum(rightly[g] / gone[g] for g in rightly), len(gone))
        new, addable = set(c) - set(s), set(r) - set(s)
        add += f1(share(len(new & set(r)), len(new)), share(len(new & set(r)), len(addable)))
    return 100 * (keep + delete + add) / 12


def score(spark, rows, partitions=None):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "id long, source string, prediction string, references array<string>",
    )
    out = sari(df, ["id"], partitions=partitions).collect()
    assert len(out) == len(rows)
    return [r["sari"] for r in sorted(out, key=lambda r: r["id"])]


CASES = [
    ("a b c d e", "a b c", ["a b c"]),  # prediction = reference
    ("a b c d e", "a b c d e", ["a b x"]),  # prediction = source
    ("a b c d e", "", ["a b"]),  # nothing predicted
    ("", "", [""]),
    ("a", "a", ["a"]),
    ("a b", "b", ["c"]),
    ("a a a b", "a a", ["a a b b a"]),  # repeated grams
    ("a b c d", "a c", ["a b", "a c d"]),  # two references
    ("a b", "c d", ["e f"]),  # nothing shared
]


def test_cases(spark):
    got = score(spark, CASES)
    assert got == pytest.approx([plain_sari(*c) for c in CASES], abs=1e-9)
    assert got[0] == got[4] == 100.0


def test_random_texts(spark):
    rng = random.Random(3)

    def some(most):
        return " ".join(rng.choices("abcde", k=rng.randint(1, most)))

    rows = [(some(12), some(8), [some(8) for _ in range(rng.randint(1, 3))]) for _ in range(300)]
    expected = [plain_sari(*r) for r in rows]
    assert score(spark, rows) == pytest.approx(expected, abs=1e-9)
    assert score(spark, rows, 1) == pytest.approx(expected, abs=1e-9)


def test_one_shuffle_of_texts_only(spark):
    df = spark.range(10).select(
        "id", F.lit("a b").alias("source"), F.lit("a").alias("prediction"),
        F.array(F.lit("a")).alias("references"),
    )
    plan = sari(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_metric_by_name():
    assert metric("sari") is sari
    with pytest.raises(KeyError):
        metric("other")


def test_incomplete_rows_have_null_scores(spark):
    from plainweave.operators.corpus import drop_duplicates
    from plainweave.operators.sari import sari

    rows = [
        (1, "a b c", "a b", ["a b"]), (2, None, "a", ["a"]), (3, "a", None, ["a"]), (4, "a", "a", []),
        (5, "a", "a", None), (6, "a", "a", ["a", None]), (7, "", "", [""]),
    ]
    schema = "k int, source string, prediction string, references array<string>"
    got = {r["k"]: r["sari"] for r in sari(spark.createDataFrame(rows, schema), ["k"]).collect()}
    assert {k for k, v in got.items() if v is None} == {2, 3, 4, 5, 6}
    assert got[1] == 100 and got[7] is not None
    pairs = spark.createDataFrame([(2, 1, "x"), (1, 5, "x"), (1, 4, "x"), (9, 9, "y")], "a int, b int, t string")
    kept = drop_duplicates(pairs, ["t"], ["a", "b"]).collect()
    assert sorted((r["a"], r["b"]) for r in kept) == [(1, 4), (9, 9)]


def test_equal_texts_are_cut_once(spark):
    from plainweave.operators.sari import ngram_counts

    rows = [(1, "a b", "a b", ["a b", "c", "a b"]), (2, "a", "b", ["a"]), (3, "", "", [""]), (4, "a a", "b", ["c", "b"])]
    df = spark.createDataFrame(rows, "id int, source string, prediction string, references array<string>")
    counts = ngram_counts(df, ["id"], "source", "prediction", "references")
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" in plan
    got = {(r["id"], r["gram"]): (r["s"], r["c"], r["r"]) for r in counts.collect()}
    assert got == {
        (1, "a"): (3, 3, 2), (1, "b"): (3, 3, 2), (1, "a b"): (3, 3, 2), (1, "c"): (0, 0, 1),
        (2, "a"): (1, 0, 1), (2, "b"): (0, 1, 0), (3, ""): (1, 1, 1),
        (4, "a"): (4, 0, 0), (4, "a a"): (2, 0, 0), (4, "b"): (0, 2, 1), (4, "c"): (0, 0, 1),
    }
