import random

import pytest
from plainweave.functions.hashing import uniform
from plainweave.functions.text import tokens
from plainweave.operators import mixing
from plainweave.plans.prepare import mix_training, prepare_corpus
from pyspark.sql import functions as F


def sources(spark, *sizes):
    parts, rows = [], None
    for s, n in enumerate(sizes):
        part = spark.range(n).select((F.col("id") + s * 10_000).alias("id"), F.col("id").alias("position"))
        parts.append(part)
        one = part.select("id", F.lit(s).alias("source"))
        rows = one if rows is None else rows.unionByName(one)
    return rows, parts


def plain_interleave(spark, sizes, probabilities, seed, most=200_000):
    draws = spark.range(most).select(F.col("id").alias("row_id")).select(
        "row_id", uniform(seed, "interleave", ["row_id"]).alias("u")
    ).orderBy("row_id").toPandas()["u"]
    at, done, out = [0] * len(sizes), [False] * len(sizes), []
    for u in draws:
        if all(done):
            return out
        s = next((i for i in range(len(sizes) - 1) if u < sum(probabilities[: i + 1])), len(sizes) - 1)
        out.append(s * 10_000 + at[s])
        at[s] += 1
        if at[s] >= sizes[s]:
            done[s], at[s] = True, 0
    raise AssertionError("not exhausted")


@pytest.mark.parametrize(
    "sizes,probabilities",
    [((70, 30), [0.7, 0.3]), ((5, 200), [0.5, 0.5]), ((40, 3, 20), [0.2, 0.3, 0.5]), ((1, 1), [0.9, 0.1])],
)
def test_interleave(spark, sizes, probabilities):
    rows, parts = sources(spark, *sizes)
    for n in (1, 17):
        got = mixing.interleave(rows.repartition(n), parts, ["id"], probabilities, 42)
        ids = [r["id"] for r in got.orderBy("row_id").collect()]
        assert ids == plain_interleave(spark, sizes, probabilities, 42)


def test_source_repeated_very_often_is_copied(spark, monkeypatch):
    monkeypatch.setattr(mixing, "REPEATS_PER_COPY", 10)
    monkeypatch.setattr(mixing, "MIN_BLOCK", 64)
    rows, parts = sources(spark, 2, 500)
    got = mixing.interleave(rows, parts, ["id"], [0.5, 0.5], 3)
    ids = [r["id"] for r in got.orderBy("row_id").collect()]
    assert ids == plain_interleave(spark, (2, 500), [0.5, 0.5], 3)


def test_rarely_drawn_source_extends_the_draws(spark, monkeypatch):
    # the first guess of positions is too short for the draws that fall out
    monkeypatch.setattr(mixing.math, "ceil", lambda x: max(1, int(x) // 8))
    rows, parts = sources(spark, 900, 900)
    got = mixing.interleave(rows, parts, ["id"], [0.5, 0.5], 42)
    monkeypatch.undo()
    ids = [r["id"] for r in got.orderBy("row_id").collect()]
    assert ids == plain_interleave(spark, (900, 900), [0.5, 0.5], 42)


def test_empty_source(spark):
    rows, parts = sources(spark, 3, 0)
    with pytest.raises(ValueError):
        mixing.interleave(rows, parts, ["id"], [0.5, 0.5])


def test_training_mix_has_every_row(spark):
    df = spark.range(200).withColumn("text", F.lit("t"))
    got = mix_training(df, ["id"], ["id"]).orderBy("row_id").collect()
    assert [r["row_id"] for r in got] == list(range(len(got)))
    assert {r["id"] for r in got} == set(range(200))
    ordered = [r["id"] for r in got if r["part"] == "ordered"][:140]
    assert ordered == sorted(ordered)


def test_prepared_corpus(spark):
    split = F.when(F.col("id") < 60, "train").when(F.col("id") < 80, "val").otherwise("test")
    df = spark.range(90).select(
        "id", F.lit("p").alias("prompt"),
        F.when(F.col("id") != 5, "r").alias("result"), split.alias("split"),
    )
    got = prepare_corpus(df, ["id"], ["id"]).collect()
    train = {r["id"] for r in got if r["split"] == "train"}
    assert train == set(range(60)) - {5}  # the incomplete row is gone
    for name, n in (("val", 20), ("test", 10)):
        rows = [r for r in got if r["split"] == name]
        assert sorted(r["row_id"] for r in rows) == list(range(n))
    assert got[0]["messages"][0]["content"] == "Vereenvoudig:  p"


def plain_pack(texts, length, shard_rows):
    texts = [t for t in texts if t]
    out = []
    for s in range(0, len(texts), shard_rows):
        stream = [w for t in texts[s : s + shard_rows] for w in t]
        out += [
            (s // shard_rows, b, stream[b * length : (b + 1) * length])
            for b in range((len(stream) + length - 1) // length)
        ]
    return out


@pytest.mark.parametrize("partitions", (1, 5))
def test_pack(spark, partitions):
    rng = random.Random(5)
    texts = [[f"w{i}.{k}".replace(".", "_") for k in range(rng.choice((0, 1, 3, 7, 40)))] for i in range(60)]
    df = spark.createDataFrame(
        [(i, " ".join(t)) for i, t in enumerate(texts)], "id long, text string"
    ).select("id", tokens(F.col("text")).alias("toks"))
    got = mixing.pack_sequences(df.repartition(partitions), ["id"], "toks", 8, 13).collect()
    assert sorted((r["shard"], r["block"], r["tokens"]) for r in got) == plain_pack(texts, 8, 13)
    assert all(r["n_tokens"] == len(r["tokens"]) for r in got)


def test_tiny_training_sets(spark):
    for n in (0, 1, 2, 3):
        got = mix_training(spark.range(n), ["id"], ["id"]).collect()
        assert {r["id"] for r in got} == set(range(n))
        assert sorted(r["row_id"] for r in got) == list(range(len(got)))


def test_nth_draw_through_small_blocks(spark, monkeypatch):
    from plainweave.operators import mixing

    draws = [r["source"] for r in mixing._draws(spark, [0.3, 0.7], 5, 0, 2000).orderBy("row_id").collect()]
    monkeypatch.setattr(mixing, "MIN_BLOCK", 16)
    monkeypatch.setattr(mixing, "MAX_BLOCKS", 4)
    for source in (0, 1):
        places = [i for i, s in enumerate(draws) if s == source]
        for k in (1, 2, 100, len(places)):
            assert mixing._nth(spark, [0.3, 0.7], 5, source, k, 0, 2000) == places[k - 1]
