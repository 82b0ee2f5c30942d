import pytest
from plainweave.operators import sampling
from plainweave.operators.position import keys_at, quantiles, running, with_position
from pyspark.sql import functions as F

PARTS = (1, 4, 17)


def rows(spark, n=300):
    # one split holds most of the rows
    split = F.when(F.col("id") % 10 == 0, "val").when(F.col("id") % 10 == 1, "test")
    return spark.range(n).withColumn("split", split.otherwise("train"))


def ids(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


@pytest.mark.parametrize("n", PARTS)
def test_sample_is_exact_and_stable(spark, n):
    df = rows(spark).repartition(n)
    got = sampling.sample_exact(df, ["id"], {"val": 7, "test": 1000})
    counts = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert counts == {"train": 240, "val": 7, "test": 30}
    again = sampling.sample_exact(rows(spark).repartition(3), ["id"], {"val": 7, "test": 1000})
    assert ids(got, "id") == ids(again, "id")


def test_sample_sizes_at_the_borders(spark):
    df = rows(spark)
    for k in (0, 1, 29, 30, 31):
        got = sampling.sample_exact(df, ["id"], {"val": k}).where("split = 'val'").count()
        assert got == min(k, 30)
    assert sampling.evaluation_sample(df, ["id"], 0.5).count() == 150
    assert sampling.evaluation_sample(df, ["id"], None).count() == 300
    one = sampling.evaluation_sample(df, ["id"], 50, 1)
    two = sampling.evaluation_sample(df, ["id"], 50, 2)
    assert ids(one, "id") != ids(two, "id")


def test_head(spark):
    got = ids(sampling.head_per_split(rows(spark).repartition(5), 20, ["id"]), "split", "id")
    expected = []
    for split, test in (("test", lambda i: i % 10 == 1), ("train", lambda i: i % 10 > 1),
                        ("val", lambda i: i % 10 == 0)):
        expected += [(split, i) for i in range(300) if test(i)][:20]
    assert got == sorted(expected)
    assert sampling.head_per_split(rows(spark), 31, ["id"]).where("split = 'val'").count() == 30
    assert sampling.head_per_split(rows(spark), 0, ["id"]).count() == 0


def test_numbers_of_parts():
    from plainweave.operators.position import RANGE_ROWS, range_number
    from plainweave.operators.sari import PART_BYTES, part_number

    assert range_number(0, 8, RANGE_ROWS) == range_number(8 * RANGE_ROWS, 8, RANGE_ROWS) == 8
    assert range_number(10**12, 200, RANGE_ROWS) == 10**12 // RANGE_ROWS
    assert part_number(0, 8) == 8 and part_number(10**14, 200) == -(-(10**14) // PART_BYTES)


def test_parts_hold_few_texts(spark):
    # counted n-grams take about 140 times their texts: a part shall stay in a task's memory
    from plainweave.operators.sari import placed

    rows = spark.range(160).select("id", F.repeat(F.concat(F.lit("word"), "id", F.lit(" ")), 20_000).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0]
    assert total > 16 << 20
    parts = placed(rows, ["id"], ["t"]).rdd.getNumPartitions()
    assert total / parts <= 2 << 20


@pytest.mark.parametrize("per_range", (7, 100_000))
def test_null_groups(spark, per_range, monkeypatch):
    monkeypatch.setattr("plainweave.operators.position.RANGE_ROWS", per_range)
    df = spark.createDataFrame([(i, None if i % 5 < 2 else "val") for i in range(100)], "id long, split string")
    counts = {None: 40, "val": 60}
    for placed in (with_position(df, ["id"], ["split"]), sampling.shuffle_order(df, ["id"], 1, ["split"])):
        for split, n in counts.items():
            mine = placed.where(F.col("split").eqNullSafe(F.lit(split)))
            assert sorted(r["position"] for r in mine.collect()) == list(range(n))
    for kept in (sampling.sample_exact(df, ["id"], {"val": 9}), sampling.head_per_split(df, 9, ["id"])):
        assert {r["split"]: r["count"] for r in kept.groupBy("split").count().collect()} == {None: 40, "val": 9}


@pytest.mark.parametrize("n", PARTS)
def test_positions(spark, n):
    df = rows(spark).repartition(n)
    assert ids(with_position(df.select("id"), ["id"]), "id", "position") == [(i, i) for i in range(300)]
    grouped = with_position(df, ["id"], ["split"])
    vals = ids(grouped.where("split = 'val'"), "id", "position")
    assert vals == [(10 * i, i) for i in range(30)]
    shuffled = ids(sampling.shuffle_order(df, ["id"], 42, ["split"]), "split", "position")
    assert shuffled == sorted(
        [("val", i) for i in range(30)] + [("test", i) for i in range(30)]
        + [("train", i) for i in range(240)]
    )


def test_positions_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = rows(spark, 5000)
        got = with_position(df, ["id"], ["split"])
        train = ids(got.where("split = 'train'"), "id", "position")
        assert train == [(i, k) for k, i in enumerate(i for i in range(5000) if i % 10 > 1)]
        summed = running(df, ["id"], {"s": "id"}, ["split"], "total")
        seen, whole = {}, {}
        for i in range(5000):
            split = {0: "val", 1: "test"}.get(i % 10, "train")
            whole[split] = whole.get(split, 0) + i
        for split, i, s, total in ids(summed, "split", "id", "s", "total"):
            seen[split] = seen.get(split, 0) + i
            assert s == seen[split] and total == whole[split]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ratio_partition(spark):
    df = spark.range(101)
    labelled = sampling.ratio_partition(df, ["id"], 0.7)
    assert labelled.where("part = 'ordered'").count() == 70
    places = sampling.part_positions(labelled, ["id"], ["id"])
    ordered = [r["id"] for r in places["ordered"].orderBy("position").collect()]
    shuffled = [r["id"] for r in places["shuffled"].orderBy("position").collect()]
    assert ordered == sorted(ordered) and len(ordered) == 70
    assert shuffled != sorted(shuffled) and len(shuffled) == 31
    assert sorted(ordered + shuffled) == list(range(101))


def test_holdout(spark):
    got = sampling.positional_holdout(spark.range(50), ["id"], 8)
    assert ids(got.where("split = 'validation'"), "id") == [(i,) for i in range(8)]
    assert sampling.positional_holdout(spark.range(5), ["id"], 8).where("split='train'").count() == 0


@pytest.mark.parametrize("n", (1, 2, 3, 10, 11))
def test_tiers_cover_everything_once(spark, n):
    got = ids(sampling.difficulty_tiers(spark.range(n), ["id"]), "id", "tier")
    a, b = int(n * (1 / 3)), int(n * (2 / 3))
    assert got == [(i, "easy" if i < a else "medium" if i < b else "hard") for i in range(n)]
    published = ids(sampling.difficulty_tiers(spark.range(n), ["id"], True), "id", "tier")
    assert published == sorted(
        [(i, "easy") for i in range(a)] + [(i, "medium") for i in range(a, b)]
        + [(i, "hard") for i in range(b)]
    )


def test_batches(spark):
    got = ids(sampling.batch_ids(spark.range(10), ["id"], 4), "id", "batch_id")
    assert got == [(i, i // 4) for i in range(10)]


def test_keys_at(spark):
    found = keys_at(rows(spark), ["id"], {"val": [0, 2], "test": [500]}, "split")
    assert {k: r["id"] for k, r in found.items()} == {("val", 0): 0, ("val", 2): 20}


def test_quantiles_with_a_shared_value(spark):
    import numpy as np

    values = [100.0] * 400 + [float(i) / 3 for i in range(800)]
    df = spark.createDataFrame([("m", v) for v in values] + [("one", 5.0)], "model string, sari double")
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q0": 0.0, "q100": 1.0}
    got = {r["model"]: r for r in quantiles(df, ["model"], "sari", shares).collect()}
    for name, q in shares.items():
        assert got["m"][name] == pytest.approx(np.quantile(values, q))
        assert got["one"][name] == 5.0
    whole = quantiles(df, [], "sari", {"q50": 0.5}).first()
    assert whole["q50"] == pytest.approx(np.quantile([*values, 5.0], 0.5))
