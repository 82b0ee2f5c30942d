"""Statistics against published figures of an evaluation (models renamed)."""

import pytest
from plainweave.operators import campaign, corpus, lengths, scoring
from pyspark.sql import functions as F

# Run means and deviations of three models over three runs of 1000 texts.
RUNS = {
    "first": [
        (67.7612238083885, 12.56718227654236),
        (66.92122072216632, 12.592454686983762),
        (67.819674623019, 12.652212616800497),
    ],
    "second": [
        (66.80650988710995, 12.559191198563356),
        (66.22496957179766, 12.91210673811758),
        (66.302560980904, 12.751942707986831),
    ],
    "third": [
        (65.22481106394248, 11.885188422989737),
        (65.53470222044251, 12.287578110762407),
        (65.7582911092358, 11.862222392471933),
    ],
}
# mean of means, deviation of means, mean of deviations, interval
EXPECTED = {
    "first": (67.5007063845246, 0.5026995614597783, 12.603949860108875, 66.25193144623749, 68.74948132281172),
    "second": (66.44468014660386, 0.3157462232993466, 12.741080214889257, 65.66032304597293, 67.22903724723479),
    "third": (65.50593479787359, 0.2679009390287455, 12.011662975408028, 64.84043197222721, 66.17143762351998),
}
# The quick campaign: mean, deviation, seconds per text, units per second, n=100.
QUICK = [
    ("first", 66.88333770460413, 11.867164084185777, 3.982265043258667),
    ("second", 66.68598774406433, 11.482757899487087, 2.3147910022735596),
    ("third", 64.87491950718623, 12.05816072014746, 7.115993568897247),
]


def runs(spark):
    rows = [(i + 1, 42 + i, m, *r) for m, rs in RUNS.items() for i, r in enumerate(rs)]
    return spark.createDataFrame(
        rows, "run_id int, seed int, model string, sari_mean double, sari_std double"
    )


def quick(spark):
    return spark.createDataFrame(
        QUICK, "model string, sari_mean double, sari_std double, avg_generation_time double"
    ).withColumn("num_samples", F.lit(100).cast("long"))


def test_multi_run(spark):
    got = {r["model"]: r for r in campaign.multi_run(runs(spark)).collect()}
    for model, expected in EXPECTED.items():
        r = got[model]
        values = [r[c] for c in ("mean_of_means", "std_of_means", "mean_of_stds", "ci_low", "ci_high")]
        assert values == pytest.approx(expected, abs=1e-9)
        assert r["num_runs"] == 3
        assert [(x["run_id"], x["seed"], x["sari_mean"], x["sari_std"]) for x in r["runs"]] == [
            (i + 1, 42 + i, *x) for i, x in enumerate(RUNS[model])
        ]


def test_single_run_has_no_interval(spark):
    r = campaign.multi_run(runs(spark).where("run_id = 1 AND model = 'first'")).first()
    assert r["num_runs"] == 1 and r["ci_low"] is None


def test_summary_lines(spark):
    lines = campaign.summary_lines(campaign.multi_run(runs(spark))).orderBy("rank").collect()
    assert [(r["rank"], r["model"]) for r in lines] == [(1, "first"), (2, "second"), (3, "third")]
    assert lines[0]["mean_line"] == "- **Mean SARI**: 67.50 ± 0.50"
    assert lines[0]["ci_line"] == "- **95% CI**: [66.25, 68.75]"


def test_best_and_ranking(spark):
    assert campaign.best_model(quick(spark)).first()["best_model"] == "first"
    assert campaign.ranking_list(quick(spark)).first()["ranking"] == ["first", "second", "third"]
    tied = quick(spark).withColumn("sari_mean", F.lit(1.0))
    assert {r["rank"] for r in campaign.ranking(tied).collect()} == {1}


def test_pairwise(spark):
    two = quick(spark).where("model <> 'first'")
    r = campaign.pairwise(two).first()
    assert (r["best"], r["other"]) == ("second", "third")
    assert r["difference"] == pytest.approx(1.81, abs=5e-3)
    assert r["t"] == pytest.approx(1.088, abs=5e-4)
    assert r["verdict"] == "may not be significant"
    assert campaign.pairwise(quick(spark)).count() == 2


def test_pareto(spark):
    good = {r["model"] for r in campaign.pareto(quick(spark)).collect()}
    assert good == {"first", "second"}  # the third is slower and worse
    rows = [("a", 1.0, 1.0), ("b", 1.0, 1.0), ("c", 1.0, 0.5), ("d", 2.0, 1.0), ("e", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "model string, avg_generation_time double, sari_mean double")
    expected = {
        m for m, t, s in rows
        if not any(t2 <= t and s2 >= s and (t2 < t or s2 > s) for _, t2, s2 in rows)
    }
    assert {r["model"] for r in campaign.pareto(df).collect()} == expected == {"a", "b", "e"}


def test_campaigns_compare(spark):
    a = runs(spark).withColumn("avg_generation_time", F.lit(3.4))
    b = runs(spark).withColumn("avg_generation_time", F.lit(2.7))
    got = campaign.compare_campaigns(a, b, ["sari_mean", "avg_generation_time"]).collect()
    assert len(got) == 9
    assert {r["sari_mean_diff"] for r in got} == {0.0}
    assert all(r["avg_generation_time_diff"] == pytest.approx(-0.7) for r in got)


def test_resume(spark):
    plan = spark.range(10).withColumn("model", F.lit("m"))
    left = campaign.resume(plan, plan.where("id < 4"), ["id", "model"])
    assert sorted(r["id"] for r in left.collect()) == list(range(4, 10))


def test_two_sample_summary(spark):
    df = spark.createDataFrame([("m", 66.79), ("m", 91.92)], "model string, sari double")
    r = scoring.score_summary(df, ["model"]).first()
    assert round(r["sari_std"], 3) == 12.565
    assert r["sari_mean"] == pytest.approx(79.355) == pytest.approx(r["sari_median"])
    assert (r["sari_min"], r["sari_max"], r["num_samples"]) == (66.79, 91.92, 2)


def test_throughput_is_total_over_total(spark):
    df = spark.createDataFrame([("m", 1.0, 10), ("m", 3.0, 10)], "model string, s double, u int")
    r = scoring.throughput(df, ["model"], F.col("s"), F.col("u")).first()
    assert (r["tokens_per_second"], r["avg_generation_time"], r["total_time"]) == (5.0, 2.0, 4.0)


def test_tiers_and_bands(spark):
    df = spark.createDataFrame(
        [("easy", 29.9), ("easy", 30.0), ("hard", 50.0), ("hard", 85.0), ("hard", 100.0)],
        "tier string, sari double",
    )
    means = {r["tier"]: r["sari_mean"] for r in scoring.tier_scores(df).collect()}
    assert means["easy"] == pytest.approx(29.95) and means["total"] == pytest.approx(58.98)
    bands = {r["band"]: r["rows"] for r in scoring.quality_bands(df, []).collect()}
    assert bands == {"poor": 1, "below average": 1, "average": 1, "excellent": 2}


def test_running_mean(spark):
    df = spark.range(50).select("id", F.lit("m").alias("model"), F.col("id").cast("double").alias("sari"))
    for r in scoring.running_mean(df.repartition(7), ["model"], ["id"]).collect():
        assert r["scored"] == r["id"] + 1 and r["running_mean"] == pytest.approx(r["id"] / 2)


def test_filter_stats_and_budget(spark):
    df = spark.createDataFrame(
        [("train", True)] * 3 + [("train", False), ("val", True)], "split string, keep boolean"
    )
    stats = {r["split"]: r for r in lengths.filter_stats(df).collect()}
    assert (stats["train"]["dropped"], stats["train"]["dropped_pct"]) == (1, 25.0)
    assert (stats["val"]["dropped"], stats["val"]["dropped_pct"]) == (0, 0.0)
    counts = spark.createDataFrame([("train", 1000), ("val", 10**9)], "split string, rows long")
    steps = {r["split"]: r["steps"] for r in lengths.step_budget(counts, 50, 3, 8, 4).collect()}
    assert steps == {"train": 50, "val": 50}
    steps = lengths.step_budget(counts.where("split='train'"), 50_000, 3, 8, 4, 2).first()
    assert (steps["steps"], steps["effective_batch"]) == (93, 16)


def test_length_limit_is_inclusive(spark):
    df = spark.createDataFrame([("a " * n,) for n in (4, 5, 6)], "t string")
    kept = lengths.within_length(df, "t", 5).count()
    flagged = lengths.with_length(df, "t", 5).where("keep").count()
    assert kept == flagged == 2


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame(
        [(3, "a", "b"), (1, "a", "b"), (2, "a", None), (4, "ab", ""), (5, "a", "bb"), (6, "a", None)],
        "id long, prompt string, result string",
    )
    kept = corpus.drop_duplicates(df, ["prompt", "result"], "id")
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 4, 5]
    assert corpus.complete(df).count() == 4
    counts = corpus.split_counts(df.withColumn("split", F.lit("train"))).first()
    assert (counts["rows"], counts["incomplete"]) == (6, 2)


def test_large_group_of_copies(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("t")
    )
    kept = corpus.drop_duplicates(df, ["t"], "id")
    assert kept.count() == 2001 and kept.where("t = 'same'").first()["id"] == 0


def test_toxic(spark):
    docs = spark.range(4).withColumnRenamed("id", "doc_id")
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 0)], "doc_id long, toxic int")
    left = corpus.exclude_toxic(docs, labels, "doc_id")
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3]


def test_difference(spark):
    df = spark.createDataFrame([("a b", "a b"), ("a b", "c d"), ("a b c", "a b d")], "p string, r string")
    got = [r[0] for r in df.select(corpus.difference(F.col("p"), F.col("r"))).collect()]
    assert got == [0.0, 1.0, 0.5]


def test_student_t_beyond_the_table(spark):
    df = spark.createDataFrame([(n,) for n in (0, 30, 31, 60, 1000)], "df int")
    got = [r["t"] for r in df.select(campaign.t_critical(F.col("df")).alias("t")).collect()]
    assert got[0] is None
    assert got[1:] == pytest.approx([2.04227, 2.03951, 2.00030, 1.96234], abs=1e-5)


def test_ties_and_gaps(spark):
    rows = [(1, "z", 5.0), (1, "a", 5.0), (1, "n", None), (2, "n", None)]
    means = spark.createDataFrame(rows, "run_id int, model string, sari_mean double").repartition(3)
    best = {r["run_id"]: r["best_model"] for r in campaign.best_model(means, ["run_id"]).collect()}
    assert best == {1: "a", 2: "n"}
    scores = spark.createDataFrame([("m", None, 1), ("m", 0.0, 1)], "model string, sari double, u int")
    assert {r["band"]: r["rows"] for r in scoring.quality_bands(scores, []).collect()} == {None: 1, "poor": 1}
    assert scoring.throughput(scores, ["model"], F.col("sari"), F.col("u")).first()["tokens_per_second"] is None


def test_null_texts_and_unknown_models(spark):
    from plainweave.operators import predict
    from plainweave.plans import evaluation

    df = spark.createDataFrame([(1, "One. Two."), (2, None), (3, "")], "k int, text string")
    got = {r["k"]: r["prediction"] for r in predict.predict(df, "text", predict.first_sentence_model).collect()}
    assert got == {1: "One.", 2: None, 3: ""}
    answer = evaluation.baseline_answer(F.lit("mymodel"), F.col("text"), F.col("text"))
    with pytest.raises(Exception, match="no built-in model"):
        df.select(answer.alias("a")).collect()
