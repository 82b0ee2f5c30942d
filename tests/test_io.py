import datetime

import pytest
from plainweave.functions import chat
from plainweave.operators import campaign, corpus, lengths, predict, sampling, staging
from plainweave.plans import evaluation, inference, training
from plainweave.sources import readers, writers
from plainweave.streaming import formatting
from pyspark.sql import functions as F


def small(spark, n=30):
    split = F.when(F.col("row_id") % 3 == 0, "val").otherwise("train")
    return spark.range(n).withColumnRenamed("id", "row_id").select(
        "row_id", F.concat(F.lit("prompt "), "row_id").alias("prompt"),
        F.lit("Short. Text").alias("result"), F.lit("i").alias("instruction"), split.alias("split"),
    )


def test_corpus_by_split(spark, tmp_path):
    path = str(tmp_path / "corpus")
    writers.write_corpus(small(spark), path)
    assert readers.read_pairs(spark, path).count() == 30
    one = readers.read_pairs(spark, path, "val")
    assert one.count() == 10
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert sorted(one.columns) == sorted(small(spark).columns)


def test_messages_only(spark, tmp_path):
    path = str(tmp_path / "m")
    writers.write_corpus(corpus.add_two_turns(small(spark)), path)
    got = readers.read_messages(spark, path).where("split = 'val'")
    assert got.first()["messages"][1]["content"] == "Short. Text"
    assert "prompt" not in got._jdf.queryExecution().executedPlan().toString()


def test_lines(spark, tmp_path):
    source = tmp_path / "in.txt"
    source.write_text("  one \n\n\t\n two \nthree", encoding="utf-8")
    assert [r["text"] for r in readers.read_lines(spark, str(source)).collect()] == ["one", "two", "three"]
    assert readers.one_text(spark, " x ").first()["text"] == "x"
    assert readers.one_text(spark, "  ").count() == 0


def test_simplify_file_keeps_order(spark, tmp_path):
    def upper_model(**settings):
        return lambda texts: [
            " " + t.split("Vereenvoudig: ")[1].split("<|")[0].upper() + "\n" for t in texts
        ]

    source, target = tmp_path / "in.txt", str(tmp_path / "out")
    lines = [f"line {i}" for i in range(200)]
    source.write_text("\n".join(lines) + "\n\n", encoding="utf-8")
    inference.simplify_file(spark, str(source), target, upper_model)
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part"))
    got = [x for p in parts for x in p.read_text(encoding="utf-8").splitlines()]
    assert got == [x.upper() for x in lines]


def test_results_per_model(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 1, 'say "x", y\nz'), ("b", 2, "")], "model string, row_id long, text string"
    )
    writers.write_predictions(df, str(tmp_path / "p"))
    back = spark.read.schema("row_id long, text string, model string").json(str(tmp_path / "p"))
    assert sorted(map(tuple, back.select("model", "row_id", "text").collect())) == [
        ("a", 1, 'say "x", y\nz'), ("b", 2, ""),
    ]
    writers.write_results(df.drop("text"), str(tmp_path / "r"))
    assert (tmp_path / "r" / "model=a").is_dir()


def test_score_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([("easy", 1, 50.0)], "tier string, row_id long, sari double")
    writers.append_scores(df, path)
    writers.append_scores(df, path)
    assert spark.read.parquet(path).count() == 2


RECORD = (
    '{"model_name": "m", "model_path": "p", "model_type": "t", "num_samples": 100, '
    '"sari_mean": 66.5, "sari_std": 1.0, "sari_median": 66.0, "sari_min": 1.0, "sari_max": 100.0, '
    '"sari_q25": 60.0, "sari_q75": 70.0, "avg_generation_time": 2.0, "total_time": 200.0, '
    '"tokens_per_second": 9.5}'
)


def test_read_results(spark, tmp_path):
    one = tmp_path / "comparison.json"
    one.write_text(
        '{"timestamp": "20240131_123456",\n "configuration": {"num_samples": 100, "seed": 42},'
        f'\n "results": {{"m": {RECORD}}},\n "ranking": ["m"]}}'
    )
    r = readers.read_comparisons(spark, str(one)).first()
    assert (r["model"], r["seed"], r["sari_mean"], r["ranking"]) == ("m", 42, 66.5, ["m"])
    assert r["evaluated_at"] == datetime.datetime(2024, 1, 31, 12, 34, 56)
    two = tmp_path / "run.json"
    two.write_text(
        f'{{"m": {RECORD}, "run_metadata": {{"run_id": 2, "seed": 43, "num_samples": 100}}}}'
    )
    rows = readers.read_run_summaries(spark, str(two)).collect()
    assert [(r["model"], r["run_id"], r["seed"], r["sari_q75"]) for r in rows] == [("m", 2, 43, 70.0)]


def test_summary_markdown(spark, tmp_path):
    rows = [(1, 42, "m", 50.0, 1.0), (2, 43, "m", 52.0, 1.0)]
    runs = spark.createDataFrame(rows, "run_id int, seed int, model string, sari_mean double, sari_std double")
    writers.write_summary(campaign.summary_lines(campaign.multi_run(runs)), str(tmp_path / "s"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "s").glob("part*")))
    assert text.startswith("## m\n\n- **Mean SARI**: 51.00 ± 1.41\n- **95% CI**: [")


def test_predict_once_per_task_in_batches(spark):
    def counting_model(**settings):
        state = {"calls": 0}

        def answer(texts):
            state["calls"] += 1
            return [f" {settings['max_new_tokens']}:{state['calls']}:{len(texts)} " for _ in texts]

        return answer

    df = small(spark, 10).coalesce(1)
    got = predict.predict(df, "prompt", counting_model, {"max_new_tokens": 5}, batch_size=4)
    answers = sorted(r["prediction"] for r in got.collect())
    assert answers == ["5:1:4"] * 4 + ["5:2:4"] * 4 + ["5:3:2"] * 2
    same = predict.predict(df, "prompt", predict.BASELINES["identity"])
    assert same.where("prediction = prompt").count() == 10


def test_own_tokenizer(spark):
    public = pytest.importorskip("public_tokenizers")
    tokenizers = pytest.importorskip("tokenizers")
    path = public.path("byte_bpe_50k.json")

    def factory():
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        return lambda texts: [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]

    counter = lengths.token_counter(factory)
    got = training.formatted(small(spark, 5), ["row_id"], 100, counter=counter).collect()
    tok = tokenizers.Tokenizer.from_file(path)
    assert [r["n_tokens"] for r in got] == [len(tok.encode(r["formatted_text"]).ids) for r in got]


def test_training_set(spark):
    df = small(spark, 300)
    chosen, stats = training.training_set(df, ["row_id"], ["row_id"], 1000, head=60, sizes={"val": 10})
    counts = {r["split"]: r["count"] for r in chosen.groupBy("split").count().collect()}
    assert counts == {"train": 60, "val": 10}
    assert {r["split"]: (r["before"], r["after"]) for r in stats.collect()} == {
        "train": (60, 60), "val": (60, 60),
    }


def test_tier_scores_with_a_model(spark):
    df = small(spark, 30)
    scores = evaluation.score_tiers(df, ["row_id"], ["row_id"], predict.identity_model)
    assert scores.groupBy("tier").count().count() == 3 and scores.count() == 30
    twice = evaluation.score_tiers(df, ["row_id"], ["row_id"], predict.identity_model, as_published=True)
    assert twice.count() == 40


def test_campaign_end_to_end(spark):
    scores = evaluation.score_grid(
        small(spark), ["row_id"], evaluation.BASELINE_MODELS, 2, 10, seconds=F.lit(0.5)
    )
    summary, aggregate = evaluation.campaign(scores)
    rows = summary.collect()
    assert len(rows) == 6 and {r["num_samples"] for r in rows} == {10}
    copy = [r for r in rows if r["model"] == "oracle_copy"]
    assert all(r["sari_mean"] == 100.0 and r["total_time"] == 5.0 for r in copy)
    assert aggregate.count() == 3


def test_campaign_over_given_predictions(spark):
    df = small(spark, 6)
    given = df.where("row_id < 4").select("row_id", F.col("result").alias("prediction"))
    log = evaluation.score_grid(df, ["row_id"], [{"model": "mine", "predictions": given}], 2, None)
    rows = log.collect()
    assert len(rows) == 12
    assert {r["row_id"]: r["sari"] for r in rows} == {k: 100.0 if k < 4 else None for k in range(6)}
    with pytest.raises(ValueError, match="no built-in model"):
        evaluation.score_grid(df, ["row_id"], [{"model": "mine"}], 1, None)


def test_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    small(spark).write.parquet(source)
    schema = spark.read.parquet(source).schema
    shown = formatting.format_rows(formatting.stream_table(spark, source, schema), chat.formatter())
    assert shown.isStreaming
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    formatting.append_to(shown, out, state).awaitTermination()
    small(spark, 10).write.mode("append").parquet(source)  # later files only add their rows
    formatting.append_to(shown, out, state).awaitTermination()
    batch = formatting.format_rows(spark.read.parquet(source), chat.formatter())
    assert sorted(map(tuple, spark.read.parquet(out).select(batch.columns).collect())) == sorted(
        map(tuple, batch.collect())
    )


def test_log_calls(spark):
    df = spark.createDataFrame([("q", "a", "2024-01-01 00:00:00")], "q string, a string, t string")
    r = formatting.log_calls(df, "m", "q", "a", "t").first()
    assert (r["input"], r["output"], r["model"], r["ai_generated"]) == ("q", "a", "m", True)


def test_stage_writes_and_releases(spark, tmp_path, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert staging.new_path(spark).startswith(named)
    monkeypatch.setattr(staging, "stage_root", lambda _: str(tmp_path))
    df = staging.stage(spark.range(3))
    assert df.count() == 3 and list((tmp_path / "plainweave").iterdir())
    assert staging.release_stages(spark) > 0
    assert not list((tmp_path / "plainweave").iterdir())


def test_sampling_reads_only_keys(spark, tmp_path):
    path = str(tmp_path / "c")
    small(spark).write.parquet(path)
    got = sampling.sample_exact(spark.read.parquet(path), ["row_id"], {"val": 3})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # texts are kept or dropped where they are read


def test_lines_are_trimmed_once(spark):
    rows = [(1, " a "), (2, "\u2003\t"), (3, None), (4, ""), (5, "\u00a0b\u00a0c")]
    kept = readers.keep_texts(spark.createDataFrame(rows, "id int, text string"))
    assert {tuple(r) for r in kept.collect()} == {(1, "a"), (5, "b\u00a0c")}
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_only_what_is_kept_returns(spark):
    df = spark.createDataFrame([(1, "b a", "x"), (2, None, "y"), (3, "", "z")], "id int, text string, other string")
    got = predict.predict(df, "text", predict.BASELINES["identity"], keep=["id"])
    assert got.columns == ["id", "prediction"]
    assert sorted(map(tuple, got.collect())) == [(1, "b a"), (2, None), (3, "")]
