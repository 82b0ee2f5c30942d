"""Scoring models against a corpus and summarising a campaign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.functions.chat import baseline_turns, conversation, inference_turns, last_content, render_turns
from plainweave.functions.text import first_sentence, words
from plainweave.operators.campaign import multi_run, per_model
from plainweave.operators.position import join_groups
from plainweave.operators.predict import predict
from plainweave.operators.sampling import difficulty_tiers, sample_conditions
from plainweave.operators.sari import sari
from plainweave.operators.scoring import score_join, score_summary, throughput
from plainweave.operators.staging import stage

BASELINE_MODELS = [
    {"model": "identity", "type": "role_tags", "use_system_prompt": True},
    {"model": "first_sentence", "type": "chatml", "use_system_prompt": False},
    {"model": "oracle_copy", "type": "header_ids", "use_system_prompt": True},
]

BUILT_IN = frozenset(m["model"] for m in BASELINE_MODELS)
OWN = frozenset(["factory", "predictions"])  # how a model of the caller is given


def baseline_answer(model: Column, prompt: Column, result: Column) -> Column:
    """Answers of the built-in models as one expression; other models run
    through operators.predict, and naming one here fails."""
    return (
        F.when(model == "identity", prompt)
        .when(model == "first_sentence", first_sentence(prompt))
        .when(model == "oracle_copy", result)
        .otherwise(F.raise_error(F.concat(F.lit("no built-in model "), model)).cast("string"))
    )


def baseline_queries(corpus: DataFrame, keys: list[str]) -> DataFrame:
    """The question put to a model without fine-tuning, one turn per row."""
    return corpus.select(*keys, conversation(baseline_turns(F.col("prompt"))).alias("messages"))


def score_tiers(
    corpus: DataFrame, keys: list[str], order: list[str], factory, settings: dict | None = None,
    as_published: bool = False,
) -> DataFrame:
    """Put the baseline question to a model for every row, score the answers and
    label the rows' difficulty tiers."""
    tiers = difficulty_tiers(corpus, order, as_published)
    asked = baseline_queries(corpus, keys).select(*keys, last_content(F.col("messages")).alias("_asked"))
    answered = predict(asked, "_asked", factory, settings).drop("_asked")
    joined = score_join(answered, corpus, keys)
    scores = sari(joined, keys)
    return tiers.select(*keys, "tier").join(scores.select(*keys, "sari"), keys)


def question(model: dict) -> Column:
    """What a model of a campaign is asked: its template, with a system turn if
    it takes one, open for the answer."""
    turns = inference_turns(F.col("prompt"))
    if not model.get("use_system_prompt", True):
        turns = [t for t in turns if t[0] != "system"]
    return render_turns(turns, model.get("type", "role_tags"), answer=True)


def model_answers(rows: DataFrame, keys: list[str], models: list[dict]) -> DataFrame:
    """Every row of `rows` (model, keys, prompt, result, others) with its
    model's prediction.

    A model of the list has a ``factory`` (with its ``settings``), which is
    asked in its own template, or ``predictions``, a table of keys and
    prediction, or else the name of a built-in one. A row that the table of
    predictions lacks has a null answer.
    """
    unknown = [m["model"] for m in models if not (m.keys() & OWN or m["model"] in BUILT_IN)]
    if unknown:
        raise ValueError(f"no built-in model {unknown}: give a factory or predictions")
    plain = [m["model"] for m in models if not m.keys() & OWN]
    out = rows.where(F.col("model").isin(plain)).withColumn(
        "prediction", baseline_answer(F.col("model"), F.col("prompt"), F.col("result"))
    )
    for m in models:
        mine = rows.where(F.col("model") == m["model"])
        if "factory" in m:
            asked = mine.withColumn("_asked", question(m))
            answered = predict(asked, "_asked", m["factory"], m.get("settings")).drop("_asked")
        elif "predictions" in m:
            answered = mine.join(m["predictions"].select(*keys, "prediction"), keys, "left")
        else:
            continue
        out = out.unionByName(answered)
    return out


def score_grid(
    corpus: DataFrame, keys: list[str], models: list[dict], runs: int, size: float | None,
    base_seed: int = 42, seconds: Column | None = None, done: DataFrame | None = None,
) -> DataFrame:
    """Score log of a campaign: one row per run, model and text, with the words
    of the answer and the seconds it took where the caller knows them.

    A model answers a text once, and the answer is scored once, however many
    runs drew it. With a log of what is ``done``, only the rest is answered.
    """
    chosen = sample_conditions(corpus, keys, size, [base_seed + i for i in range(runs)])
    drawn = F.array_compact(F.array(*[F.when(c, F.lit(i + 1)) for i, c in enumerate(chosen)]))
    rows = corpus.select(*keys, "prompt", "result", drawn.alias("_runs"))
    rows = per_model(rows.where(F.size("_runs") > 0), models)
    if done is not None:
        had = done.groupBy("model", *keys).agg(F.collect_set("run_id").alias("_had"))
        left = F.array_except("_runs", F.coalesce("_had", F.array().cast("array<int>")))
        rows = rows.join(had, ["model", *keys], "left").withColumn("_runs", left).drop("_had")
        rows = rows.where(F.size("_runs") > 0)
    wanted = rows.select("model", "model_type", *keys, "prompt", "result", "_runs")
    answers = model_answers(wanted, keys, models).select(
        "model", "model_type", *keys, "_runs", F.col("prompt").alias("source"), "prediction",
        F.array("result").alias("references"),
    )
    time = F.lit(None).cast("double") if seconds is None else seconds
    answers = answers.withColumn("n_units", F.size(words(F.col("prediction")))).withColumn("gen_seconds", time)
    # every n-gram carries the row's key: one number
    answers = stage(answers.withColumn("_row", F.monotonically_increasing_id()))
    scored = sari(answers, ["_row"]).select("_row", "sari")
    narrow = answers.drop("source", "prediction", "references").join(scored, "_row")
    return narrow.withColumn("run_id", F.explode("_runs")).select(
        "run_id", (F.col("run_id") + F.lit(base_seed - 1)).alias("seed"), "model", "model_type",
        *keys, "n_units", "gen_seconds", "sari",
    )


def resumed_log(corpus: DataFrame, keys: list[str], done: DataFrame, **settings) -> DataFrame:
    """A score log that was broken off, completed."""
    rest = score_grid(corpus, keys, done=done, **settings)
    return done.unionByName(rest)


def campaign(scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-run summaries and the aggregate over runs, from a score log."""
    log = stage(scores)
    by = ["run_id", "seed", "model", "model_type"]
    speed = throughput(log, by, F.col("gen_seconds"), F.col("n_units")).drop("num_samples")
    summary = join_groups(score_summary(log, by), speed, by)
    summary = stage(summary)
    return summary, multi_run(summary)
