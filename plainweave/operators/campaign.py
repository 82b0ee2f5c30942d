"""Runs x models: planning what to answer, and statistics over the results.

From the run summaries on, there is one row per run and model: sizes are those
of the configuration, so windows over them are small whatever the corpus is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from plainweave.functions.fixed import NORMAL_95, NORMAL_975, T_CRITICAL_95
from plainweave.operators.sampling import sample_conditions


def models_column(models: list[dict]) -> Column:
    """Model configuration as an array of structs, to be exploded per row."""
    return F.array(
        *[
            F.struct(
                F.lit(m["model"]).alias("model"),
                F.lit(m.get("path", m["model"])).alias("model_path"),
                F.lit(m.get("type", "role_tags")).alias("model_type"),
                F.lit(bool(m.get("use_system_prompt", True))).alias("use_system_prompt"),
            )
            for m in models
        ]
    )


def per_model(df: DataFrame, models: list[dict]) -> DataFrame:
    """Every row once per configured model."""
    return df.select("*", F.inline(models_column(models)))


def only_configured(df: DataFrame, models: list[dict]) -> DataFrame:
    """Rows of configured models."""
    return df.where(F.col("model").isin([m["model"] for m in models]))


def evaluation_grid(
    corpus: DataFrame, keys: list[str], models: list[dict], runs: int, size: float | None,
    base_seed: int = 42,
) -> DataFrame:
    """Each run draws its own sample (seeds base, base + 1, ...); each model
    answers all of it. A row is read once and repeated for the runs that drew it.

    ``size`` is a number of rows, a share of them (as float), or None for all.
    """
    seeds = [base_seed + i for i in range(runs)]
    chosen = sample_conditions(corpus, keys, size, seeds)
    drawn = [
        F.when(c, F.struct(F.lit(i + 1).alias("run_id"), F.lit(seed).alias("seed")))
        for i, (seed, c) in enumerate(zip(seeds, chosen, strict=True))
    ]
    once = corpus.withColumn("_runs", F.array_compact(F.array(*drawn)))
    columns = ["_run.run_id", "_run.seed", *corpus.columns]
    grid = once.withColumn("_run", F.explode("_runs")).select(*columns)
    return per_model(grid, models)


def resume(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What of the plan has not been scored yet."""
    return plan.join(done.select(*keys), keys, "left_anti")


def t_critical(df: Column) -> Column:
    """Two-sided 95% Student t, null below one degree of freedom; above the
    table by the expansion in 1/df, which is exact to five digits there."""
    values = F.array(*[F.lit(t) for t in T_CRITICAL_95])
    z = NORMAL_975
    expanded = (
        F.lit(z)
        + F.lit((z**3 + z) / 4) / df
        + F.lit((5 * z**5 + 16 * z**3 + 3 * z) / 96) / (df * df)
        + F.lit((3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384) / (df * df * df)
    )
    return F.when(
        df.between(1, len(T_CRITICAL_95)), F.get(values, (df - 1).cast("int"))
    ).when(df > len(T_CRITICAL_95), expanded)


def multi_run(summaries: DataFrame) -> DataFrame:
    """Per model over its runs: mean and sample deviation of the run means, mean
    of the run deviations, 95% interval, and the runs themselves in order."""
    runs = F.array_sort(F.collect_list(F.struct("run_id", "seed", "sari_mean", "sari_std")))
    out = summaries.groupBy("model").agg(
        F.avg("sari_mean").alias("mean_of_means"),
        F.stddev_samp("sari_mean").alias("std_of_means"),
        F.avg("sari_std").alias("mean_of_stds"),
        F.count(F.lit(1)).alias("num_runs"),
        runs.alias("runs"),
    )
    n = F.col("num_runs")
    half = t_critical(n - 1) * F.col("std_of_means") / F.sqrt(n)
    return out.select(
        "model", "mean_of_means", "std_of_means", "mean_of_stds",
        (F.col("mean_of_means") - half).alias("ci_low"),
        (F.col("mean_of_means") + half).alias("ci_high"),
        n, "runs",
    )


def ranking(summaries: DataFrame, by: list[str] = (), score: str = "sari_mean") -> DataFrame:
    """Models by mean score, best first; equal scores share a rank."""
    order = W.partitionBy(*by).orderBy(F.col(score).desc())
    return summaries.withColumn("rank", F.rank().over(order))


def _place(score: str) -> Column:
    """Sorts the best first, equal scores by name, models without a score last."""
    return F.struct(F.col(score).isNull().alias("none"), (-F.col(score)).alias("s"), F.col("model").alias("model"))


def _names(score: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(_place(score))), lambda e: e["model"])


def ranking_list(summaries: DataFrame, by: list[str] = (), score: str = "sari_mean") -> DataFrame:
    """The same as one ordered list of names, equal scores by name; models
    without a score come last."""
    return summaries.groupBy(*by).agg(_names(score).alias("ranking"))


def best_model(summaries: DataFrame, by: list[str] = (), score: str = "sari_mean") -> DataFrame:
    """Equal scores go by name; a model without a score comes last."""
    return summaries.groupBy(*by).agg(
        F.min_by("model", _place(score)).alias("best_model"), F.max(score).alias(score)
    )


def pairwise(summaries: DataFrame, by: list[str] = ()) -> DataFrame:
    """The best model against each of the others: difference of means, Welch's
    t and a verdict. Ties in the mean go by name."""
    order = W.partitionBy(*by).orderBy(F.col("sari_mean").desc(), "model")
    rows = summaries.withColumn("rank", F.row_number().over(order))
    best = W.partitionBy(*by).orderBy("rank").rowsBetween(W.unboundedPreceding, 0)

    def top(c: str) -> Column:
        return F.first(c).over(best)

    spread = top("sari_std") ** 2 / top("num_samples") + F.col("sari_std") ** 2 / F.col("num_samples")
    compared = rows.select(
        *by,
        top("model").alias("best"),
        F.col("model").alias("other"),
        "rank",
        (top("sari_mean") - F.col("sari_mean")).alias("difference"),
        F.when(spread > 0, (top("sari_mean") - F.col("sari_mean")) / F.sqrt(spread)).alias("t"),
    ).where(F.col("rank") > 1)
    clear = F.abs("t") > NORMAL_95
    return compared.withColumn(
        "verdict",
        F.when(clear, "statistically significant").otherwise("may not be significant"),
    )


def pareto(summaries: DataFrame, by: list[str] = ()) -> DataFrame:
    """Models that no other beats on one of speed and score without losing the
    other: sorted by time, a model has to exceed the best score so far. Models
    without a time or a score cannot be compared and are left out."""
    summaries = summaries.where(F.col("avg_generation_time").isNotNull() & F.col("sari_mean").isNotNull())
    by_time = W.partitionBy(*by).orderBy("avg_generation_time")
    # each distinct time with its best score, then the best among faster ones
    at_time = W.partitionBy(*by, "avg_generation_time")
    best_here = F.max("sari_mean").over(at_time)
    rows = summaries.withColumn("_here", best_here).withColumn(
        "_rank", F.dense_rank().over(by_time)
    )
    faster = W.partitionBy(*by).orderBy("_rank").rangeBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_faster", F.max("sari_mean").over(faster))
    good = (F.col("sari_mean") == F.col("_here")) & (
        F.col("_faster").isNull() | (F.col("sari_mean") > F.col("_faster"))
    )
    return rows.where(good).drop("_here", "_rank", "_faster")


def summary_lines(aggregate: DataFrame) -> DataFrame:
    """Report lines per model, best first."""
    number = "%.2f"
    return ranking(aggregate, score="mean_of_means").select(
        "rank",
        "model",
        F.format_string(
            f"- **Mean SARI**: {number} ± {number}", F.col("mean_of_means"), F.col("std_of_means")
        ).alias("mean_line"),
        F.format_string(
            f"- **95%% CI**: [{number}, {number}]", F.col("ci_low"), F.col("ci_high")
        ).alias("ci_line"),
    )


def speed_lines(summaries: DataFrame) -> DataFrame:
    """Report lines on the speed of every run and model; null without a time."""
    return summaries.select(
        "run_id",
        "model",
        F.when(
            F.col("avg_generation_time").isNotNull(),
            F.format_string(
                "%s: %.3f s per sample, %.3f s in all, %.2f per second, %,d samples",
                "model", "avg_generation_time", "total_time", "tokens_per_second", "num_samples",
            ),
        ).alias("speed_line"),
    )


def comparison_document(summaries: DataFrame, config: dict, timestamp: Column) -> DataFrame:
    """One row per run: time label, configuration with the run and its seed,
    model -> record, and the ranking."""
    fields = [F.col(c) for c in summaries.columns if c not in ("model", "run_id", "seed")]
    record = F.struct(F.col("model").alias("model_name"), *fields)
    entries = F.collect_list(F.struct("model", record))
    own = ["run_id", "seed"]
    return summaries.groupBy(*own).agg(
        F.map_from_entries(F.array_sort(entries)).alias("results"),
        _names("sari_mean").alias("ranking"),
    ).select(
        F.date_format(timestamp, "yyyyMMdd_HHmmss").alias("timestamp"),
        F.struct(*own, *[F.lit(v).alias(k) for k, v in config.items() if k not in own]).alias("configuration"),
        "results",
        "ranking",
    )


def run_documents(summaries: DataFrame) -> DataFrame:
    """One JSON text per run: model -> record, and an entry run_metadata."""
    drop = ("run_id", "seed", "model")
    fields = [c for c in summaries.columns if c not in drop]
    types = dict(summaries.dtypes)

    def entry(name: Column, filled: list[str]) -> Column:
        # absent fields are null, which JSON output leaves out
        def value(c: str) -> Column:
            return (F.col(c) if c in filled else F.lit(None).cast(types[c])).alias(c)

        return F.struct(
            name.alias("key"), F.struct(*[value(c) for c in ["run_id", "seed", *fields]]).alias("value")
        )

    records = F.collect_list(entry(F.col("model"), fields))
    meta = F.max(entry(F.lit("run_metadata"), ["run_id", "seed", "num_samples"]))
    entries = F.concat(F.array_sort(records), F.array(meta))
    return summaries.groupBy("run_id").agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def compare_campaigns(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Differences b - a of runs and models. What only one campaign has keeps its
    row, with nulls on the other side; a null run or model matches a null one."""
    keys = ["model", "run_id"]
    left = a.select(F.struct(*keys).alias("at"), *[F.col(c).alias(f"{c}_a") for c in columns])
    right = b.select(F.struct(*keys).alias("at"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return left.join(right, "at", "full").select(
        *[F.col("at").getField(k).alias(k) for k in keys],
        *[F.col(f"{c}_{side}") for side in "ab" for c in columns],
        *[(F.col(f"{c}_b") - F.col(f"{c}_a")).alias(f"{c}_diff") for c in columns],
    )
