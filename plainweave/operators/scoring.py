"""Joining predictions to their texts and summarising scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.functions.fixed import QUALITY_BANDS
from plainweave.operators.position import join_groups, quantiles, running

QUARTILES = {"sari_q25": 0.25, "sari_median": 0.5, "sari_q75": 0.75}


def score_join(predictions: DataFrame, corpus: DataFrame, keys: list[str]) -> DataFrame:
    """Prediction next to its source and reference text, one to one by key."""
    texts = corpus.select(
        *keys, F.col("prompt").alias("source"), F.array("result").alias("references")
    )
    return predictions.join(texts, keys)


def tier_scores(scores: DataFrame) -> DataFrame:
    """Mean score per tier and over all of them ('total'). Null is a tier like
    others; one without any score has a null mean."""
    sums = scores.groupBy("tier").agg(F.sum("sari").alias("s"), F.count("sari").alias("n"))
    return sums.rollup("tier").agg(
        F.try_divide(F.sum("s"), F.sum("n")).alias("sari_mean"), F.sum("n").alias("num_samples"),
        F.grouping("tier").alias("_all"),
    ).select(F.when(F.col("_all") == 1, "total").otherwise(F.col("tier")).alias("tier"), "sari_mean", "num_samples")


def score_summary(scores: DataFrame, by: list[str]) -> DataFrame:
    """Count, mean, population deviation, extremes and exact quartiles of every
    group; null is a group like others, one without any score has null values.

    Reads the scores twice: give it a written score log, not a scoring plan.
    """
    basic = scores.groupBy(*by).agg(
        F.count("sari").alias("num_samples"),
        F.avg("sari").alias("sari_mean"),
        F.stddev_pop("sari").alias("sari_std"),
        F.min("sari").alias("sari_min"),
        F.max("sari").alias("sari_max"),
    )
    return join_groups(basic, quantiles(scores, by, "sari", QUARTILES), by)


def throughput(df: DataFrame, by: list[str], seconds: Column, units: Column) -> DataFrame:
    """Generation speed; units per second is total over total, not a mean of rates."""
    return df.groupBy(*by).agg(
        F.count(seconds).alias("num_samples"),
        F.sum(seconds).alias("total_time"),
        F.try_divide(F.sum(seconds), F.count(seconds)).alias("avg_generation_time"),
        F.try_divide(F.sum(units), F.sum(seconds)).alias("tokens_per_second"),
    )


def running_mean(scores: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Mean of all scores so far, per group, in key order. A missing score counts
    neither as a score nor as zero; before the first one there is no mean."""
    rows = scores.select(*by, *order, "sari").withColumn("_one", F.col("sari").isNotNull().cast("long"))
    summed = running(rows, order, {"scored": "_one", "_total": "sari"}, by)
    mean = F.try_divide("_total", "scored").alias("running_mean")
    return summed.select(*by, *order, "sari", "scored", mean)


def band(score: Column) -> Column:
    """Name of the quality band; bounds belong to the band above them. Scores
    are sums of fractions: nine digits make one that amounts to 50 be 50. A
    missing score has no band."""
    score = F.round(score, 9)
    out = F.when(score < QUALITY_BANDS[1][0], QUALITY_BANDS[0][1])
    for (_, name), (upper, _) in zip(QUALITY_BANDS[1:], QUALITY_BANDS[2:], strict=False):
        out = out.when(score < upper, name)
    return out.when(score.isNotNull(), QUALITY_BANDS[-1][1])


def quality_bands(scores: DataFrame, by: list[str]) -> DataFrame:
    """Scores per quality band."""
    return scores.groupBy(*by, band(F.col("sari")).alias("band")).agg(
        F.count(F.lit(1)).alias("rows")
    )
