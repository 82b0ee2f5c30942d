"""Significance of score differences by resampling.

A resample of rows with replacement is, for many rows, a weight per row that is
Poisson distributed with mean 1. The weight comes from a digest of seed,
replicate and row key, so all resamples are drawn in one pass, nothing is
copied, and both models of a pair get the same weight for the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.functions.fixed import POISSON_LIMITS
from plainweave.functions.hashing import uniform
from plainweave.operators.campaign import best_model
from plainweave.operators.position import join_groups, range_number
from plainweave.operators.staging import stage_measured

REPLICATES = 1000
DRAWS = 2_000_000  # of a part, about


def weight(u: Column) -> Column:
    """Of a uniform draw the Poisson weight; greater ones than the limits tell
    apart have a chance of one in a hundred million."""
    out = F.lit(0)
    for limit in POISSON_LIMITS:
        out = out + F.when(u >= limit, 1).otherwise(0)
    return out


def bootstrap(
    scores: DataFrame, keys: list[str], by: list[str] = (), replicates: int = REPLICATES, seed: int = 42, score: str = "sari"
) -> DataFrame:
    """The best model of every group against each other one: rows both scored,
    mean difference, its 95 % interval over the replicates, and the share of
    replicates in which the best is not ahead.

    Rows pair by key; one that either model lacks, or has a null score for, is
    no pair. Repeated rows of a key pair with each other. Equal means go by
    name. Without a pair a model has no row; a single pair has its own
    difference for every replicate that drew it. Null is a group like others.

    The pairs are written first and spread by the number of their draws: sized
    by their bytes, adaptive execution would put them into a few tasks.
    """
    by = list(by)
    means = scores.groupBy(*by, "model").agg(F.avg(score).alias(score))
    best = best_model(means.where(F.col(score).isNotNull()), by, score).drop(score)
    known = join_groups(scores.select(*by, *keys, "model", F.col(score).alias("_score")), best, by).where(F.col("_score").isNotNull())
    at = F.struct(*by, *keys).alias("_at")
    ahead = known.where(F.col("model") == F.col("best_model")).select(at, F.col("_score").alias("_ahead"))
    others = known.where(F.col("model") != F.col("best_model")).withColumn("_at", at)
    paired = others.join(ahead, "_at").select(
        *by, *keys, F.col("best_model").alias("best"), F.col("model").alias("other"), (F.col("_ahead") - F.col("_score")).alias("_d")
    )
    paired, found = stage_measured(paired, rows=F.count(F.lit(1)))
    setting = int(paired.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paired = paired.repartition(range_number((found.get("rows") or 0) * (replicates + 1), setting, DRAWS))
    groups = [*by, "best", "other"]
    each = F.explode(F.sequence(F.lit(0), F.lit(replicates))).alias("replicate")  # replicate 0 is the sample itself
    drawn = paired.select("*", each)
    # one digest a draw: in a column of its own, and no filter on the weight,
    # which would be pushed below that column and take it apart again
    told = drawn.withColumn("_u", uniform(seed, "bootstrap", [*keys, "replicate"]))
    w = F.when(F.col("replicate") == 0, 1).otherwise(weight(F.col("_u")))
    weighed = told.withColumn("_w", w)
    means = weighed.groupBy(*groups, "replicate").agg(
        F.try_divide(F.sum(F.when(F.col("_w") > 0, F.col("_w") * F.col("_d"))), F.sum("_w")).alias("_mean"), F.sum("_w").alias("_n")
    )
    sample, draws = F.col("replicate") == 0, F.when(F.col("replicate") > 0, F.col("_mean"))
    return means.groupBy(*groups).agg(
        F.max(F.when(sample, F.col("_n"))).alias("rows"), F.max(F.when(sample, F.col("_mean"))).alias("difference"),
        F.percentile(draws, 0.025).alias("ci_low"), F.percentile(draws, 0.975).alias("ci_high"),
        F.avg(F.when(draws <= 0, 1.0).when(draws > 0, 0.0)).alias("not_ahead"),
    )
