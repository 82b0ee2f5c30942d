"""The given tables, and the simplification corpus they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plainweave.functions.hashing import uniform
from plainweave.functions.text import first_sentence

PAIR_KEYS = ["conv_id", "turn"]
SPLIT_SEED = 42
TRAIN_BELOW, VAL_BELOW = 0.7, 0.9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


INPUT_PARTITIONS = "spark.plainweave.inputPartitions"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Inputs as they are read. Where the session asks for a number of input
    partitions, they are spread over so many: one small file is a single task
    however much work a row is."""
    number = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(number), *keys) if number else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def split_label(keys: list[str]) -> Column:
    """70/20/10 by row key: a row keeps its split when the corpus grows."""
    u = uniform(SPLIT_SEED, "split", keys)
    return F.when(u < TRAIN_BELOW, "train").when(u < VAL_BELOW, "val").otherwise("test")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows, as prompt and result.

    Joined on (conversation, turn), which is unique, so a conversation of any
    length spreads over the tasks.
    """
    turns = spread(table(spark, sf_dir, "conversations"), *PAIR_KEYS)
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("prompt")
    )
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("result")
    )
    return asked.join(answered, PAIR_KEYS).withColumn("split", split_label(PAIR_KEYS))


def document_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a bulk corpus: the whole text, with its first sentence in
    the place of the simplified text."""
    return documents(spark, sf_dir).select(
        "doc_id",
        F.col("text").alias("prompt"),
        first_sentence(F.col("text")).alias("result"),
        split_label(["doc_id"]).alias("split"),
    )
