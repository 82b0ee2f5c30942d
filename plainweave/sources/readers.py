"""Readers with declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plainweave.functions.text import SPACE, strip

PAIR_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("instruction", T.StringType()),
        T.StructField("split", T.StringType()),
    ]
)

MESSAGES = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)

RESULT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("model_name", "model_path", "model_type")]
    + [T.StructField("num_samples", T.LongType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in (
            "sari_mean", "sari_std", "sari_median", "sari_min", "sari_max", "sari_q25",
            "sari_q75", "avg_generation_time", "total_time", "tokens_per_second",
        )
    ]
)

COMPARISON_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField(
            "configuration",
            T.StructType(
                [
                    T.StructField("num_samples", T.LongType()),
                    T.StructField("seed", T.LongType()),
                    T.StructField("note", T.StringType()),
                ]
            ),
        ),
        T.StructField("results", T.MapType(T.StringType(), RESULT_SCHEMA)),
        T.StructField("ranking", T.ArrayType(T.StringType())),
    ]
)


def read_pairs(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """All splits, or one: the split is a partition folder, so only that one is read."""
    df = spark.read.schema(PAIR_SCHEMA).parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A formatted corpus, only its conversations (and split)."""
    schema = T.StructType(
        [T.StructField("messages", MESSAGES), T.StructField("split", T.StringType())]
    )
    return spark.read.schema(schema).parquet(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One text per line: trimmed, blank lines dropped."""
    return keep_texts(spark.read.text(path).select(F.col("value").alias("text")))


def one_text(spark: SparkSession, text: str) -> DataFrame:
    return keep_texts(spark.createDataFrame([(text,)], "text string"))


def keep_texts(df: DataFrame) -> DataFrame:
    # whether anything is left shows at the first character that is no white
    # space: a filter on the trimmed text would trim it twice
    return df.where(F.col("text").rlike(f"[^{SPACE}]")).withColumn("text", strip(F.col("text")))


def text_lines(df: DataFrame, keys: list[str]) -> DataFrame:
    """Lines of a text column with their 0-based number, trimmed, blanks dropped."""
    lines = df.select(*keys, F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))
    return keep_texts(lines)


def read_comparisons(spark: SparkSession, path: str) -> DataFrame:
    """Comparison documents under a path, one row per document and model."""
    docs = (
        spark.read.schema(COMPARISON_SCHEMA)
        .option("multiLine", True)
        .json(path)
        .withColumn("file", F.input_file_name())
    )
    return docs.select(
        "file",
        F.to_timestamp("timestamp", "yyyyMMdd_HHmmss").alias("evaluated_at"),
        F.col("configuration.seed").alias("seed"),
        "ranking",
        F.explode("results").alias("model", "record"),
    ).select("file", "evaluated_at", "seed", "ranking", "model", "record.*")


def read_run_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Run summaries (model name -> record, plus one entry of run metadata)."""
    entry = T.StructType(
        RESULT_SCHEMA.fields
        + [T.StructField("run_id", T.LongType()), T.StructField("seed", T.LongType())]
    )
    whole = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", T.MapType(T.StringType(), entry))
    docs = whole.select(F.input_file_name().alias("file"), entries.alias("entries"))
    meta = F.element_at("entries", "run_metadata")
    return docs.select(
        "file",
        meta["run_id"].alias("run_id"),
        meta["seed"].alias("seed"),
        F.explode(F.map_filter("entries", lambda k, _: k != "run_metadata")).alias("model", "record"),
    ).select(
        "file", "run_id", "seed", "model",
        *[F.col(f"record.{f.name}") for f in RESULT_SCHEMA.fields if f.name != "model_name"],
    )
