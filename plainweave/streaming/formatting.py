"""Formatting rows as they arrive, and logging what a model was asked."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType, files: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream, optionally only some by pattern."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def format_rows(rows: DataFrame, format_pair: Callable[[Column, Column], Column]) -> DataFrame:
    """Rendered text of every complete pair; works on a stream and on a table."""
    whole = rows.where(F.col("prompt").isNotNull() & F.col("result").isNotNull())
    text = format_pair(F.col("prompt"), F.col("result")).alias("formatted_text")
    return whole.select(*[c for c in rows.columns if c not in ("prompt", "result")], text)


def log_calls(rows: DataFrame, model: str, asked: str, answered: str, at: str) -> DataFrame:
    """Log entries of model calls: time, model, input, output, label."""
    return rows.select(
        F.col(at).cast("timestamp").alias("ts"),
        F.lit(model).alias("model"),
        F.col(asked).alias("input"),
        F.col(answered).alias("output"),
        F.lit(True).alias("ai_generated"),
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a parquet folder, exactly once; takes what is there and stops."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
