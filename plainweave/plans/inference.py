"""Simplifying a file of texts: one text per line in, one answer per line out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plainweave.functions.chat import inference_turns, render_turns
from plainweave.operators.predict import predict
from plainweave.operators.staging import stage
from plainweave.sources.readers import keep_texts
from plainweave.sources.writers import write_lines


def answer_texts(
    texts: DataFrame, factory: Callable, template: str = "role_tags",
    system: str | None = None, settings: dict | None = None, batch_size: int = 64,
    keep: list[str] | None = None,
) -> DataFrame:
    """Render every text for generation and answer it. ``factory`` receives the
    generation settings and gets the rendered text. The answers come with the
    columns of ``texts``, or those of them in ``keep``."""
    chosen = None if system is None else F.lit(system)
    asked = render_turns(inference_turns(F.col("text"), chosen), template, answer=True)
    rows = texts.withColumn("asked", asked)
    return predict(rows, "asked", factory, settings, batch_size, keep=texts.columns if keep is None else keep)


def simplify_file(spark: SparkSession, source: str, target: str, factory: Callable, **options):
    """Lines keep the order of the files and, within a file, of its parts."""
    lines = spark.read.text(source).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
    )
    # written before they are sorted: sorting reads its input twice, and the
    # model shall answer each text once
    order = ["file", "part", "line"]
    answered = stage(answer_texts(keep_texts(lines), factory, **options, keep=order))
    write_lines(answered, target, order, "prediction")
