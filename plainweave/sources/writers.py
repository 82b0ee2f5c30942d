"""Sinks. All write from the executors; none passes rows through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_corpus(df: DataFrame, path: str) -> None:
    """All splits at once, one folder per split."""
    df.write.partitionBy("split").mode("overwrite").parquet(path)


def write_lines(df: DataFrame, path: str, order: list[str], text: str = "text") -> None:
    """One text per line in input order; part files sort like their rows."""
    one_line = F.regexp_replace(F.col(text), r"[\r\n]+", " ")
    df.orderBy(*order).select(one_line.alias("value")).write.mode("overwrite").text(path)


def append_scores(df: DataFrame, path: str) -> None:
    """Score log: one row per scored text, appended run by run."""
    df.write.mode("append").parquet(path)


def write_results(df: DataFrame, path: str) -> None:
    """Per-sample results as CSV, one folder per model."""
    df.write.partitionBy("model").mode("overwrite").option("header", True).option(
        "escape", '"'
    ).csv(path)


def write_predictions(df: DataFrame, path: str) -> None:
    """Predictions as JSON lines, one folder per model."""
    df.write.partitionBy("model").mode("overwrite").json(path)


def write_comparisons(documents: DataFrame, path: str) -> None:
    """Comparison documents, one file per run, in a folder of its own."""
    by_run = documents.withColumn("run", F.col("configuration.run_id")).repartition("run")
    by_run.write.partitionBy("run").mode("overwrite").json(path)


def write_run_documents(documents: DataFrame, path: str) -> None:
    """One file per run, in a folder of its own."""
    documents.repartition("run_id").write.partitionBy("run_id").mode("overwrite").text(path)


def write_summary(lines: DataFrame, path: str) -> None:
    """Markdown: one section per model from the columns of summary_lines."""
    text = F.concat_ws(
        "\n", F.concat(F.lit("## "), F.col("model")), F.lit(""), "mean_line", "ci_line", F.lit("")
    )
    lines.orderBy("rank").select(text.alias("value")).write.mode("overwrite").text(path)
