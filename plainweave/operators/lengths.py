"""Token lengths: filtering, statistics, truncation, step budget."""

from collections.abc import Callable
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.functions.text import tokens


def token_counter(factory: Callable[[], Callable[[list[str]], list[int]]]):
    """Column function counting the tokens of a caller's tokenizer.

    ``factory`` runs once per Python worker task and returns a function from a
    list of texts to their token counts.
    """

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = factory()
        for texts in batches:
            yield pd.Series(counts(list(texts)), dtype="int32")

    return F.pandas_udf(count, "int")


def with_length(
    df: DataFrame, text: str, limit: int, counter: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add n_tokens and keep (n_tokens <= limit)."""
    n = F.size(tokens(F.col(text))) if counter is None else counter(F.col(text))
    return df.withColumn("n_tokens", n).withColumn("keep", F.col("n_tokens") <= limit)


def within_length(df: DataFrame, text: str, limit: int) -> DataFrame:
    """Only the rows of at most ``limit`` tokens, with their number as n_tokens.

    The number comes out of a one-row generator, below which no filter is
    pushed: every text is tokenised once. A null text has no length and goes.
    """
    measured = df.select("*", F.explode(F.array(F.size(tokens(F.col(text))))).alias("n_tokens"))
    return measured.where(F.col("n_tokens") <= limit)


def truncate(toks: Column, limit: int) -> Column:
    return F.slice(toks, 1, limit)


def strip_prompt(output: Column, prompt: Column) -> Column:
    """Generated tokens only: what follows the prompt's tokens."""
    n = F.size(prompt)
    rest = F.greatest(F.size(output) - n, F.lit(0))
    return F.slice(output, n + 1, rest)


def filter_stats(df: DataFrame, keep: str = "keep") -> DataFrame:
    """Rows before and after the length filter, per split, in one pass."""
    return (
        df.groupBy("split")
        .agg(F.count(F.lit(1)).alias("before"), F.count_if(F.col(keep)).alias("after"))
        .withColumn("dropped", F.col("before") - F.col("after"))
        .withColumn(
            "dropped_pct",
            F.when(F.col("before") > 0, F.lit(100.0) * F.col("dropped") / F.col("before"))
            .otherwise(0.0),
        )
    )


def length_profile(df: DataFrame, lengths: dict[str, Column]) -> DataFrame:
    """Mean, p95, p99 and maximum of several token counts.

    Lengths are counted first: what reaches the percentile is one row per
    distinct length, however many texts share it.
    """
    kinds = F.explode(
        F.array(
            *[F.struct(F.lit(k).alias("kind"), n.cast("long").alias("n")) for k, n in lengths.items()]
        )
    )
    counted = df.select(kinds.alias("k")).groupBy("k.kind", "k.n").agg(F.count(F.lit(1)).alias("c"))
    p = F.percentile("n", [0.95, 0.99], F.col("c"))
    return (
        counted.groupBy("kind")
        .agg(
            F.sum("c").alias("rows"),
            (F.sum(F.col("n") * F.col("c")) / F.sum("c")).alias("mean"),
            p.alias("p"),
            F.max("n").alias("max"),
        )
        .select("kind", "rows", "mean", F.col("p")[0].alias("p95"), F.col("p")[1].alias("p99"), "max")
    )


def length_cutoffs(df: DataFrame, n: Column, cutoffs: list[int]) -> DataFrame:
    """Share of rows kept at each limit; all limits in one pass over the rows."""
    kept = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(n <= c).alias(f"k{c}") for c in cutoffs]
    )
    each = F.array(*[F.struct(F.lit(c).alias("cutoff"), F.col(f"k{c}").alias("kept")) for c in cutoffs])
    return kept.select("rows", F.explode(each).alias("x")).select(
        "x.cutoff",
        "x.kept",
        F.when(F.col("rows") > 0, F.lit(100.0) * F.col("x.kept") / F.col("rows"))
        .otherwise(0.0)
        .alias("kept_pct"),
    )


def step_budget(
    counts: DataFrame, max_steps: int, epochs: int, batch: int, devices: int, accumulation: int = 1
) -> DataFrame:
    """Training steps per split from its rows, and the rows one update sees."""
    steps = F.floor(F.col("rows") * epochs / (batch * devices))
    return counts.select(
        "split",
        "rows",
        F.least(F.lit(max_steps).cast("long"), steps).alias("steps"),
        F.lit(batch * accumulation).alias("effective_batch"),
    )
