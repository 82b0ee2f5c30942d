"""Training-set build: head, render, measure, filter, count, sample."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.functions.chat import formatter
from plainweave.operators.corpus import complete
from plainweave.operators.lengths import filter_stats, with_length
from plainweave.operators.sampling import head_per_split, sample_exact
from plainweave.operators.staging import stage

SAMPLE_SIZES = {"val": 1_000, "test": 10_000}


def formatted(
    corpus: DataFrame, keys: list[str], limit: int = 1024, template: str = "role_tags",
    system: str | None = None, counter: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Rendered text, its number of tokens and whether it fits; source columns go."""
    text = formatter(template, system)(F.col("prompt"), F.col("result"))
    rendered = complete(corpus).select(*keys, "split", text.alias("formatted_text"))
    return with_length(rendered, "formatted_text", limit, counter)


def training_set(
    corpus: DataFrame, keys: list[str], order: list[str], limit: int = 1024,
    head: int | None = None, sizes: dict[str, int] | None = None, seed: int = 42,
    counter: Callable[[Column], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The final rows and the filter statistics.

    Tokens are counted once: statistics, sampling and the result all read the
    written, already measured rows.
    """
    rows = corpus if head is None else head_per_split(corpus, head, order)
    measured = stage(formatted(rows, keys, limit, counter=counter))
    kept = measured.where("keep").drop("keep")
    chosen = sample_exact(kept, keys, SAMPLE_SIZES if sizes is None else sizes, seed)
    return chosen, filter_stats(measured)
