"""Cleaning and describing a corpus of (prompt, result) pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.functions.chat import conversation, instruction, two_turns
from plainweave.functions.text import normal_tokens, sentences, words
from plainweave.operators import alignment
from plainweave.operators.position import with_position
from plainweave.operators.sari import placed
from plainweave.operators.staging import stage


PART_BYTES = 1 << 20  # of text in a part that is compared


def complete(df: DataFrame) -> DataFrame:
    """Rows with both texts."""
    return df.where(F.col("prompt").isNotNull() & F.col("result").isNotNull())


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split, and how many of them lack a text."""
    lacking = F.col("prompt").isNull() | F.col("result").isNull()
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(lacking).alias("incomplete")
    )


def split_examples(df: DataFrame, order: list[str]) -> DataFrame:
    """The first complete row of every split, as its example."""
    first = F.min_by(F.struct("prompt", "result"), F.struct(*order))
    return complete(df).groupBy("split").agg(first.alias("example")).select("split", "example.*")


def exclude_toxic(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Drop rows labelled toxic; rows without a label stay."""
    toxic = labels.where(F.col("toxic") == 1).select(key)
    return df.join(toxic, key, "left_anti")


def drop_duplicates(df: DataFrame, texts: list[str], key: str | list[str]) -> DataFrame:
    """Keep the row with the lowest key, of one column or several, of each group
    of equal texts.

    Copies are reduced to (digest, lowest key) inside each task before anything
    moves, so neither the texts nor a large group of copies are shuffled; the
    kept keys then select the full rows.
    """
    joined = F.to_json(F.array(*[F.col(t) for t in texts]))
    keys = [key] if isinstance(key, str) else list(key)
    kept = df.groupBy(F.sha2(joined, 256).alias("_digest")).agg(F.min(F.struct(*keys)).alias("_key"))
    return df.join(kept.select("_key.*"), keys, "left_semi")


def difference(prompt: Column, result: Column) -> Column:
    """Share of the distinct tokens of both texts that only one of them has.

    Linear in the text length, unlike an edit distance.
    """
    a = F.array_distinct(normal_tokens(prompt))
    b = F.array_distinct(normal_tokens(result))
    both = F.size(F.array_intersect(a, b))
    return F.lit(1.0) - both / (F.size(a) + F.size(b) - both)


def edit_difference(prompt: Column, result: Column) -> Column:
    """Edit distance of the tokens over the longer text's number: the order of
    words counts. A missing text has no difference."""
    both = prompt.isNotNull() & result.isNotNull()
    return F.when(both, alignment.edit_difference(normal_tokens(prompt), normal_tokens(result)))


def difficulty_order(
    df: DataFrame, keys: list[str], measure: Callable[[Column, Column], Column] = difference
) -> DataFrame:
    """Keys, difference and position in the curriculum: least changed first.

    The texts are placed by their size: after a join of few bytes adaptive
    execution would compare them all in a few tasks. The differences are written
    before they are ranked, since ranking samples its input first and would
    compute them twice.
    """
    texts = placed(df, keys, ["prompt", "result"], per_part=PART_BYTES)
    changed = measure(F.col("prompt"), F.col("result")).alias("difference")
    return with_position(stage(texts.select(*keys, changed)), ["difference", *keys])


def add_instruction(df: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """Choose an instruction per row; an existing one is overwritten."""
    return df.withColumn("instruction", instruction(F.col("prompt"), keys, seed))


def add_two_turns(df: DataFrame) -> DataFrame:
    """Source columns stay; messages holds instruction + prompt and the result."""
    turns = two_turns(F.col("prompt"), F.col("result"), F.col("instruction"))
    return df.withColumn("messages", conversation(turns))


def label_generated(df: DataFrame) -> DataFrame:
    """Mark texts as written by a model."""
    return df.withColumn("ai_generated", F.lit(True))


def simplicity(df: DataFrame, source: str, text: str) -> DataFrame:
    """Length ratio to the source, words per sentence and letters per word."""
    w, s = words(F.col(text)), sentences(F.col(text))
    n_words, n_sents = F.size(w), F.size(s)
    letters = F.length(F.array_join(w, ""))
    return df.select(
        "*",
        F.when(F.length(source) > 0, F.length(text) / F.length(source)).alias("length_ratio"),
        F.when(n_sents > 0, n_words / n_sents).alias("words_per_sentence"),
        F.when(n_words > 0, letters / n_words).alias("letters_per_word"),
    )
