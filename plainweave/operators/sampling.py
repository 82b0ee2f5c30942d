"""Heads, exact samples, seeded orders and positional labels.

Selections look up the few keys at their borders and then decide row by row:
the texts are neither sorted nor shuffled for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.operators.position import (
    hash_cut,
    hash_cuts,
    hash_position,
    keys_at,
    not_after,
    with_position,
)
from plainweave.operators.staging import stage

SPLITS = ["train", "val", "test"]


def head_per_split(
    df: DataFrame, n: int, order: list[str], splits: list[str] = tuple(SPLITS)
) -> DataFrame:
    """The first n rows of every listed split, or all of a smaller one; other
    rows, those without a split among them, stay."""
    if n < 1:
        return df.where(F.lit(False))
    last = keys_at(df, order, {s: [n - 1] for s in splits}, "split")
    keep = F.lit(True)
    for (split, _), row in last.items():
        keep = keep & (~F.col("split").eqNullSafe(F.lit(split)) | not_after(order, row))
    return df.where(keep)


def sample_exact(
    df: DataFrame, keys: list[str], sizes: dict[str, int], seed: int = 42
) -> DataFrame:
    """Exactly ``sizes[split]`` uniform rows of a larger split; smaller and
    unlisted splits stay whole."""
    return df.where(hash_cut(df, keys, sizes, seed, "sample", "split"))


def sample_conditions(
    df: DataFrame, keys: list[str], size: float | None, seeds: list[int]
) -> list[Column]:
    """Per seed, a condition true for a sample of ``size`` rows (as a float: that
    share of them), or for every row when no size is given."""
    if size is None:
        return [F.lit(True) for _ in seeds]
    return hash_cuts(stage(df.select(*keys)), keys, size, seeds, "sample")


def evaluation_sample(
    df: DataFrame, keys: list[str], size: float | None, seed: int = 42
) -> DataFrame:
    """The rows of one such sample."""
    return df.where(sample_conditions(df, keys, size, [seed])[0])


def shuffle_order(
    df: DataFrame, keys: list[str], seed: int = 42, within: list[str] = ()
) -> DataFrame:
    """Position of every row in a full seeded shuffle."""
    return hash_position(df, keys, seed, "shuffle", within)


def ratio_condition(df: DataFrame, keys: list[str], ratio: float, seed: int = 42) -> Column:
    """True for exactly floor(n * ratio) random rows."""
    return hash_cut(df, keys, {"all": float(ratio)}, seed, "part")


def ratio_partition(df: DataFrame, keys: list[str], ratio: float, seed: int = 42) -> DataFrame:
    """Label those rows 'ordered' and the rest 'shuffled'."""
    first = ratio_condition(df, keys, ratio, seed)
    return df.withColumn("part", F.when(first, "ordered").otherwise("shuffled"))


def part_positions(
    labelled: DataFrame, keys: list[str], order: list[str], seed: int = 42
) -> dict[str, DataFrame]:
    """Keys and position of each part: the ordered one in natural order, the
    shuffled one in seeded order."""
    narrow = list(dict.fromkeys([*keys, *order]))
    ordered = labelled.where(F.col("part") == "ordered").select(*narrow)
    shuffled = labelled.where(F.col("part") == "shuffled").select(*narrow)
    return {
        "ordered": with_position(ordered, order),
        "shuffled": hash_position(shuffled, keys, seed, "shuffle"),
    }


def positional_holdout(df: DataFrame, order: list[str], n: int = 1024) -> DataFrame:
    """Relabel: the first n rows become 'validation', the others 'train'."""
    last = keys_at(df, order, {"all": [n - 1]}).get(("all", n - 1))
    if last is None:  # no more than n rows
        return df.withColumn("split", F.lit("validation"))
    held = not_after(order, last)
    return df.withColumn("split", F.when(held, "validation").otherwise("train"))


def difficulty_tiers(
    df: DataFrame, order: list[str], as_published: bool = False, rows: int | None = None
) -> DataFrame:
    """Label thirds by position: easy, medium, hard.

    As published, 'hard' is everything before the second border: those rows
    appear twice and the last third not at all.
    """
    n = df.count() if rows is None else rows
    first, second = int(n * (1 / 3)), int(n * (2 / 3))
    wanted = sorted({b - 1 for b in (first, second) if b > 0})
    found = keys_at(df, order, {"all": wanted}) if wanted else {}

    def before(border: int):
        row = found.get(("all", border - 1))
        return F.lit(False) if row is None else not_after(order, row)

    tier = F.when(before(first), "easy").when(before(second), "medium")
    if not as_published:
        return df.withColumn("tier", tier.otherwise("hard"))
    return df.where(before(second)).withColumn("tier", F.explode(F.array(tier, F.lit("hard"))))


def batch_ids(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """Number of the fixed-size chunk each row falls in, in input order."""
    placed = with_position(df, order)
    return placed.withColumn("batch_id", F.floor(F.col("position") / F.lit(size)))
