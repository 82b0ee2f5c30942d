"""Corpus preparation: part ordered and part shuffled training rows interleaved,
the other splits shuffled, every row turned into a two-turn conversation."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plainweave.operators.corpus import add_instruction, add_two_turns, complete
from plainweave.operators.mixing import interleave
from plainweave.operators.position import with_position
from plainweave.operators.sampling import part_positions, ratio_condition, shuffle_order
from plainweave.operators.staging import stage


def mix_training(
    train: DataFrame, keys: list[str], order: list[str], ratio: float = 0.7, seed: int = 42
) -> DataFrame:
    """Interleave the ordered and the shuffled part by their share; adds row_id.

    The keys are written once and all counting, ranking and placing is done on
    them; the rows themselves are read and moved once, at the end.
    """
    narrow = stage(train.select(*dict.fromkeys([*keys, *order])))
    n = narrow.count()
    if math.floor(n * ratio) in (0, n):  # one part is empty: the other alone
        alone = shuffle_order(narrow, keys, seed) if math.floor(n * ratio) == 0 else with_position(narrow, order)
        places = alone.select(*keys, F.col("position").alias("row_id"))
        part = "shuffled" if math.floor(n * ratio) == 0 else "ordered"
        return train.join(places, keys).withColumns({"part": F.lit(part), "source": F.lit(int(part == "shuffled"))})
    first = ratio_condition(narrow, keys, ratio, seed)
    part = F.when(first, "ordered").otherwise("shuffled")
    places = part_positions(narrow.withColumn("part", part), keys, order, seed)
    rows = train.withColumn("part", part).withColumn(
        "source", F.when(F.col("part") == "ordered", 0).otherwise(1)
    )
    parts = [places["ordered"], places["shuffled"]]
    return interleave(rows, parts, keys, [ratio, 1 - ratio], seed)


def prepare_corpus(
    corpus: DataFrame, keys: list[str], order: list[str], ratio: float = 0.7, seed: int = 42
) -> DataFrame:
    """All splits formatted; row_id is the position within the split. Rows
    without a split are one more split."""
    rows = complete(corpus)
    train = mix_training(rows.where(F.col("split") == "train"), keys, order, ratio, seed)
    others = shuffle_order(rows.where(~F.col("split").eqNullSafe("train")), keys, seed, ["split"])
    columns = list(dict.fromkeys(["split", "row_id", *keys, "prompt", "result"]))
    mixed = train.select(*columns).unionByName(
        others.withColumnRenamed("position", "row_id").select(*columns)
    )
    return add_two_turns(add_instruction(mixed, keys, seed))
