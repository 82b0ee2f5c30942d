"""Packing of whole rows into blocks by best fit.

Rows are dealt to shards by position in key order. Within a shard the longest
rows come first, and each goes to the block with the least space that still
holds it, found in a tree over free space. The fit sees lengths only; the tokens
move once, to their blocks, and no row is cut.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plainweave.operators.position import with_position
from plainweave.operators.staging import stage

SHARD_ROWS = 100_000


class Space:
    """Blocks by free space, in a tree: a node tells whether any block below it
    is open, so the least sufficient space is found in steps of its height."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.open = [0] * (2 * self.leaves)  # blocks below each node
        self.blocks: dict[int, list[int]] = {}

    def _count(self, space: int, by: int) -> None:
        node = self.leaves + space
        while node:
            self.open[node] += by
            node >>= 1

    def put(self, space: int, block: int) -> None:
        heapq.heappush(self.blocks.setdefault(space, []), block)
        self._count(space, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The first block among those with the least space from `least` on."""
        node = self.leaves + least
        while node > 1 and not self.open[node]:
            while node > 1 and node & 1:  # nothing to the right below this parent
                node >>= 1
            if node <= 1:
                return None
            node += 1
        if node <= 1:
            return None
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        space = node - self.leaves
        self._count(space, -1)
        return space, heapq.heappop(self.blocks[space])


def best_fit(lengths: list[int], length: int) -> list[int]:
    """Block of every row: the longest rows first, equal ones in order. A row
    longer than a block has one to itself."""
    space, blocks, opened = Space(length), [0] * len(lengths), 0
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = space.take(lengths[k]) if lengths[k] <= length else None
        left, block = found if found else (length, opened)
        opened += found is None
        blocks[k] = block
        if left > lengths[k]:
            space.put(left - lengths[k], block)
    return blocks


def pack_whole(
    df: DataFrame, order: list[str], tokens: str, length: int, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Blocks of at most ``length`` tokens from whole rows (a longer row is a
    block of its own): shard, block, n_rows, n_tokens and tokens, rows in key
    order. Rows without tokens, null or empty, are left out."""
    counts = stage(df.select(*order, F.size(tokens).cast("long").alias("_n")).where(F.col("_n") > 0))
    shard = F.floor(F.col("position") / F.lit(shard_rows))
    placed = stage(with_position(counts, order).withColumn("shard", shard))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position")
        return rows[["shard", "position"]].assign(block=best_fit(rows["_n"].tolist(), length))

    # a shard is bounded by its setting, whatever the table holds
    found = placed.select("shard", "position", "_n").groupBy("shard").applyInPandas(fit, "shard long, position long, block long")
    plan = placed.drop("_n").join(found, ["shard", "position"])
    rows = df.select(*order, tokens).join(plan, order)
    ordered = F.array_sort(F.collect_list(F.struct("position", F.col(tokens).alias("piece"))))
    blocks = rows.groupBy("shard", "block").agg(F.transform(ordered, lambda x: x["piece"]).alias("_pieces"))
    return blocks.select(
        "shard", "block", F.size("_pieces").alias("n_rows"), F.flatten("_pieces").alias("tokens")
    ).withColumn("n_tokens", F.size("tokens"))


def fill_rate(blocks: DataFrame, length: int) -> DataFrame:
    """Per shard its blocks and the share of their space that tokens fill; a
    block of one long row counts as full."""
    filled = F.sum(F.least("n_tokens", F.lit(length)))
    return blocks.groupBy("shard").agg(
        F.count(F.lit(1)).alias("blocks"), F.sum("n_rows").alias("rows"), (filled / (F.count(F.lit(1)) * length)).alias("fill")
    )
