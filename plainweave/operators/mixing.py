"""Interleaving sources by probability and packing token sequences."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from plainweave.functions.hashing import uniform
from plainweave.operators.position import with_position
from plainweave.operators.staging import stage

MIN_BLOCK, MAX_BLOCKS = 65_536, 65_536
REPEATS_PER_COPY = 1000


def _draws(spark: SparkSession, probabilities: list[float], seed: int, lo: int, hi: int):
    """Positions lo..hi-1, each with the source its draw falls on."""
    u = uniform(seed, "interleave", ["row_id"])
    source, edge = F.lit(len(probabilities) - 1), 1.0
    for s in range(len(probabilities) - 1, 0, -1):
        edge = sum(probabilities[:s])
        source = F.when(u < edge, F.lit(s - 1)).otherwise(source)
    return spark.range(lo, hi).select(F.col("id").alias("row_id")).withColumn("source", source)


def _blocks(draws: DataFrame, size: int) -> DataFrame:
    """Rows per (block, source) and their number up to each block; at most
    MAX_BLOCKS rows per source."""
    upto = W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    return (
        draws.groupBy(_block(size).alias("block"), "source")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(upto))
    )


def _block(size: int) -> Column:
    return F.floor(F.col("row_id") / F.lit(size))


def _nth(
    spark: SparkSession, probabilities: list[float], seed: int, source: int, k: int, lo: int, hi: int
) -> int:
    """The position from lo on at which the source is drawn for the k-th time:
    the range is cut by counts until one small block is left to rank."""
    while hi - lo > MIN_BLOCK:
        size = max(MIN_BLOCK, math.ceil((hi - lo) / MAX_BLOCKS))
        before = F.col("_upto") - F.col("_n")
        hit = (
            _blocks(_draws(spark, probabilities, seed, lo, hi), size)
            .where((F.col("source") == source) & (before < k) & (F.col("_upto") >= k))
            .select("block", (F.lit(k) - before).alias("k"))
            .first()
        )
        k, start = hit["k"], hit["block"] * size
        lo, hi = max(lo, start), min(hi, start + size)
    draws = _draws(spark, probabilities, seed, lo, hi).where(F.col("source") == source)
    rank = F.row_number().over(W.orderBy("row_id"))  # one block
    return draws.withColumn("k", rank).where(F.col("k") == k).first()["row_id"]


def _last_position(
    spark: SparkSession, sizes: list[int], probabilities: list[float], seed: int
) -> tuple[int, int]:
    """The position at which the last source is exhausted, and the block size.

    Counts per block tell which block each source's n-th draw falls in; only
    that block is looked at row by row.
    """
    length = math.ceil(1.2 * max(n / p for n, p in zip(sizes, probabilities, strict=True))) + 1000
    while True:
        size = max(MIN_BLOCK, math.ceil(length / MAX_BLOCKS))
        wanted = F.element_at(F.array(*[F.lit(n) for n in sizes]), F.col("source") + 1)
        hits = (
            _blocks(_draws(spark, probabilities, seed, 0, length), size)
            .withColumn("_wanted", wanted)
            .where(
                (F.col("_upto") - F.col("_n") < F.col("_wanted"))
                & (F.col("_wanted") <= F.col("_upto"))
            )
            .select("source", "block", (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("k"))
            .collect()
        )  # one row per source
        if len(hits) == len(sizes):
            break
        length *= 2  # some source was drawn too rarely
    ends = []
    for hit in hits:
        lo = hit["block"] * size
        ends.append(_nth(spark, probabilities, seed, hit["source"], hit["k"], lo, min(lo + size, length)))
    return max(ends), size


def interleave(
    rows: DataFrame, parts: list[DataFrame], keys: list[str], probabilities: list[float],
    seed: int = 42,
) -> DataFrame:
    """Draw a source for every output position until all are exhausted; a source
    that runs out starts again, so its rows repeat.

    ``rows`` holds the data with an int column ``source``; ``parts`` gives, per
    source, the keys and their 0-based ``position``. The result has ``row_id``
    as output position. Positions are matched to keys first, in narrow tables;
    the data itself moves once. A source repeated very often is copied, so that
    no single key has to serve more than REPEATS_PER_COPY positions.
    """
    spark = rows.sparkSession
    counted = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {r["source"]: r["n"] for r in counted}
    sizes = [found.get(s, 0) for s in range(len(parts))]
    if min(sizes) == 0:
        raise ValueError("an empty source can never be exhausted")
    end, size = _last_position(spark, sizes, probabilities, seed)
    draws = _draws(spark, probabilities, seed, 0, end + 1)
    inside = W.partitionBy("block", "source").orderBy("row_id")
    before = _blocks(draws, size).select(
        "block", "source", (F.col("_upto") - F.col("_n")).alias("_before")
    )
    n = F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("source") + 1)
    copies = [max(1, math.ceil((end + 1) / s / REPEATS_PER_COPY)) for s in sizes]
    salts = F.element_at(F.array(*[F.lit(c) for c in copies]), F.col("source") + 1)
    drawn = (
        draws.withColumn("block", _block(size))
        .withColumn("_rank", F.row_number().over(inside))
        .join(before, ["block", "source"])
        .withColumn("_k", F.col("_before") + F.col("_rank") - 1)
        .select(
            "row_id", "source", (F.col("_k") % n).alias("position"),
            (F.floor(F.col("_k") / n) % salts).alias("_salt"),
        )
    )

    def salted(df: DataFrame) -> DataFrame:
        if max(copies) == 1:
            return df.withColumn("_salt", F.lit(0).cast("long"))
        every = F.sequence(F.lit(0).cast("long"), (salts - 1).cast("long"))
        return df.withColumn("_salt", F.explode(every))

    places = None
    for s, part in enumerate(parts):
        one = part.select(*keys, "position", F.lit(s).alias("source"))
        places = one if places is None else places.unionByName(one)
    plan = drawn.join(salted(places), ["source", "position", "_salt"])
    plan = plan.select("row_id", "source", "_salt", *keys)
    return salted(rows).join(plan, ["source", "_salt", *keys]).drop("_salt")


def pack_sequences(
    df: DataFrame, order: list[str], tokens: str, length: int, shard_rows: int = 100_000
) -> DataFrame:
    """Concatenate token lists in key order and cut them into blocks of
    ``length`` tokens.

    Rows are grouped into shards of ``shard_rows`` positions; blocks do not
    cross shards, so the last one of a shard may be short. The running sum is
    over counts only, a shard and a block are bounded by their settings, and
    the tokens move once to rows and once to blocks.
    """
    counts = stage(
        df.select(*order, F.size(tokens).cast("long").alias("_n")).where(F.col("_n") > 0)
    )
    shard = F.floor(F.col("position") / F.lit(shard_rows))
    upto = W.partitionBy("shard").orderBy("position").rowsBetween(W.unboundedPreceding, 0)
    places = (
        with_position(counts, order)
        .withColumn("shard", shard)
        .withColumn("_start", F.sum("_n").over(upto) - F.col("_n"))
        .select(*order, "shard", "_n", "_start")
    )
    first = F.floor(F.col("_start") / F.lit(length))
    last = F.floor((F.col("_start") + F.col("_n") - 1) / F.lit(length))

    b, start, n = F.col("block"), F.col("_start"), F.col("_n")
    lo = F.greatest(b * length, start)
    hi = F.least((b + 1) * length, start + n)
    # a slice per output row: inside a higher-order function each one would
    # copy the whole list
    cut = F.slice(F.col(tokens), (lo - start + 1).cast("int"), (hi - lo).cast("int"))
    pieces = (
        df.select(*order, tokens)
        .join(places, order)
        .select("shard", "_start", "_n", tokens, F.explode(F.sequence(first, last)).alias("block"))
        .select("shard", "block", lo.alias("at"), cut.alias("piece"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("at", "piece")))
    return (
        pieces.groupBy("shard", "block")
        .agg(F.flatten(F.transform(ordered, lambda x: x["piece"])).alias("tokens"))
        .withColumn("n_tokens", F.size("tokens"))
    )
