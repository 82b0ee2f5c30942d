"""Row positions, running totals and order statistics without a window over
the whole table.

Two orders occur. *Natural order* (by key columns) is range-partitioned: Spark
samples the keys, every task sorts its own range, and only one number per range
is summed up across ranges. *Seeded order* (by digest) needs no sampling, since
leading hex digits already are equal-sized buckets.

The order columns together must be unique, as a row id is: a value that many
rows share would otherwise put them all into one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from plainweave.functions.hashing import bucket, order_key, row_key
from plainweave.operators.staging import stage

RANGE_ROWS = 4_000_000  # rows a range holds at most, about


def _of(within: list[str]) -> Column:
    """The group as one value that is never null, so that rows without a group
    join as a group of their own."""
    return F.struct(*within) if within else F.lit(0)


def join_groups(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Left join on group columns where null equals null."""
    rest = [c for c in right.columns if c not in by]
    keyed = right.select(_of(by).alias("_of"), *rest)
    return left.withColumn("_of", _of(by)).join(keyed, "_of", "left").drop("_of")


def range_number(rows: int, setting: int, per_range: int) -> int:
    """Ranges for so many rows; never fewer than the session's partitions."""
    return max(setting, -(-rows // per_range))


def in_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """Sorted ranges with columns _range and _at (0-based within the range),
    and _id, which rises through both.

    Range borders come from a sample and may differ between two runs of the
    same plan, so the numbered rows are written before anything counts them.
    """
    setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = range_number(df.count(), setting, RANGE_ROWS)
    # within the setting, adaptive execution may merge small ranges
    parts = [wanted] if wanted > setting else []
    numbered = (
        df.repartitionByRange(*parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    return stage(numbered).select(
        "*",
        F.shiftright("_id", 33).alias("_range"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"),
    )


def with_position(
    df: DataFrame, order: list[str], within: list[str] = (), name: str = "position"
) -> DataFrame:
    """0-based position in key order, counted over the whole table or per group.

    Pass only the columns needed: they are all sorted and written once, and read
    twice, since borders are sampled first; stage what is dear to compute. A
    group may be as large as it likes, because ranges cut through groups.
    """
    within = list(within)
    ranged = in_ranges(df, within + order).withColumn("_of", _of(within))
    group = ["_range", "_of"]
    # one row per range and group, so a group in several ranges has several rows
    starts = ranged.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    upto = W.partitionBy("_of").orderBy("_range").rowsBetween(W.unboundedPreceding, 0)
    offsets = starts.select(
        *group, (F.sum("_n").over(upto) - F.col("_n") - F.col("_first")).alias("_offset")
    )
    if not within:  # then its size is the number of ranges, a setting
        offsets = F.broadcast(offsets)
    # the range is part of the join key, so a large group is not one join key
    placed = ranged.join(offsets, group)
    return placed.select(*df.columns, (F.col("_offset") + F.col("_at")).alias(name))


def running(
    df: DataFrame, order: list[str], sums: dict[str, str], within: list[str] = (),
    total: str | None = None,
) -> DataFrame:
    """Running sums in key order: ``sums`` maps new column to summed column.
    Nulls add nothing; a sum over nulls alone is null. ``total`` names a column
    for the group's whole sum of the first of them."""
    within = list(within)
    ranged = in_ranges(df, within + order).withColumn("_of", _of(within))
    group = ["_range", "_of"]
    totals = ranged.groupBy(*group).agg(*[F.sum(c).alias(f"_sum_{o}") for o, c in sums.items()])
    # one row per range and group; a group's rows here are at most the ranges
    earlier = W.partitionBy("_of").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    whole = [] if total is None else [
        F.sum(f"_sum_{next(iter(sums))}").over(W.partitionBy("_of")).alias(total)
    ]
    before = totals.select(
        *group, *[F.sum(f"_sum_{o}").over(earlier).alias(f"_before_{o}") for o in sums], *whole
    )
    inside = W.partitionBy(*group).orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    local = ranged.select(
        "*", *[F.sum(c).over(inside).alias(f"_local_{o}") for o, c in sums.items()]
    )
    joined = local.join(before, group)
    return joined.select(
        *df.columns,
        *[
            F.coalesce(F.col(f"_before_{o}") + F.col(f"_local_{o}"), f"_before_{o}", f"_local_{o}").alias(o)
            for o in sums
        ],
        *([] if total is None else [total]),
    )


def hash_position(
    df: DataFrame,
    keys: list[str],
    seed: int,
    purpose: str = "shuffle",
    within: list[str] = (),
    name: str = "position",
) -> DataFrame:
    """0-based position in seeded random order.

    Buckets of the digest carry the same share of the rows whatever the keys
    are, and cut through groups of any size; the offset table has at most 65,536
    rows per group.
    """
    within = list(within)
    keyed = df.withColumn("_order", order_key(seed, purpose, keys)).withColumns(
        {"_bucket": bucket(F.col("_order")), "_of": _of(within)}
    )
    group = ["_of", "_bucket"]
    earlier = W.partitionBy("_of").orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    before = (
        keyed.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*group, (F.sum("_n").over(earlier) - F.col("_n")).alias("_before"))
    )
    inside = W.partitionBy(*group).orderBy("_order", row_key(keys))
    local = keyed.withColumn("_rank", F.row_number().over(inside))
    return local.join(before, group).select(
        *df.columns, (F.col("_before") + F.col("_rank") - 1).alias(name)
    )


def _borders(keyed: DataFrame, sizes: dict) -> dict:
    """Per group the last row (_order, _key) among its first ``sizes[group]``
    rows; None for no rows at all, and no entry where the group has no more.

    Counts per bucket say which bucket holds that row, and that bucket alone is
    ranked. Both jobs read narrow columns and return one row per listed group.
    """
    keyed = keyed.where(F.col("_group").isin(list(sizes))).withColumn(
        "_bucket", bucket(F.col("_order"))
    )
    by_bucket = W.partitionBy("_group").orderBy("_bucket")
    counts = (
        keyed.groupBy("_group", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(by_bucket.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_n").over(W.partitionBy("_group")))
    )
    size = None
    for name, k in sizes.items():
        rows = F.floor(F.col("_total") * F.lit(k)) if isinstance(k, float) else F.lit(k)
        is_name = F.col("_group") == name
        rows = rows.cast("long")
        size = F.when(is_name, rows) if size is None else size.when(is_name, rows)
    before = F.col("_upto") - F.col("_n")
    holds_last = (before < F.col("_size")) & (F.col("_size") <= F.col("_upto"))
    found = (
        counts.withColumn("_size", size)
        .where((F.col("_size") < F.col("_total")) & (holds_last | (F.col("_size") + before == 0)))
        .select("_group", "_bucket", (F.col("_size") - before).alias("_rest"))
        .collect()
    )
    last = {row["_group"]: None for row in found}
    ranked = [row for row in found if row["_rest"] > 0]
    if not ranked:
        return last
    here = None
    for row in ranked:
        at = (F.col("_group") == row["_group"]) & (F.col("_bucket") == row["_bucket"])
        here = at if here is None else here | at
    rest = F.create_map(*[F.lit(x) for row in ranked for x in (row["_group"], row["_rest"])])
    rank = F.row_number().over(W.partitionBy("_group").orderBy("_order", "_key"))
    rows = (
        keyed.where(here)
        .withColumn("_rank", rank)
        .where(F.col("_rank") == F.element_at(rest, F.col("_group")))
        .select("_group", "_order", "_key")
        .collect()
    )
    return {**last, **{row["_group"]: (row["_order"], row["_key"]) for row in rows}}


def _not_behind(order: Column, keys: list[str], border: tuple | None) -> Column:
    if border is None:
        return F.lit(False)
    return F.struct(order, row_key(keys)) <= F.struct(F.lit(border[0]), F.lit(border[1]))


def hash_cut(
    df: DataFrame,
    keys: list[str],
    sizes: dict,
    seed: int,
    purpose: str,
    group: str | None = None,
) -> Column:
    """Predicate true for exactly the first ``sizes[g]`` rows of each group in
    seeded order (all rows where a group has no more, or is not listed, or null).
    Without a group column the only group is "all".

    A size given as float is a share of the group's rows. Only the row at the
    border is looked for; the wide rows are then kept or dropped one by one,
    without a shuffle.
    """
    g = F.lit("all") if group is None else F.col(group)
    order = order_key(seed, purpose, keys)
    keyed = df.select(g.alias("_group"), order.alias("_order"), row_key(keys).alias("_key"))
    keep = F.lit(True)
    for name, border in _borders(keyed, sizes).items():
        ok = _not_behind(order, keys, border)
        keep = keep & (ok if group is None else ~g.eqNullSafe(F.lit(name)) | ok)
    return keep


def hash_cuts(
    df: DataFrame, keys: list[str], size: float, seeds: list[int], purpose: str
) -> list[Column]:
    """One such predicate per seed, over the whole frame; found together."""
    orders = [order_key(seed, purpose, keys) for seed in seeds]
    each = F.array(
        *[
            F.struct(F.lit(str(s)).alias("_group"), o.alias("_order"))
            for s, o in zip(seeds, orders, strict=True)
        ]
    )
    keyed = df.select(row_key(keys).alias("_key"), F.inline(each))
    borders = _borders(keyed, {str(s): size for s in seeds})
    return [
        _not_behind(o, keys, borders[str(s)]) if str(s) in borders else F.lit(True)
        for s, o in zip(seeds, orders, strict=True)
    ]


def keys_at(df: DataFrame, order: list[str], ranks: dict, group: str | None = None) -> dict:
    """Key values at given 0-based positions: {(group, rank): Row of keys}.

    ``ranks`` maps a group (or "all") to its wanted positions; the answer has
    one row per wanted position, so it is small by construction. Counts per
    range say where each position is; only the rows there are then read.
    """
    g = F.lit("all") if group is None else F.col(group)
    narrow = df.select(g.alias("_group"), *order).where(F.col("_group").isin(list(ranks)))
    ranged = in_ranges(narrow, ["_group", *order])
    upto = W.partitionBy("_group").orderBy("_range").rowsBetween(W.unboundedPreceding, 0)
    wanted = F.create_map(
        *[x for name, rs in ranks.items() for x in (F.lit(name), F.array(*[F.lit(int(r)) for r in rs]))]
    )
    before = F.col("_upto") - F.col("_n")
    found = (
        ranged.groupBy("_group", "_range")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
        .withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("position", F.explode(F.element_at(wanted, F.col("_group"))))
        .where((before <= F.col("position")) & (F.col("position") < F.col("_upto")))
        .select("_group", "position", (F.col("_first") + F.col("position") - before).alias("_id"))
        .collect()
    )
    if not found:
        return {}
    at = {r["_id"]: (r["_group"], r["position"]) for r in found}
    rows = ranged.where(F.col("_id").isin(list(at))).select("_id", *order).collect()
    return {at[r["_id"]]: r for r in rows}


def not_after(order: list[str], row) -> Column:
    """True for rows whose key is not after the given row's key."""
    fields = row.__fields__
    values = [F.lit(row[fields.index(c)]) for c in order]
    return F.struct(*[F.col(c) for c in order]) <= F.struct(
        *[v.alias(c) for v, c in zip(values, order, strict=True)]
    )


def quantiles(df: DataFrame, within: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    Equal values are counted before anything moves, so a value shared by a
    third of the rows is one row; the counted values are then summed up in
    ranges. The built-in exact percentile would hold all values of a group in
    one task.
    """
    groups = list(within) or ["_all"]
    rows = df if within else df.withColumn("_all", F.lit(0))
    counted = rows.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    summed = running(counted, [value], {"_upto": "_n"}, groups, "_total")

    def at(rank: Column) -> Column:
        here = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(here, F.col(value)))

    aggs = []
    for name, q in shares.items():
        rank = F.lit(q) * (F.col("_total") - 1)
        low, high = F.floor(rank), F.ceil(rank)
        aggs += [at(low).alias(f"_lo_{name}"), at(high).alias(f"_hi_{name}"),
                 F.max(rank - low).alias(f"_f_{name}")]
    found = summed.groupBy(*groups).agg(*aggs)
    return found.select(
        *within,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n)
            for n in shares
        ],
    )
