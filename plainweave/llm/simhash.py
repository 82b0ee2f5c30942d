"""Near duplicates by SimHash fingerprints, linked through BK-trees.

Two fingerprints with at most `distance` differing bits agree on at least two
of `distance + 2` blocks of bits. Fingerprints that share two blocks form a
shard; each shard's BK-tree is searched with its own members. Only distinct
fingerprints are searched, a large shard is cut into parts whose trees meet
part by part, and every task returns links to one root per linked set instead
of all pairs, so a group of copies never turns into its square.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plainweave.llm import words as W
from plainweave.operators.staging import stage

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
PART_ROWS = 1024
BITS = 64


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """Bits set in over half the hashes of the shingles; zero without a word."""
    found = (text or "").encode().lower().split()  # bytes: A-Z and ASCII space only
    if not found:
        return 0
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(found) < size:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(joined[a:b], SEED)
            for a, b in zip(starts[: len(starts) - size + 1].tolist(), ends[size - 1 :].tolist())
        ]
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1)
    most = (2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).astype(np.uint8)
    return int(np.packbits(most).view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE_WORDS) -> DataFrame:
    """`id_col` and `fp` (the 64 bits as a long) of every row."""

    def run(batches):
        for batch in W.slices(batches, "text"):
            made = [fingerprint(t.as_py(), size) for t in batch.column("text")]
            fp = np.array(made, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp)], ["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def plant(groups: np.ndarray, values: np.ndarray):
    """BK-trees, one per group, over distinct values: edges as sorted keys
    parent * 65 + distance with their children, and the root of each group."""
    roots, first = np.unique(groups, return_index=True)
    active = np.setdiff1d(np.arange(len(values)), first)
    at = first[np.searchsorted(roots, groups[active])]
    keys, children = [], []
    while len(active):
        key = at * (BITS + 1) + np.bitwise_count(values[active] ^ values[at])
        edge, lead, place = np.unique(key, return_index=True, return_inverse=True)
        keys.append(edge)
        children.append(active[lead])
        at = active[lead][place]
        rest = np.ones(len(active), bool)
        rest[lead] = False
        active, at = active[rest], at[rest]
    keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    children = np.concatenate(children) if children else np.zeros(0, np.int64)
    order = np.argsort(keys)
    return keys[order], children[order], roots, first


def search(tree, values, groups, queries, radius: int, block: int = 4096):
    """Pairs (query, node) at most `radius` bits apart: from a node at distance
    d, only edges d - radius to d + radius are followed."""
    keys, children, roots, first = tree
    for start in range(0, len(queries), block):
        q = np.arange(start, min(start + block, len(queries)))
        place = np.minimum(np.searchsorted(roots, groups[q]), max(len(roots) - 1, 0))
        there = roots[place] == groups[q] if len(roots) else np.zeros(len(q), bool)
        q, node = q[there], first[place[there]]
        while len(q):
            d = np.bitwise_count(queries[q] ^ values[node]).astype(np.int64)
            near = d <= radius
            yield q[near], node[near]
            base = node * (BITS + 1)
            low = np.searchsorted(keys, base + np.maximum(d - radius, 0))
            high = np.searchsorted(keys, base + np.minimum(d + radius, BITS), side="right")
            count = high - low
            q = np.repeat(q, count)
            step = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count)
            node = children[np.repeat(low, count) + step]


def star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links a-b as links of every node to the smallest of its connected set."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
        if np.array_equal(root, before):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _linked(radius: int):
    def pairs(table: pa.Table):
        group = np.unique(
            np.stack([table.column(c).to_numpy() for c in ("key", "a", "b")]), axis=1, return_inverse=True
        )[1].ravel()
        part, value = table.column("part").to_numpy(), table.column("fp").to_numpy().view(np.uint64)
        tree, asked = part == table.column("a").to_numpy(), part == table.column("b").to_numpy()
        values, queries = value[tree], value[asked]
        found = [(queries[q], values[n]) for q, n in search(
            plant(group[tree], values), values, group[asked], queries, radius)]
        a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
        b = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.uint64)
        far = a != b
        node, root = star(a[far], b[far])
        return pa.RecordBatch.from_arrays(
            [pa.array(node.view(np.int64)), pa.array(root.view(np.int64))], ["src", "dst"]
        )

    def run(batches):
        kept = None  # the last group of a batch may go on in the next
        for batch in batches:
            table = pa.Table.from_batches([batch] if kept is None else [*kept.to_batches(), batch])
            if table.num_rows == 0:
                continue
            ids = [table.column(c).to_numpy() for c in ("key", "a", "b")]
            same = np.ones(table.num_rows, bool)
            for c in ids:
                same &= c == c[-1]
            cut = int(np.argmax(same))  # rows of one group stand together
            if cut:
                yield pairs(table.slice(0, cut))
            kept = table.slice(cut)
        if kept is not None and kept.num_rows:
            yield pairs(kept)

    return run


def links(nodes: DataFrame, radius: int = MAX_BITS, part_rows: int = PART_ROWS) -> DataFrame:
    """Links (src, dst) that connect all fingerprints of `nodes` (distinct `fp`)
    at most `radius` bits apart, directly or through others."""
    n = radius + 2
    cuts = [BITS * i // n for i in range(n + 1)]
    block = [
        F.shiftrightunsigned("fp", cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1))
        for i in range(n)
    ]
    width = max(b - a for a, b in zip(cuts, cuts[1:]))
    keys = [
        F.lit(k << 2 * width) + F.shiftleft(block[i], width) + block[j]
        for k, (i, j) in enumerate(combinations(range(n), 2))
    ]
    rows = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))
    parts = F.ceil(F.col("n") / part_rows)
    part = F.pmod(F.xxhash64("fp", F.lit(1)), parts)
    dealt = (
        rows.join(sizes, "key")
        .withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .select("key", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "fp")
    )
    together = dealt.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "fp")
    return together.mapInArrow(_linked(radius), "src long, dst long")


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node that links reach, for every linked
    node. Large star and small star by turns; each round is written, so that a
    lost executor repeats tasks of one round only, and a hub's rows are split
    by adaptive execution."""
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    now = stage(edges.select(high.alias("u"), low.alias("v")).where("u != v").distinct())
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = stage(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u != v")
        now = stage(small.distinct())


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """`id_col`, `fp` and `component_id` (the smallest id reachable over links
    of at most `max_bits` bits) of every row.

    Null and empty texts have fingerprint zero and link like others. Repeated
    rows each get their row. A null id never names a component unless no id in
    it is known. An empty table gives an empty result; other columns of the
    input, whatever their names, play no part.
    """
    prints = stage(fingerprints(docs, id_col, text_col, shingle_words))
    ids = stage(_components(prints, id_col, max_bits, part_rows).select("fp", "component_id"))
    return prints.join(ids, "fp").select(id_col, "fp", "component_id")


def _components(prints: DataFrame, id_col: str, max_bits: int, part_rows: int) -> DataFrame:
    """root (a fingerprint that stands for the component) and component_id of
    every fingerprint `fp`."""
    nodes = stage(prints.groupBy("fp").agg(F.min(id_col).alias("first")))
    roots = stage(components(links(nodes.select("fp"), max_bits, part_rows)))
    named = stage(
        nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    )
    owners = stage(named.groupBy("root").agg(F.min("first").alias("component_id")))
    return named.join(owners, "root").select("fp", "root", "component_id")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One row of every component: the first by id, fingerprint and digest of
    its text, so that an id on different texts loses none of their groups. Rows
    with a null id stay, as nothing names them. Null and empty texts are near
    duplicates of each other; long texts count whole. An empty table gives an
    empty result; the columns of `docs` may bear any names."""
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"))
    prints = stage(fingerprints(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", shingle_words))
    prints = prints.select(F.col("key.id").alias("id"), F.col("key.digest").alias("digest"), "fp")
    ids = stage(_components(prints.select("id", "fp"), "id", max_bits, part_rows).select("fp", "root"))
    first = F.min(F.struct("id", "fp", "digest")).alias("f")
    chosen = prints.where(F.col("id").isNotNull()).join(ids, "fp").groupBy("root").agg(first).select("f.id", "f.digest")
    names = {c: f"k{n}" for n, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(c).alias(k) for c, k in names.items()], F.xxhash64(text_col).alias("_digest"))
    own = names[id_col]
    joined = rows.join(chosen, (F.col(own) == F.col("id")) & (F.col("_digest") == F.col("digest")))
    order = Window.partitionBy(own, "_digest").orderBy("_digest")
    once = joined.withColumn("_place", F.row_number().over(order)).where(F.col("_place") == 1)
    kept = once.select(*[F.col(names[c]).alias(c) for c in docs.columns])
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
