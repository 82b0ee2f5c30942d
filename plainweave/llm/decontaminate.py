"""Documents that repeat passages of a benchmark, by suffix arrays.

Every slice of documents is a shard with a suffix array over its words, held
as numbers of the benchmark's vocabulary. Each suffix of each benchmark item
of at least a window is looked up in it, to the window's length, by binary
search; matches on one diagonal are joined into
longest verbatim matches with their places. A document's result is found in
its own shard, so documents are never shuffled.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plainweave.llm import words as W
from plainweave.operators.staging import stage

WINDOW = 13
BLOCK_CHARS = 16 << 20
SLOTS = 1 << 14
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {a: a + 32 for a in range(0x41, 0x5B)}
SEED = 13

MATCH = "array<struct<item_id:string,doc_start:long,item_start:long,n_words:long>>"
COLUMNS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest", "matches"]


class TestItems:
    """Words of benchmark items as numbers, and the windows to look up."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        found = [(i, WORD.findall(t.translate(LOWER))) for i, t in items]
        self.names = sorted({i for i, w in found if w})
        number = {name: n for n, name in enumerate(self.names)}
        vocabulary = sorted({w for _, ws in found for w in ws})
        raw = "\n".join(vocabulary).encode()
        data = np.frombuffer(raw, np.uint8)
        starts, ends, _ = W.split(data, np.array([0, len(data)]), W.letters_digits())
        hashed = W.Hasher(SEED, lower=True).words(data, starts, ends)
        order = np.argsort(hashed)
        self.hashes = hashed[order]
        ids = {vocabulary[k]: n + 1 for n, k in enumerate(order)}
        self.per = 64 // max(1, len(vocabulary).bit_length())
        self.bits = 64 // self.per
        self.depth = -(-window // self.per)
        asked, item, offset, size = [], [], [], []
        for name, ws in found:
            row = [ids[w] for w in ws]
            length = min(window, len(row))
            for at in range(len(row) - length + 1 if row else 0):
                asked.append(row[at : at + length] + [0] * (window - length))
                item.append(number[name])
                offset.append(at)
                size.append(length)
        self.item, self.offset, self.size = (np.array(x, np.int64) for x in (item, offset, size))
        words = np.array(asked, np.uint64).reshape(-1, window)
        self.low = pack(words, self.per, self.bits)
        top = np.arange(window)[None, :] >= self.size[:, None]
        self.high = pack(np.where(top, np.uint64((1 << self.bits) - 1), words), self.per, self.bits)
        self.shortest = int(self.size.min()) if len(self.size) else window


def pack(words: np.ndarray, per: int, bits: int) -> np.ndarray:
    """Rows of word numbers as rows of 64-bit numbers in the same order."""
    n, size = words.shape
    depth = -(-size // per)
    full = np.zeros((n, depth * per), np.uint64)
    full[:, :size] = words
    out = np.zeros((depth, n), np.uint64)
    for j in range(depth * per):
        out[j // per] = (out[j // per] << np.uint64(bits if j % per else 0)) | full[:, j]
    return out


def bound(keys: np.ndarray, asked: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of all columns of `asked` in the sorted columns of `keys`."""
    n = keys.shape[1]
    low = np.zeros(asked.shape[1], np.int64)
    high = np.full(asked.shape[1], n)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = np.minimum((low + high) // 2, n - 1)
        less, same = np.zeros(len(mid), bool), np.ones(len(mid), bool)
        for k, a in zip(keys, asked):
            value = k[mid]
            less |= same & (value < a)
            same &= value == a
        less |= same & after
        low = np.where(open_ & less, mid + 1, low)
        high = np.where(open_ & ~less, mid, high)


def occurrences(ids: np.ndarray, row: np.ndarray, tests: TestItems, window: int):
    """(looked-up window, place) of every occurrence in a shard of word numbers,
    0 standing for a word the benchmark does not have. `row`: of each word."""
    if not len(tests.item) or not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # a suffix is left out if words of the benchmark end before its shortest window
    stop = (ids == 0) | np.append(row[1:] != row[:-1], True)
    stops = np.flatnonzero(stop)
    end = stops[np.searchsorted(stops, np.arange(len(ids)))] + (ids[stops][np.searchsorted(stops, np.arange(len(ids)))] != 0)
    run = end - np.arange(len(ids))
    at = np.flatnonzero(run >= tests.shortest)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = np.zeros((len(at), window), np.uint64)
    for j in range(window):
        inside = run[at] > j
        words[inside, j] = ids[at[inside] + j]
    keys = pack(words, tests.per, tests.bits)
    order = np.lexsort(keys[::-1])
    keys, at = keys[:, order], at[order]
    low, high = bound(keys, tests.low, False), bound(keys, tests.high, True)
    count = high - low
    asked = np.repeat(np.arange(len(low)), count)
    step = np.arange(len(asked)) - np.repeat(np.cumsum(count) - count, count)
    return asked, at[np.repeat(low, count) + step]


def _scan(tests, window: int, names: list[str], text_col: str):
    tests = tests.value
    hasher = W.Hasher(SEED, lower=True)
    kind = W.letters_digits()
    item_names = np.array(tests.names, object)

    def matched(batch):
        data, rows = W.column_bytes(batch.column(text_col))
        starts, ends, first = W.split(data, rows, kind)
        row = W.row_of_word(first)
        ids = np.zeros(len(starts), np.uint64)
        if len(tests.hashes) and len(starts):
            hashed = hasher.words(data, starts, ends)
            place = np.minimum(np.searchsorted(tests.hashes, hashed), len(tests.hashes) - 1)
            ids = np.where(tests.hashes[place] == hashed, place + 1, 0).astype(np.uint64)
        asked, at = occurrences(ids, row, tests, window)
        item, diagonal, size = tests.item[asked], at - tests.offset[asked], tests.size[asked]
        order = np.lexsort((at, diagonal, item))
        item, diagonal, size, at = item[order], diagonal[order], size[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (at[1:] != at[:-1] + 1)
        new[1:] |= row[at[1:]] != row[at[:-1]]
        lead = np.flatnonzero(new)
        last = np.append(lead[1:], len(at)) - 1 if len(lead) else lead
        start, end = at[lead], at[last] + size[last]
        place = row[start] if len(start) else start
        by_row = np.lexsort((item[lead], start, place))
        out = [[] for _ in range(batch.num_rows)]
        for k in by_row.tolist():
            r = int(place[k])
            out[r].append({
                "item_id": item_names[item[lead[k]]],
                "doc_start": int(start[k] - first[r]),
                "item_start": int(start[k] - diagonal[lead[k]]),
                "n_words": int(end[k] - start[k]),
            })
        return np.diff(first), out

    def run(batches):
        for batch in W.slices(batches, text_col):
            n_words, found = matched(batch)
            earlier = batch.column("matches").to_pylist() if "matches" in names else [None] * batch.num_rows
            found = [(e or []) + f for e, f in zip(earlier, found)]
            keep = [c for c in batch.schema.names if c not in ("n_words", "matches")]
            kind = T_MATCH
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(n_words, pa.int64()), pa.array(found, kind)],
                [*keep, "n_words", "matches"],
            )

    return run


T_MATCH = pa.list_(pa.struct([
    ("item_id", pa.string()), ("doc_start", pa.int64()), ("item_start", pa.int64()), ("n_words", pa.int64()),
]))


def _judged(keep: list[str], share: int):
    def run(batches):
        for batch in batches:
            n_words = batch.column("n_words").to_pylist()
            hit, items, digest, longest = [], [], [], []
            for found in batch.column("matches").to_pylist():
                covered = 0
                upto = 0
                for start, end in sorted((m["doc_start"], m["doc_start"] + m["n_words"]) for m in found or []):
                    covered += max(0, end - max(start, upto))
                    upto = max(upto, end)
                names = sorted({m["item_id"] for m in found or []})
                hit.append(covered)
                items.append(len(names))
                digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
                longest.append(max((m["n_words"] for m in found or []), default=0))
            bad = [h > 0 and share * h >= n for h, n in zip(hit, n_words)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), batch.column("n_words"), pa.array(hit, pa.int64()),
                 pa.array(items, pa.int64()), pa.array(digest, pa.string()), pa.array(bad, pa.bool_()),
                 pa.array(longest, pa.int64()), batch.column("matches")],
                [*keep, *COLUMNS],
            )

    return run


def _blocks(items: DataFrame, block_chars: int) -> list:
    """Conditions that cut distinct items (t and its hash h) into blocks of at
    most `block_chars` characters, or one item if that is longer."""

    def runs(sizes):
        first, held = None, 0
        for at, size in sizes:
            if first is not None and held + size > block_chars:
                yield first, last, held
                first, held = None, 0
            first, last, held = at if first is None else first, at, held + size
        if first is not None:
            yield first, last, held

    slot = F.pmod("h", F.lit(SLOTS))
    length = F.sum(F.length("t"))
    slots = sorted(tuple(r) for r in items.groupBy(slot.alias("s")).agg(length).collect())
    out = []
    for first, last, held in runs(slots):
        if held <= block_chars:
            out.append(slot.between(first, last))
            continue
        for a, b, _ in runs(sorted(tuple(r) for r in items.where(slot == first).groupBy("h").agg(length).collect())):
            out.append((slot == first) & F.col("h").between(a, b))
    return out or [F.lit(False)]


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: int = 20,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """`docs` with n_words, n_hit (words inside an occurrence of a window of
    `window` item words), n_items, items_sha256, contaminated (n_hit > 0 and
    share * n_hit >= n_words), longest and matches (longest verbatim matches:
    item, first word in document and item, length).

    The benchmark goes to the tasks in blocks of at most `block_chars`
    characters, or one item if that is longer; between blocks the matches so
    far are written. Null and empty texts have no words and no hits; an item
    without words never occurs; a null item id reads "null"; repeated items
    count once; with an empty benchmark nothing is contaminated. Columns of
    `docs` with the names of the new ones are replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("i"), F.col(item_text_col).alias("t")
    ).where(F.col("t").isNotNull()).distinct()
    items = stage(items.withColumn("h", F.xxhash64("i", "t")))
    blocks = _blocks(items, block_chars)
    keep = [c for c in docs.columns if c not in COLUMNS]
    base = T.StructType([docs.schema[c] for c in keep])
    schema = T.StructType([*base.fields, T.StructField("n_words", T.LongType())])
    schema = schema.add("matches", T._parse_datatype_string(MATCH))
    rows = docs.select(*keep)
    for k, inside in enumerate(blocks):
        block = items.where(inside).collect()
        tests = spark.sparkContext.broadcast(TestItems([(r["i"], r["t"]) for r in block], window))
        names = list(rows.columns)
        rows = rows.mapInArrow(
            lambda it, tests=tests, names=names: _scan(tests, window, names, text_col)(it), schema
        )
        if k < len(blocks) - 1:
            rows = stage(rows)
    out = base
    for name, kind in (("n_words", "long"), ("n_hit", "long"), ("n_items", "long"), ("items_sha256", "string"),
                       ("contaminated", "boolean"), ("longest", "long"), ("matches", MATCH)):
        out = T.StructType([*out.fields, T.StructField(name, T._parse_datatype_string(kind))])
    return rows.mapInArrow(_judged(keep, share), out)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` that do not repeat the benchmark, unchanged."""
    own = {c: f"_{n}_{c}" for n, c in enumerate(docs.columns) if c in COLUMNS}
    rows = docs.withColumnsRenamed(own)
    text = settings.pop("text_col", "text")
    judged = find_matches(rows, benchmark, text_col=own.get(text, text), **settings)
    back = {v: k for k, v in own.items()}
    return judged.where(~F.col("contaminated")).select(*rows.columns).withColumnsRenamed(back)
