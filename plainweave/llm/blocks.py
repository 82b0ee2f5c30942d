"""Removal of long passages that an earlier document has, by fixed-block anchors.

A window of WINDOW words that two documents share holds, wherever the earlier
one cuts its text into blocks of BLOCK words, one whole block of it (WINDOW >=
2 * BLOCK - 1). So the blocks are indexed, and every rolling window of BLOCK
words of every document probes them. Around each hit the windows of WINDOW
words are then compared exactly (96-bit hashes), which extends hits to maximal
exact repeats; a word goes if one of its windows also starts in a document
with a smaller id.

Texts move in cells, compressed runs of rows of a few megabytes. A cell sends
each of its keys once, so a passage that a third of all documents share comes
at most once a cell, and gets back which of them matter:

  cells -> keys by hash bucket -> keys found in an anchor and another document
  cells + those keys -> candidate windows by hash bucket -> windows owned elsewhere
  cells + those windows -> words kept
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plainweave.llm import words as W
from plainweave.operators.staging import stage

WINDOW, BLOCK = 50, 25
CELL_BYTES = 3 << 20  # of text in a cell; a longer text is a cell of its own
BUCKET_BYTES = 8 << 20  # of text whose keys make up one bucket on average
KEY_BITS = 28
NO_ID = np.iinfo(np.int64).max


# --- cells --------------------------------------------------------------------


def _packed(batches):
    """Rows as cells: ids and texts in the order of the ids, null ids last."""
    part = TaskContext.get().partitionId()
    press = zstandard.ZstdCompressor(level=6)
    count, waiting, size = 0, [], 0

    def cell(runs):
        nonlocal count
        ids, texts = [], []
        for run in runs:
            ids += run.column("id").to_pylist()
            texts += run.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
        raw = [(texts[k] or "").encode() for k in order]
        numbers = np.array([NO_ID if ids[k] is None else ids[k] for k in order], np.int64)
        sizes = np.array(list(map(len, raw)), np.int64)
        count += 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(part << 32) + count - 1], pa.int64()),
                pa.array([press.compress(numbers.tobytes() + sizes.tobytes() + b"".join(raw))], pa.binary()),
                pa.array([len(raw)], pa.int64()),
            ],
            ["cell", "body", "n"],
        )

    for run in W.slices(batches, "text", CELL_BYTES):
        waiting.append(run)
        size += run.column("text").nbytes
        if size >= CELL_BYTES:
            yield cell(waiting)
            waiting, size = [], 0
    if waiting:
        yield cell(waiting)


class Cell:
    """Words of a cell's texts, and windows over them."""

    def __init__(self, body: bytes, n: int):
        raw = zstandard.ZstdDecompressor().decompress(body)
        self.ids = np.frombuffer(raw, np.int64, n)
        self.rows = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.int64, n, 8 * n))]).astype(np.int64)
        self.raw = raw[16 * n :]
        self.data = np.frombuffer(self.raw, np.uint8)
        self.starts, self.ends, self.first = W.split(self.data, self.rows, W.not_space())
        self.row = W.row_of_word(self.first)

    def windows(self, seed: int, size: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of `size` words from every word that begins such a run, in rows
        of at least `window` words, and that word."""
        hasher = W.Hasher(seed)
        hashes = hasher.windows(hasher.words(self.data, self.starts, self.ends), size)
        n = np.diff(self.first)[self.row[: len(hashes)]]
        inside = (np.arange(len(hashes)) + size <= self.first[1:][self.row[: len(hashes)]]) & (n >= window)
        at = np.flatnonzero(inside)
        return hashes[at], at


def code(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and key of a hash as one number."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return (bucket << np.uint64(KEY_BITS)) | (hashes & np.uint64((1 << KEY_BITS) - 1))


def groups(order_by: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order, and start and end of each run of equal values in it."""
    order = np.argsort(order_by, kind="stable")
    ranked = order_by[order]
    new = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, np.int64)
    return order, new, np.append(new[1:], len(ranked)) if len(new) else new


def _planes(values: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as compressed byte planes of their differences."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes())


def _values(body: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel(), dtype=np.uint32)


def _by_bucket(codes: np.ndarray, shift: int):
    bucket = (codes >> np.uint64(shift)).astype(np.int64)
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
    for a, b in zip(start, np.append(start[1:], len(bucket)) if len(bucket) else []):
        yield int(bucket[a]), int(a), int(b)


# --- steps ---------------------------------------------------------------------


def _keys(buckets: int, window: int, block: int):
    """Keys of all rolling windows of a cell, once each, with two marks: some
    document cuts a block there, and two documents of the cell have it."""

    def run(batches):
        for batch in batches:
            for number, body, n in zip(*(batch.column(c).to_pylist() for c in ("cell", "body", "n"))):
                cell = Cell(body, n)
                hashes, at = cell.windows(4, block, window)
                codes = code(hashes, buckets)
                anchor = (at - cell.first[cell.row[at]]) % block == 0
                order, start, end = groups(codes)
                if not len(order):
                    continue
                ids = cell.ids[cell.row[at]][order]
                several = ids[start] != ids[end - 1]  # ids rise within a cell
                anchored = np.logical_or.reduceat(anchor[order], start)
                codes = codes[order][start]
                marked = ((codes & np.uint64((1 << KEY_BITS) - 1)) << np.uint64(2)).astype(np.uint32)
                marked |= anchored.astype(np.uint32) | (several.astype(np.uint32) << np.uint32(1))
                cut = list(_by_bucket(codes, KEY_BITS))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c[0] for c in cut], pa.int32()),
                        pa.array([number] * len(cut), pa.int64()),
                        pa.array([_planes(marked[a:b]) for _, a, b in cut], pa.binary()),
                    ],
                    ["bucket", "cell", "keys"],
                )

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: for every cell its keys that are an anchor somewhere and
    stand in two documents."""
    cells = table.column("cell").to_numpy()
    parts = [_values(k.as_py()) for k in table.column("keys")]
    marked = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order, start, end = groups(marked >> np.uint32(2))
    marks = np.bitwise_or.reduceat(marked[order] & np.uint32(3), start)
    good = ((marks & 1) > 0) & ((end - start > 1) | ((marks & 2) > 0))
    chosen = order[np.repeat(good, end - start)]
    owner, keys = owner[chosen], marked[chosen] >> np.uint32(2)
    by_cell = np.argsort(owner, kind="stable")  # keys rise within a cell
    owner, keys = owner[by_cell], keys[by_cell]
    cut = list(_by_bucket(owner.astype(np.uint64), 0))
    return pa.table({
        "cell": pa.array([int(cells[o]) for o, _, _ in cut], pa.int64()),
        "bucket": pa.array([table.column("bucket")[0].as_py()] * len(cut), pa.int32()),
        "keys": pa.array([_planes(keys[a:b]) for _, a, b in cut], pa.binary()),
    })


def _read(cells: pa.Table) -> Cell:
    return Cell(cells.column("body")[0].as_py(), cells.column("n")[0].as_py())


def _candidates(buckets: int, window: int, block: int):
    """Windows around hits, once a cell with the smallest id that has them."""

    def run(cells: pa.Table, hits: pa.Table) -> pa.Table:
        out = {"bucket": [], "cell": [], "windows": [], "ids": []}
        if cells.num_rows and hits.num_rows:
            cell = _read(cells)
            wanted = np.concatenate([
                (np.uint64(b.as_py()) << np.uint64(KEY_BITS)) | _values(k.as_py()).astype(np.uint64)
                for b, k in zip(hits.column("bucket"), hits.column("keys"))
            ])
            hashes, at = cell.windows(4, block, window)
            found = np.zeros(len(cell.starts) + 1, np.int64)
            found[at[np.isin(code(hashes, buckets), wanted)] + 1] = 1
            found = np.cumsum(found)
            h1, start = cell.windows(5, window, window)
            h2, _ = cell.windows(6, window, window)
            near = found[start + window - block + 1] > found[start]
            h1, h2, ids = h1[near], h2[near], cell.ids[cell.row[start[near]]]
            order, lead, _ = groups(h1)
            first = order[lead]
            h1, h2, ids = h1[first], h2[first], ids[first]
            bucket = ((h1 >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            for b, a, z in _by_bucket(bucket, 0):
                line = np.argsort(ids[a:z], kind="stable") + a  # equal ids side by side pack well
                out["bucket"].append(b)
                out["cell"].append(cells.column("cell")[0].as_py())
                out["windows"].append(h1[line].tobytes() + (h2[line] >> np.uint64(32)).astype(np.uint32).tobytes())
                out["ids"].append(zstandard.ZstdCompressor(level=1).compress(np.diff(ids[line], prepend=0).tobytes()))
        return pa.table(out, schema=pa.schema([
            ("bucket", pa.int32()), ("cell", pa.int64()), ("windows", pa.binary()), ("ids", pa.binary()),
        ]))

    return run


def _owned_elsewhere(table: pa.Table) -> pa.Table:
    """Of one bucket: for every cell its windows that a smaller id outside has."""
    cells = table.column("cell").to_numpy()
    h1, h2, ids, sizes = [], [], [], []
    for body, numbers in zip(table.column("windows"), table.column("ids")):
        raw = body.as_py()
        n = len(raw) // 12
        h1.append(np.frombuffer(raw, np.uint64, n))
        h2.append(np.frombuffer(raw, np.uint32, n, 8 * n))
        ids.append(np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(numbers.as_py()), np.int64)))
        sizes.append(n)
    h1, h2, ids = np.concatenate(h1), np.concatenate(h2), np.concatenate(ids)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    lead = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    least = np.repeat(np.minimum.reduceat(ids[order], lead), np.diff(np.append(lead, len(order))))
    lost = order[least < ids[order]]
    lost = lost[np.argsort(owner[lost], kind="stable")]
    cut = list(_by_bucket(owner[lost].astype(np.uint64), 0))
    return pa.table({
        "cell": pa.array([int(cells[o]) for o, _, _ in cut], pa.int64()),
        "windows": pa.array([h1[lost[a:b]].tobytes() for _, a, b in cut], pa.binary()),
    })


def _kept(window: int, with_text: bool):
    names = ["id", "n_words", "n_removed", "kept_sha256", *(["text", "spans"] if with_text else [])]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
    schema = pa.schema(list(zip(names, kinds)))

    def run(cells: pa.Table, lost: pa.Table) -> pa.Table:
        if not cells.num_rows:
            return schema.empty_table()
        cell = _read(cells)
        h1, start = cell.windows(5, window, window)
        h2, _ = cell.windows(6, window, window)
        ids = cell.ids[cell.row[start]]
        order, lead, end = groups(h1 ^ W.mix(h2))
        gone = np.zeros(len(h1), bool)
        gone[order] = ids[order] > np.repeat(ids[order][lead], end - lead)  # smallest id comes first
        if lost.num_rows:
            taken = np.frombuffer(b"".join(w.as_py() for w in lost.column("windows")), np.uint64)
            gone |= np.isin(h1, taken)
        step = np.zeros(len(cell.starts) + 1, np.int64)
        np.add.at(step, start[gone], 1)
        np.add.at(step, start[gone] + window, -1)
        removed = np.cumsum(step[:-1]) > 0
        n_words = np.diff(cell.first)
        total = np.concatenate([[0], np.cumsum(removed)])
        n_removed = total[cell.first[1:]] - total[cell.first[:-1]]
        digests, texts, spans = [], [], []
        for k in range(len(cell.ids)):
            found = cell.raw[cell.rows[k] : cell.rows[k + 1]].split()
            mask = removed[cell.first[k] : cell.first[k + 1]]
            if n_removed[k]:
                found = list(compress(found, (~mask).tolist()))
            body = b" ".join(found)
            digests.append(hashlib.sha256(body).hexdigest())
            if with_text:
                texts.append(body.decode())
                edge = np.flatnonzero(np.diff(mask, prepend=False, append=False)).reshape(-1, 2)
                spans.append([{"start": int(a), "end": int(b)} for a, b in edge])
        known = pa.array(cell.ids, pa.int64(), mask=cell.ids == NO_ID)
        made = [known, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
        if with_text:
            made += [pa.array(texts, pa.string()), pa.array(spans, kinds[-1])]
        return pa.table(made, schema=schema)

    return run


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    with_text: bool = True,
) -> DataFrame:
    """Per row of `docs`: `id_col`, n_words, n_removed and kept_sha256 (of the
    kept words joined by one space), and if asked for `text_col` with the kept
    words and spans, the removed ranges of words.

    Words are what ASCII white space separates. Windows are judged on the
    input. Null and empty texts have no words; texts shorter than a window
    lose none. A null id counts as larger than any other, and rows with one id
    do not lose words to each other. Other columns, whatever their names, play
    no part; an empty table gives an empty result.
    """
    block = (window + 1) // 2
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    cells = stage(rows.mapInArrow(_packed, "cell long, body binary, n long"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = size // BUCKET_BYTES + 1
    keys = cells.mapInArrow(_keys(buckets, window, block), "bucket int, cell long, keys binary")
    hits = keys.groupBy("bucket").applyInArrow(_shared, "cell long, bucket int, keys binary")
    by_cell = cells.groupBy("cell")
    near = by_cell.cogroup(hits.groupBy("cell")).applyInArrow(
        _candidates(buckets, window, block), "bucket int, cell long, windows binary, ids binary"
    )
    lost = near.groupBy("bucket").applyInArrow(_owned_elsewhere, "cell long, windows binary")
    texts = ", text string, spans array<struct<start:long,end:long>>" if with_text else ""
    out = by_cell.cogroup(lost.groupBy("cell")).applyInArrow(
        _kept(window, with_text), f"id long, n_words long, n_removed long, kept_sha256 string{texts}"
    )
    names = {"id": id_col, "text": text_col}
    return out.select(*[F.col(c).alias(names.get(c, c)) for c in out.columns])
