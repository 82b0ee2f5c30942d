"""Words of Arrow text columns as offset arrays, and their rolling hashes.

Helpers for functions that run inside tasks: they see one batch of rows at a
time and keep nothing between tasks.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SPACE = bytes([0x20, *range(0x09, 0x0E)])


def slices(batches, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about `limit` bytes of text; a longer row is a run of
    its own, whole. After the last one free memory goes back to the system."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)
        del batch
    give_back()


def give_back() -> None:
    """What Arrow and the C library hold free returns to the system: a worker
    that waits for its next task would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the offsets of the rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def not_space() -> np.ndarray:
    """Bytes of the words `[^\\x20\\x09-\\x0D]+`."""
    kind = np.ones(256, bool)
    kind[list(SPACE)] = False
    return kind


def letters_digits() -> np.ndarray:
    """Bytes of the words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` once A-Z are lower-cased."""
    kind = np.zeros(256, bool)
    kind[0x30:0x3A] = kind[0x41:0x5B] = kind[0x61:0x7B] = kind[0x80:] = True
    return kind


def split(data: np.ndarray, rows: np.ndarray, kind: np.ndarray):
    """Start and end byte of every word, and the first word of every row."""
    word = kind[data]
    before, after = np.zeros_like(word), np.zeros_like(word)
    before[1:], after[:-1] = word[:-1], word[1:]
    full = rows[:-1] < rows[1:]
    before[rows[:-1][full]] = False
    after[rows[1:][full] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all of them, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Polynomial hashes modulo 2**64 of byte ranges and of windows of words."""

    def __init__(self, seed: int, lower: bool = False):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.table = draw.integers(0, 1 << 64, 256, np.uint64)
        if lower:
            self.table[0x41:0x5B] = self.table[0x61:0x7B]
        # 3 modulo 8: differences of its powers keep as many bits as possible
        self.base = (int(draw.integers(0, 1 << 61)) << 3 | 3) % (1 << 64)
        self.up = self.down = np.zeros(0, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            up, down = np.full(size, self.base, np.uint64), np.full(size, pow(self.base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up[:n], self.down[:n]

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self.powers(len(values) + 1)
        total = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts])

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.ranges(self.table[data], starts, ends)

    def windows(self, words: np.ndarray, size: int) -> np.ndarray:
        """Of the `size` words from every word on, across row borders too."""
        starts = np.arange(max(0, len(words) - size + 1))
        return self.ranges(words, starts, starts + size)


def row_of_word(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
