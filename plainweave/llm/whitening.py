"""Whitening of embeddings on the leading components of their covariance.

Entries become integers, so that counts, sums and deviations are exact. The
covariance is added up in the tasks, a triangle of d * (d + 1) / 2 numbers
each; d is the length of a vector and does not grow with the table. Its
components come from spectral divide and conquer: the polar factor of the
covariance less a shift, found by dynamically weighted Halley steps (QDWH), is
1 on eigenvectors above the shift and -1 below it, which gives projectors that
split the space; each part is split again until single components are left.
The components, d numbers each, are then broadcast to whiten every row.
"""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plainweave.operators.staging import stage

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
TOP = float(1 << 62)  # entries beyond are held there
EXACT = float(1 << 62)
MANY = 1 << 20  # sums a task holds at once
EPS = float(np.finfo(float).eps)
NEW = ["n", "deviation", "whitened"]
EACH = ["component", "explained", "identity_error"]


# --- vectors in a task --------------------------------------------------------


def whole(column: pa.Array, size: int | None = None):
    """Of a list column: places of the rows whose entries are all there and
    finite (and `size` many, if given, else any number but none), and all
    entries with the offsets of the rows."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    bad = np.zeros(len(values) + 1, np.int64)
    np.cumsum(~np.isfinite(values), out=bad[1:])
    length = np.diff(offsets)
    good = (bad[offsets[1:]] == bad[offsets[:-1]]) & (length > 0) & np.asarray(column.is_valid())
    return np.flatnonzero(good & (length == size) if size else good), values, offsets


def integers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * values), -TOP, TOP).astype(np.int64) + SHIFT


def _matrix(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the whole rows of this size, and their integers."""
    at, values, offsets = whole(column, size)
    return at, integers(values[offsets[at][:, None] + np.arange(size)])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: longs where they hold it, else Python's integers."""
    most = max(map(abs, sums), default=0)
    if len(x) == 0 or n * float(np.abs(x).max()) + most < EXACT:
        return n * x - np.array([s if abs(s) < EXACT else 0 for s in sums], np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(away: np.ndarray) -> list[int]:
    """Exact sum of squares of every row."""
    if away.dtype != object and (len(away) == 0 or (away.astype(float) ** 2).sum(axis=1).max() < EXACT):
        return (away * away).sum(axis=1).tolist()
    away = away.astype(object)
    return (away * away).sum(axis=1).tolist()


# --- components of a symmetric matrix -------------------------------------------


def polar(m: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH: the weights of
    each step follow from a lower bound of the least singular value."""
    n = len(m)
    x = m / np.linalg.norm(m)
    low = EPS
    one = np.eye(n)
    for _ in range(30):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        a = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        before = x
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, one]))
            x = (b / c) * x + (a - b / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            x = (b / c) * x + (a - b / c) * np.linalg.solve(one + c * (x.T @ x), x.T).T
        x = (x + x.T) / 2
        low = min(1.0, low * (a + b * square) / (1 + c * square))
        if 1 - low < 10 * EPS and np.linalg.norm(x - before) < EPS ** (1 / 3):
            break
    return x


def divided(a: np.ndarray, shift: float):
    """Orthonormal bases of the eigenvectors above and below the shift, and how
    far the matrix is from keeping them apart; None if all are on one side."""
    n = len(a)
    projector = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(np.trace(projector)))
    if rank in (0, n):
        return None
    basis = np.random.Generator(np.random.PCG64(n)).normal(size=(n, rank))
    for _ in range(3):  # a projector maps any basis into its space; twice more to shed rounding
        q, _ = np.linalg.qr(projector @ basis, mode="complete")
        basis = q[:, :rank]
    above, below = q[:, :rank], q[:, rank:]
    return above, below, np.linalg.norm(below.T @ a @ above)


def split(a: np.ndarray, scale: float):
    """The best division over shifts within the spectrum. The mean of the
    diagonal is the mean eigenvalue and so always has some on both sides; other
    shifts serve if it hits an eigenvalue."""
    diagonal = np.sort(np.diag(a))
    mean, spread = diagonal.mean(), np.linalg.norm(a - diagonal.mean() * np.eye(len(a))) / np.sqrt(len(a))
    best = None
    for shift in (np.median(diagonal), mean, *(mean + spread * t for t in (0.01, -0.01, 0.1, -0.1, 0.03, -0.03, 0.3, -0.3))):
        found = divided(a, float(shift))
        if found is not None and (best is None or found[2] < best[2]):
            best = found
        if best is not None and best[2] <= 4 * EPS * scale:
            break
    return best


def components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest `wanted` eigenvalues of a covariance, falling, and their
    unit eigenvectors as columns, each with its greatest entry positive. Spaces
    whose eigenvalues all come after the wanted ones are not split."""
    if len(v) == 0:
        return np.zeros(0), np.zeros((0, 0))
    v = (v + v.T) / 2
    scale = np.linalg.norm(v)
    found: list[np.ndarray] = []
    open_ = [np.eye(len(v))]  # bases, the space of the greatest eigenvalues last
    while open_ and sum(f.shape[1] for f in found) < wanted:
        basis = open_.pop()
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        n = len(a)
        level = np.trace(a) / n
        parts = None
        if n > 1 and np.linalg.norm(a - level * np.eye(n)) > 2 * EPS * scale:
            parts = split(a, scale)
        if parts is None:  # one component, or equal eigenvalues, for which any basis will do
            found.append(basis)
        else:
            open_ += [basis @ parts[1], basis @ parts[0]]
    vectors = np.linalg.qr(np.hstack(found))[0]
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors, values = vectors[:, order], values[order]
    sign = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(order))])
    return values, vectors * sign


# --- passes over the table ------------------------------------------------------


def _sums(vec: str):
    def run(batches):
        kept: dict[int, list] = {}
        for batch in batches:
            at, values, offsets = whole(batch.column(vec))
            length = np.diff(offsets)[at]
            for size in np.unique(length).tolist():
                x = integers(values[offsets[at[length == size]][:, None] + np.arange(size)])
                n, high, low = kept.get(size, (0, 0, 0))
                kept[size] = [n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)]
            if sum(kept) > MANY:  # vectors of many lengths
                yield from told(kept)
                kept = {}
        yield from told(kept)

    def told(kept):
        for size, (n, high, low) in kept.items():
            columns = [pa.array(np.full(size, c), pa.int64()) for c in (size, n)]
            columns += [pa.array(np.arange(size)), pa.array(high), pa.array(low)]
            yield pa.RecordBatch.from_arrays(columns, ["size", "n", "i", "high", "low"])

    return run


def fit_list(rows: DataFrame, vec: str = "v") -> tuple[int, list[int]]:
    """Number of whole vectors and exact sums of their integers, per dimension,
    for the commonest length (of equally common ones the greater)."""
    sums = rows.select(vec).mapInArrow(_sums(vec), "size long, n long, i long, high long, low long")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    total = stage(sums.groupBy("size", "i").agg(*wide))
    most = total.where("i = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return 0, []
    mine = total.where(F.col("size") == most["size"]).orderBy("i").collect()
    return int(most["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in mine]


def _products(vec: str, n: int, sums: list[int]):
    d = len(sums)

    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                _, x = _matrix(batch.column(vec).slice(start, 4096), d)
                away = deviations(x, n, sums).astype(float) / n
                total += away.T @ away
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "value"])

    return run


def covariance(rows: DataFrame, n: int, sums: list[int], vec: str = "v") -> np.ndarray:
    """Over the fit list, divisor n, centred before multiplying."""
    d = len(sums)
    parts = rows.select(vec).mapInArrow(_products(vec, n, sums), "i long, j long, value double")
    found = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((d, d))
    i, j = (found.column(c).to_numpy() for c in "ij")
    out[i, j] = out[j, i] = found.column("value").to_numpy() / n
    return out


def _whitened(vec: str, n: int, sums: list[int], weights: np.ndarray, dead: np.ndarray, keep: list[str]):
    d, k = weights.shape

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                at, x = _matrix(part.column(vec), d)
                away = deviations(x, n, sums)
                made = (away.astype(float) / n) @ weights
                flat = pa.array(made.ravel(), mask=np.tile(dead, len(at)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * k, pa.int32()), flat)
                exact = pa.array([decimal.Decimal(s) if s < 10**38 else None for s in squares(away)], pa.decimal128(38, 0))
                rest = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*(rest.column(c) for c in keep), exact, lists], [*keep, "deviation", "whitened"])

    return run


def whiten(rows: DataFrame, vec_col: str = "embedding", wanted: int = COMPONENTS):
    """(`rows` with n, deviation and whitened; eigenvalues; their share of the
    whole variance).

    deviation is the exact sum of (n * x - S)^2, `whitened` a list of up to
    `wanted` coordinates. Rows are dropped whose vector is null, empty, holds a
    null or an entry that is not finite, or has not the commonest length.
    Entries beyond 2**62 / 1024 are held there. Repeated rows count each. A
    component without variance (beyond rounding) has null coordinates, and a
    share of null where nothing varies; equal eigenvalues have any basis of
    their space, the same for all rows. An empty table gives an empty result
    and no components. Columns with the names of the new ones are replaced,
    others pass unchanged whatever their names; texts play no part.
    """
    keep = [c for c in rows.columns if c not in NEW]
    inner = [f"k{i}" for i in range(len(keep))]
    named = rows.select(*[F.col(c).alias(k) for c, k in zip(keep, inner)], F.col(vec_col).alias("v"))
    n, sums = fit_list(named)
    v = covariance(named, n, sums) if n else np.zeros((0, 0))
    values, vectors = components(v, min(wanted, len(v)))
    dead = values <= len(v) * EPS * (values[0] if len(values) else 0.0)
    weights = np.divide(vectors, np.sqrt(np.where(dead, 1.0, values)))
    fields = [T.StructField(k, rows.schema[c].dataType) for c, k in zip(keep, inner)]
    fields += [T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    out = named.mapInArrow(_whitened("v", n, sums, weights, dead, inner), T.StructType(fields)) if n else (
        named.limit(0).select(*inner, F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
    )
    made = out.select(*[F.col(k).alias(c) for c, k in zip(keep, inner)], F.lit(n).cast("long").alias("n"), "deviation", "whitened")
    trace = float(np.trace(v)) if n else 0.0
    return made, values, [float(e) / trace if trace > 0 else None for e in values]


def identity_error(made: DataFrame, count: int) -> float | None:
    """Greatest entry of the covariance of the whitened rows less the identity,
    over components with variance; null without any."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    w = lambda i: F.get("whitened", F.lit(i))
    if not pairs:
        return None
    row = made.agg(*[F.covar_pop(w(i), w(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    errors = [abs(c - (i == j)) for (i, j), c in zip(pairs, row) if c is not None]
    return max(errors, default=None)


def coordinates(rows: DataFrame, vec_col: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """One row per row and component, numbered from 1 by falling eigenvalue,
    with the share explained and the error of the whole whitening."""
    made, values, shares = whiten(rows, vec_col, wanted)
    made = stage(made)
    error = F.lit(identity_error(made, len(values))).cast("double")
    share = F.array(*[F.lit(s).cast("double") for s in shares]) if shares else F.array().cast("array<double>")
    own = [c for c in made.columns if c not in ("whitened", *EACH)]
    each = made.select(F.struct(*own).alias("row"), F.posexplode("whitened").alias("k", "w"))
    return each.select(
        *[F.col("row").getField(c).alias(c) for c in own], (F.col("k") + 1).alias("component"), F.col("w").alias("whitened"),
        F.get(share, F.col("k")).alias("explained"), error.alias("identity_error"),
    )
