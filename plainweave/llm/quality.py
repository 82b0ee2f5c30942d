"""Quality rules: fixed rules first, then robust multivariate outliers.

Every document becomes a vector of transformed statistics. For each language
and source, for each language and for all rows together, minimum-covariance-
determinant estimates are found by concentration steps over all rows: the rows
nearest to the present centre, at least the share H of them, give the next
centre and scatter. Several starts are followed for two steps; that with the
least determinant goes on until the determinant falls no more, and one more
step takes all rows that are no outliers. The estimate
of a source is then weighed with that of its language, and that with
the one of all rows, by numbers of rows.

A step is one aggregation: rows fall into bins of their distance, and a bin
carries counts and sums of integers, so any number of rows makes at most BINS
rows a group and the sums do not depend on their order.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plainweave.llm import words as W
from plainweave.operators.staging import stage

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SLICE_BYTES = 1 << 18  # of text counted at once; its arrays take a hundred times as much
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
H = 0.75
STEPS = 30  # at most; the given tables need five or six
FALLS = 0.001  # the least share by which a determinant falls
KEEP_QUANTILE = 0.999999
SCALE = 1000  # statistics are held as integers of thousandths
BINS, FINE = 800, 40
STARTS = 3
# resolution of the statistics, about what one more symbol or line in a document
# changes: log words, letters a word, log symbols per thousand words, log
# repeated lines, angle of repeated words. What varies less counts as constant,
# with that spread; all else has its own
FLOOR = (0.5, 0.25, 0.5, 0.5, 0.1)
DIMS = len(FLOOR)
SHRINK = 30  # rows at which a group's own estimate weighs as much as that of the next larger group
PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]


# --- base statistics ---------------------------------------------------------


def _per_row(flags: np.ndarray, rows: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[rows[1:]] - total[rows[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every key, whether it is there twice, and whether it was there before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order[1:]] = before[order[1:]] = same
    twice[order[:-1]] |= same
    return twice, before


def _count(run: pa.Array, hasher: W.Hasher, kind: np.ndarray, symbol: np.ndarray) -> list[np.ndarray]:
    data, rows = W.column_bytes(run)
    starts, ends, first = W.split(data, rows, kind)
    n_words = np.diff(first)
    word_chars = _per_row(kind[data] & ((data & 0xC0) != 0x80), rows)
    n_symbols = _per_row(symbol[data], rows)

    breaks = np.flatnonzero(data == 0x0A)
    line_ends = np.sort(np.concatenate([breaks, rows[1:]]))
    line_row = np.repeat(np.arange(len(rows) - 1), np.diff(np.searchsorted(breaks, rows)) + 1)
    line_starts = np.zeros_like(line_ends)
    line_starts[1:] = line_ends[:-1] + (line_row[1:] == line_row[:-1])
    worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_row = line_starts[worded], line_ends[worded], line_row[worded]
    lines = W.mix(hasher.words(data, line_starts, line_ends) ^ W.mix(line_row.astype(np.uint64)))
    n_dup_lines = np.bincount(line_row[_repeated(lines)[1]], minlength=len(rows) - 1)

    covered = np.zeros(len(starts) + 2, bool)
    if len(starts) >= 3:
        row = W.row_of_word(first)
        windows = hasher.windows(hasher.words(data, starts, ends), 3)
        inside = row[2:] == row[:-2]
        at = np.flatnonzero(inside)
        keys = W.mix(windows[at] ^ W.mix(row[at].astype(np.uint64)))
        at = at[_repeated(keys)[0]]
        for k in range(3):
            covered[at + k] = True
    n_repeat = _per_row(covered[: len(starts)], first)
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat]


def base_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with the five counts of BASE over the whole text; null has no words."""
    keep = [c for c in docs.columns if c not in BASE]

    def run(batches):
        hasher, kind = W.Hasher(2), W.not_space()
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        for batch in W.slices(batches, text_col, SLICE_BYTES):
            made = _count(batch.column(text_col), hasher, kind, symbol)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(pa.array(m.astype(np.int64)) for m in made)], [*keep, *BASE]
            )

    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in BASE)])
    return docs.select(*keep).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


# --- estimates ----------------------------------------------------------------


def vector() -> list[Column]:
    """Transformed statistics as integers of thousandths; a million letters a
    word is as many as count."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    made = [
        F.log1p("n_words"),
        F.least(F.col("word_chars") / n, F.lit(1e6)),
        F.log1p(1000 * F.col("n_symbols") / n),
        F.log1p("n_dup_lines"),
        F.asin(F.sqrt(F.least(F.col("n_repeat_words") / n, F.lit(1.0)))),
    ]
    return [F.round(m * SCALE).cast("long").alias(f"x{i}") for i, m in enumerate(made)]


def chi2_cdf(x: float, k: int) -> float:
    """For odd k."""
    term, total = math.sqrt(2 * x / math.pi) * math.exp(-x / 2), math.erf(math.sqrt(x / 2))
    for m in range(1, k - 1, 2):
        total -= term
        term *= x / (m + 2)
    return total


def chi2_quantile(q: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < q else (low, mid)
    return high


def consistency(share: float) -> float:
    """Factor by which the scatter of the nearest `share` of normal rows is too small."""
    return share / chi2_cdf(chi2_quantile(share, DIMS), DIMS + 2)


SUMS = [*(f"s{i}" for i in range(DIMS)), *(f"q{i}{j}" for i, j in PAIRS)]
CENTRE = [f"c{i}" for i in range(DIMS)]
SCATTER = [f"v{i}{j}" for i, j in PAIRS]
INVERSE = [f"p{i}{j}" for i, j in PAIRS]
FOUND = ["g", "start", "n", "used", "done", "determinant", *CENTRE, *SCATTER, *INVERSE]
FOUND_SCHEMA = "g long, start int, n long, used long, done boolean, determinant double, " + ", ".join(
    f"{c} double" for c in (*CENTRE, *SCATTER, *INVERSE)
)


def _square(values) -> np.ndarray:
    out = np.zeros((DIMS, DIMS))
    for (i, j), v in zip(PAIRS, values):
        out[i, j] = out[j, i] = v
    return out


def held(scatter: np.ndarray) -> np.ndarray:
    """The scatter with the resolution as spread in directions that vary less,
    as constant statistics and those of very few rows do."""
    unit = np.array(FLOOR) * SCALE
    values, vectors = np.linalg.eigh(scatter / np.outer(unit, unit))
    low = values < 1
    if not low.any():
        return scatter
    more = (vectors[:, low] * (1 - values[low])) @ vectors[:, low].T
    return scatter + more * np.outer(unit, unit)


def _row(g: int, start: int, n: int, used: int, done: bool, mean, scatter: np.ndarray) -> list:
    scatter = held(scatter)
    inverse = np.linalg.inv(scatter)
    of = lambda m: [float(m[i, j]) for i, j in PAIRS]
    return [g, start, n, used, done, float(np.linalg.det(scatter / SCALE**2)), *map(float, mean), *of(scatter), *of(inverse)]


def _moments(n: float, sums, squares) -> tuple[np.ndarray, np.ndarray]:
    mean = np.array([float(s) for s in sums]) / n
    return mean, _square([float(q) for q in squares]) / n - np.outer(mean, mean)


def _place(value: Column) -> Column:
    """Of about a hundredth of the value's size, so that a statistic has some
    thousand places whatever its range."""
    return F.signum(value) * F.floor(64 * F.log2(1 + F.abs(value)))


def _back(place: Column) -> Column:
    return F.round(F.signum(place) * (F.pow(F.lit(2.0), (F.abs(place) + 0.5) / 64) - 1))


def _starts(rows: DataFrame) -> DataFrame:
    """Three starts a group: medians and median deviations; the same with the
    correlations of the statistics' hyperbolic tangents; mean and scatter with
    weights that fall with the distance from the medians. Medians are read from
    counts of places, which tasks add up before anything moves."""
    dims = range(DIMS)
    middle = rows.groupBy("g").agg(*[_back(F.percentile(_place(F.col(f"x{i}")), 0.5)).alias(f"m{i}") for i in dims])
    placed = rows.join(stage(middle), "g")
    away = placed.groupBy("g").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in dims],
        *[_back(F.percentile(_place(F.abs(F.col(f"x{i}") - F.col(f"m{i}"))), 0.5)).alias(f"a{i}") for i in dims],
    )
    spread = [F.greatest(1.4826 * F.col(f"a{i}"), F.lit(FLOOR[i] * SCALE)) for i in dims]
    away = stage(away.select("g", *[f"m{i}" for i in dims], *[e.alias(f"e{i}") for i, e in enumerate(spread)]))
    z = [(F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"e{i}") for i in dims]
    tangent = [F.round(1000 * F.tanh(x)).cast("long").alias(f"y{i}") for i, x in enumerate(z)]
    length = sum((x * x for x in z[1:]), z[0] * z[0])
    near = F.round(1000 / (1 + length / DIMS)).cast("long").alias("w")
    known = rows.join(away, "g").select("g", *[f"{a}{i}" for a in "xme" for i in dims], *tangent, near)
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    pair = lambda a: [(f"{a}{i}", f"{a}{j}") for i, j in PAIRS]
    total = known.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), *[F.first(f"{a}{i}").alias(f"{a}{i}") for a in "me" for i in dims],
        *[wide(F.col(f"y{i}")).alias(f"ys{i}") for i in dims], *[wide(F.col(a) * F.col(b)).alias(f"yq{a[1]}{b[1]}") for a, b in pair("y")],
        wide(F.col("w")).alias("ws"), *[wide(F.col("w") * F.col(f"x{i}")).alias(f"ws{i}") for i in dims],
        *[wide(F.col("w") * F.col(a) * F.col(b)).alias(f"wq{a[1]}{b[1]}") for a, b in pair("x")],
    )

    def made(batches):
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                centre = [r[f"m{i}"] for i in dims]
                scale = np.array([r[f"e{i}"] for i in dims])
                diagonal = np.diag(scale**2)
                _, tanh = _moments(r["n"], [r[f"ys{i}"] for i in dims], [r[f"yq{i}{j}"] for i, j in PAIRS])
                size = np.sqrt(np.maximum(np.diag(tanh), 1.0))
                related = tanh / np.outer(size, size)
                np.fill_diagonal(related, 1.0)
                mean, scatter = _moments(max(1.0, float(r["ws"])), [r[f"ws{i}"] for i in dims], [r[f"wq{i}{j}"] for i, j in PAIRS])
                starts = [(centre, diagonal), (centre, related * np.outer(scale, scale)), (mean, scatter)]
                out += [_row(r["g"], k, r["n"], 0, False, m, v) for k, (m, v) in enumerate(starts)]
            yield pd.DataFrame(out, columns=FOUND)

    return total.mapInPandas(made, FOUND_SCHEMA)


def _place_of(d: Column) -> Column:
    return F.least(F.floor(FINE * F.log1p(d)), F.lit(BINS - 1)).cast("int")


def _next(binned: DataFrame, last: bool) -> DataFrame:
    """The next estimates from the bins of groups and starts: of the nearest
    rows, at least the share H, or at `last` of all that are no outliers."""
    edge = chi2_quantile(0.975, DIMS)
    factor = consistency(0.975) if last else consistency(H)
    own = Window.partitionBy("g", "start")
    upto = F.sum("n").over(own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    counted = binned.withColumns({"upto": upto, "all": F.sum("n").over(own), "least": F.min("bin").over(own)})
    limit = F.greatest(F.col("least"), _place_of(F.lit(edge)))
    near = counted.where(F.col("bin") <= limit if last else F.col("upto") - F.col("n") < H * F.col("all"))
    sums = [F.sum(c).cast("double").alias(c) for c in SUMS]
    told = [F.first(c).alias(f"old_{c}") for c in ("used", "determinant")]
    total = near.groupBy("g", "start").agg(F.first("all").alias("n"), F.sum("n").alias("used"), *told, *sums)

    def made(batches):
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                used = int(r["used"])
                mean, scatter = _moments(used, [r[c] for c in SUMS[:DIMS]], [r[c] for c in SUMS[DIMS:]])
                found = _row(int(r["g"]), int(r["start"]), int(r["n"]), used, False, mean, factor * scatter)
                found[4] = bool(r["old_used"] > 0 and found[5] >= (1 - FALLS) * r["old_determinant"])
                out.append(found)
            yield pd.DataFrame(out, columns=FOUND)

    return total.mapInPandas(made, FOUND_SCHEMA)


def distance() -> Column:
    """Squared Mahalanobis distance to the joined estimate."""
    away = [F.col(f"x{i}") - F.col(f"c{i}") for i in range(DIMS)]
    total = F.lit(0.0)
    for i, j in PAIRS:
        total = total + (1 if i == j else 2) * F.col(f"p{i}{j}") * away[i] * away[j]
    return F.greatest(total, F.lit(0.0))


def _binned(rows: DataFrame, now: DataFrame) -> DataFrame:
    sums = [F.sum(F.col(f"x{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(DIMS)]
    squares = [F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(38,0)")).alias(f"q{i}{j}") for i, j in PAIRS]
    xs = [f"x{i}" for i in range(DIMS)]
    known = rows.join(now.select("g", "start", "used", "determinant", *CENTRE, *INVERSE), "g")
    placed = known.select("g", "start", "used", "determinant", _place_of(distance()).alias("bin"), *xs)
    told = [F.first(c).alias(c) for c in ("used", "determinant")]
    return placed.groupBy("g", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *told, *sums, *squares)


def _least(found: DataFrame) -> DataFrame:
    """Of every group the start with the least determinant."""
    first = F.min_by(F.struct(*FOUND), F.struct("determinant", "start"))
    return stage(found.groupBy("g").agg(first.alias("r")).select("r.*"))


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Number of rows, centre, scatter and inverse scatter of every group `g` of
    `rows` (g, x0..x4)."""

    def stepped(now: DataFrame, last: bool = False) -> DataFrame:
        return stage(_next(_binned(rows, now), last))

    now = _least(stepped(stepped(stage(_starts(rows)))))
    found = now.where("done")
    for _ in range(steps - 2):
        now = now.where(~F.col("done"))
        if now.isEmpty():
            break
        now = stepped(now)
        found = found.unionByName(now.where("done"))
    return stepped(found.unionByName(now.where(~F.col("done"))), last=True)


def _level(l, s) -> Column:
    """Key of a group of rows; null for all languages or sources."""
    value = lambda x: F.lit(None).cast("string") if x is None else F.col(x)
    return F.xxhash64(F.lit(l is not None), F.lit(s is not None), value(l), value(s))


def shrunk(groups: DataFrame) -> DataFrame:
    """l, s and centre and inverse scatter of every group (l, s): own estimate,
    that of the language and that of all rows, each weighed with the next by
    n * n to SHRINK * SHRINK, so that few rows, of which outliers may be most,
    say little."""
    fields = ["n", *CENTRE, *SCATTER]

    def made(batches):
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                mean = scatter = None
                for k in "cba":  # from all rows to the source
                    m, v = np.array([r[f"{k}_{c}"] for c in CENTRE]), _square([r[f"{k}_{c}"] for c in SCATTER])
                    w = 1.0 if mean is None else r[f"{k}_n"] ** 2 / (r[f"{k}_n"] ** 2 + SHRINK**2)
                    mean, scatter = (m, v) if mean is None else (w * m + (1 - w) * mean, w * v + (1 - w) * scatter)
                inverse = np.linalg.inv(held(scatter))
                out.append([r["l"], r["s"], *map(float, mean), *(float(inverse[i, j]) for i, j in PAIRS)])
            yield pd.DataFrame(out, columns=["l", "s", *CENTRE, *INVERSE])

    columns = [f"{k}_{c}" for k in "abc" for c in fields]
    schema = "l string, s string, " + ", ".join(f"{c} double" for c in (*CENTRE, *INVERSE))
    return groups.select("l", "s", *columns).mapInPandas(made, schema)


def judge(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    keep_columns: list[str] | None = None,
    steps: int = STEPS,
    quantile: float = KEEP_QUANTILE,
) -> DataFrame:
    """`docs` (or its `keep_columns`) with the counts of BASE, base_failed,
    distance (squared Mahalanobis, null if base_failed) and kept.

    A null language or source is a value of its own. Null and empty texts fail
    the fixed rules; long ones are counted whole. Repeated rows count each. A
    group of any size has an estimate, which its language's outweighs while it
    has fewer than SHRINK rows. An empty table gives an empty result; columns
    with the names of the new ones are replaced.

    The limit is a parameter: 0.975 is the usual quantile for calling a row an
    outlier, but would drop one good row in forty from data that are normal,
    and more from these. What is dropped here is beyond any such tail.
    """
    new = [*BASE, "base_failed", "distance", "kept"]
    keep = [c for c in (keep_columns or docs.columns) if c not in new]
    own = [F.col(c).alias(f"k_{c}") for c in keep]
    key = [F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(k) for c, k in ((lang_col, "l"), (source_col, "s"))]
    counted = base_statistics(docs.select(F.col(text_col).alias("text"), *key, *own))
    fields = ["l", "s", *[f"k_{c}" for c in keep], *BASE]
    if text_col in keep:  # the text is read again where it is asked for
        counted = counted.withColumn(f"k_{text_col}", F.col("text"))
    measured = stage(counted.select(*fields, base_failed().alias("base_failed"), *vector()))
    passed = measured.where(~F.col("base_failed"))
    xs = [f"x{i}" for i in range(DIMS)]
    levels = {"a": _level("l", "s"), "b": _level("l", None), "c": _level(None, None)}
    rows = passed.select(F.explode(F.array(*levels.values())).alias("g"), *xs)
    found = estimates(rows, steps)
    groups = stage(passed.select("l", "s").distinct().select("l", "s", *[g.alias(f"g_{k}") for k, g in levels.items()]))
    for k in levels:
        columns = [F.col(c).alias(f"{k}_{c}") for c in ("n", *CENTRE, *SCATTER)]
        groups = groups.join(found.select(F.col("g").alias(f"g_{k}"), *columns), f"g_{k}")
    limits = stage(shrunk(groups))
    limit = chi2_quantile(quantile, DIMS)
    d = F.when(~F.col("base_failed"), distance())
    out = measured.join(limits, ["l", "s"], "left").withColumn("distance", d)
    kept = ~F.col("base_failed") & (F.col("distance") <= limit)
    return out.select(*[F.col(f"k_{c}").alias(c) for c in keep], *BASE, "base_failed", "distance", F.coalesce(kept, F.lit(False)).alias("kept"))


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` that the rules keep, with their own columns."""
    own = {c: f"_{n}_{c}" for n, c in enumerate(docs.columns) if c in (*BASE, "base_failed", "distance", "kept")}
    judged = judge(docs.withColumnsRenamed(own), **settings)
    back = {v: k for k, v in own.items()}
    return judged.where("kept").select(*[F.col(own.get(c, c)) for c in docs.columns]).withColumnsRenamed(back)
