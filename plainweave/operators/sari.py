"""SARI as a distributed n-gram job.

One row per (key, n, n-gram) holds the gram's number in source, prediction and
references; keep, delete and add scores are sums over those rows. All three
aggregations group by the row key first, so input hash-partitioned by the key
(or by some of its columns, as after a join) is never shuffled again: the
n-grams, many times larger than the texts, stay in the task that made them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.functions.text import gram_rows, gram_stack, normal_tokens
from plainweave.operators.staging import stage_measured

MAX_N = 4
PART_BYTES = 2 << 20  # of text in a part; its counted n-grams take about 140 times as much memory


def ngrams(df: DataFrame, keys: list[str], toks: str, max_n: int = MAX_N) -> DataFrame:
    """All 1..max_n-grams of a token column, one row each."""
    starts = df.select(*keys, F.inline(gram_rows(F.col(toks), max_n)))
    every = starts.select(*keys, gram_stack(max_n).alias("n", "gram"))
    return every.where(F.col("gram").isNotNull())


def ngram_counts(
    df: DataFrame, keys: list[str], source: str, prediction: str, references: str,
    max_n: int = MAX_N,
) -> DataFrame:
    """Multiset counts s, c, r of every n-gram of a row. With several references
    the source and prediction counts are multiplied by their number. A text that
    stands on several sides of its row, as a copied answer does, is cut once."""
    times = F.size(references)

    def sides(text: Column) -> Column:
        return F.struct(
            text.alias("text"),
            F.when(text.eqNullSafe(F.col(source)), times).otherwise(0).alias("s"),
            F.when(text.eqNullSafe(F.col(prediction)), times).otherwise(0).alias("c"),
            F.size(F.filter(references, lambda r: r.eqNullSafe(text))).alias("r"),
        )

    carried = [*keys, "s", "c", "r"]
    every = F.array_distinct(F.concat(F.array(source, prediction), F.col(references)))
    texts = df.select(*keys, F.inline(F.transform(every, sides)))
    toks = texts.select(*carried, normal_tokens(F.col("text")).alias("toks"))
    rows = ngrams(toks, carried, "toks", max_n)
    return rows.groupBy(*keys, "n", "gram").agg(*[F.sum(x).alias(x) for x in ("s", "c", "r")])


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)


def _ratio(a: str, b: str) -> Column:
    """a / b, and 1 where there was nothing to find."""
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(1.0)


def sari_from_counts(counts: DataFrame, keys: list[str], max_n: int = MAX_N) -> DataFrame:
    """Keep, delete and add scores and SARI (0-100) per row key."""
    s, c, r = F.col("s"), F.col("c"), F.col("r")
    kept = F.least(s, c)
    gone = F.greatest(s - c, F.lit(0))
    new, missing = (c > 0) & (s == 0), (r > 0) & (s == 0)
    sums = counts.groupBy(*keys, "n").agg(
        F.sum(F.when(kept > 0, F.least(kept, r) / kept).otherwise(0.0)).alias("kept_good"),
        F.count_if(kept > 0).alias("kept_all"),
        F.sum(F.least(kept, r)).alias("kept_good_n"),
        F.sum(F.least(s, r)).alias("keepable"),
        F.sum(F.when(gone > 0, F.greatest(gone - r, F.lit(0)) / gone).otherwise(0.0)).alias("gone_good"),
        F.count_if(gone > 0).alias("gone_all"),
        F.count_if(new & (r > 0)).alias("new_good"),
        F.count_if(new).alias("new_all"),
        F.count_if(missing).alias("addable"),
    )
    parts = sums.select(
        *keys,
        _f1(_ratio("kept_good", "kept_all"), _ratio("kept_good_n", "keepable")).alias("keep"),
        _ratio("gone_good", "gone_all").alias("delete"),
        _f1(_ratio("new_good", "new_all"), _ratio("new_good", "addable")).alias("add"),
    )

    def mean(part: str) -> Column:
        # an n no text is long enough for has no row and scores 1
        return (F.sum(part) + max_n - F.count(F.lit(1))) / max_n

    scored = parts.groupBy(*keys).agg(*[mean(p).alias(p) for p in ("keep", "delete", "add")])
    total = 100 * (F.col("keep") + F.col("delete") + F.col("add")) / 3
    return scored.withColumn("sari", total)


def part_number(size: int, setting: int, per_part: int = PART_BYTES) -> int:
    """Parts for so many bytes of text; never fewer than the session's partitions."""
    return max(setting, -(-size // per_part))


def placed(
    df: DataFrame, keys: list[str], texts: list[str], partitions: int | None = None, per_part: int = PART_BYTES
) -> DataFrame:
    """Keys and texts (strings or lists of strings), hash-partitioned by key into
    a fixed number of parts: sized by their texts alone, adaptive execution
    would merge them although the n-grams are much larger. Without
    ``partitions`` the texts are written first, so that they are made once, and
    the bytes written give the number."""
    rows = df.select(*dict.fromkeys(keys), *texts)
    if partitions is None:
        kinds = dict(rows.dtypes)
        sizes = [F.octet_length(t if kinds[t] == "string" else F.array_join(t, "")) for t in texts]
        held = sum((F.coalesce(x, F.lit(0)) for x in sizes[1:]), F.coalesce(sizes[0], F.lit(0)))
        rows, found = stage_measured(rows, size=F.sum(held.cast("long")))
        setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = part_number(found["size"] or 0, setting, per_part)
    return rows.repartition(partitions, *dict.fromkeys(keys))


def sari(
    df: DataFrame, keys: list[str], source: str = "source", prediction: str = "prediction",
    references: str = "references", max_n: int = MAX_N, partitions: int | None = None,
) -> DataFrame:
    """SARI of every row; ``references`` is an array of texts. A row without a
    reference, or with a null among its texts, has null scores.

    The n-grams, many times larger than the texts, stay in the part their texts
    are placed in.
    """
    texts = placed(df, keys, [source, prediction, references], partitions)
    whole = (
        F.col(source).isNotNull() & F.col(prediction).isNotNull()
        & F.coalesce(F.size(references) > 0, F.lit(False))
        & ~F.coalesce(F.exists(references, lambda r: r.isNull()), F.lit(True))
    )
    texts = texts.select(
        *keys, whole.alias("_whole"),
        F.when(whole, F.col(source)).otherwise("").alias(source),
        F.when(whole, F.col(prediction)).otherwise("").alias(prediction),
        F.when(whole, F.col(references)).otherwise(F.array(F.lit(""))).alias(references),
    )
    carried = [*keys, "_whole"]
    counts = ngram_counts(texts, carried, source, prediction, references, max_n)
    scored = sari_from_counts(counts, carried, max_n)
    parts = [c for c in scored.columns if c not in carried]
    return scored.select(*keys, *[F.when(F.col("_whole"), F.col(c)).alias(c) for c in parts])


METRICS = {"sari": sari}


def metric(name: str):
    """A scoring job by name, of a score per row."""
    if name not in METRICS:
        raise KeyError(f"no metric {name!r}; there is {sorted(METRICS)}")
    return METRICS[name]
