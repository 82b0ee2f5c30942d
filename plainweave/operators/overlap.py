"""Corpus BLEU and chrF: n-gram matches summed over all rows of a group before
they are compared, not means of row scores.

The n-grams are counted where their texts are: texts are hash-partitioned by
row key once, as for SARI, and only one row of sums per text goes on to the
groups. A group may hold any share of the rows, since tasks add up first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.functions.text import SPACE, normal_tokens
from plainweave.operators.sari import ngrams, placed

MAX_N, CHAR_N, BETA = 4, 6, 2
CHAR_PART_BYTES = 512 << 10  # a text has more n-grams of characters than of tokens


def _words(c: Column) -> Column:
    return F.filter(normal_tokens(c), lambda t: t != "")


def _chars(c: Column) -> Column:
    """Characters but white space."""
    return F.regexp_extract_all(c, F.lit(rf"[^{SPACE}]"), F.lit(0))


def _whole(prediction: str, references: str) -> Column:
    known = F.col(prediction).isNotNull() & (F.size(references) > 0) & ~F.exists(references, lambda r: r.isNull())
    return F.coalesce(known, F.lit(False))


def _over(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part).cast("double"), F.col(whole))


def bleu_counts(
    df: DataFrame, keys: list[str], by: list[str], prediction: str = "prediction", references: str = "references",
    max_n: int = MAX_N, partitions: int | None = None,
) -> DataFrame:
    """Per row that is whole: tokens, tokens of the reference nearest in length
    (the shorter of two), and per n the n-grams and those that a reference has,
    each at most as often as the reference with most of them."""
    texts = placed(df.where(_whole(prediction, references)), [*keys, *by], [prediction, references], partitions)
    p, rs = _words(F.col(prediction)), F.transform(references, _words)
    toks = texts.select(*keys, *by, p.alias("_p"), rs.alias("_rs"))
    n = F.size("_p")
    nearest = F.array_min(F.transform("_rs", lambda r: F.named_struct(F.lit("away"), F.abs(F.size(r) - n), F.lit("size"), F.size(r))))
    sided = toks.select(
        *keys, *by, n.alias("_n"), nearest["size"].alias("_near"), F.posexplode(F.concat(F.array("_p"), F.col("_rs"))).alias("_side", "_toks")
    )
    carried = [*keys, *by, "_n", "_near"]
    grams = ngrams(sided, [*carried, "_side"], "_toks", max_n)
    counted = grams.groupBy(*carried, "_side", "n", "gram").agg(F.count(F.lit(1)).alias("c"))
    mine, theirs = F.col("_side") == 0, F.col("_side") > 0
    each = counted.groupBy(*carried, "n", "gram").agg(
        F.coalesce(F.max(F.when(mine, F.col("c"))), F.lit(0)).alias("c"), F.coalesce(F.max(F.when(theirs, F.col("c"))), F.lit(0)).alias("r")
    )
    of = lambda k, c: F.sum(F.when(F.col("n") == k, c).otherwise(0))
    sums = [x for k in range(1, max_n + 1) for x in (of(k, F.least("c", "r")).alias(f"match{k}"), of(k, F.col("c")).alias(f"grams{k}"))]
    return each.groupBy(*carried).agg(*sums).withColumnsRenamed({"_n": "tokens", "_near": "reference_tokens"})


def bleu(
    df: DataFrame, keys: list[str], by: list[str] = (), prediction: str = "prediction", references: str = "references",
    max_n: int = MAX_N, partitions: int | None = None,
) -> DataFrame:
    """Corpus BLEU (0-100) of every group `by`: geometric mean of the precisions
    of 1 to max_n tokens times the brevity penalty.

    Tokens are those of SARI, lower-cased. Rows with a null text or without a
    reference take no part. A precision without a match is halved once more
    each time (1/2, 1/4, ... of a match); a group without any n-gram of some
    length scores 0.
    """
    by = list(by)
    counts = bleu_counts(df, keys, by, prediction, references, max_n, partitions)
    names = ["tokens", "reference_tokens", *[f"{c}{k}" for k in range(1, max_n + 1) for c in ("match", "grams")]]
    total = counts.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    missed, logs, none = F.lit(0), F.lit(0.0), F.lit(False)
    for k in range(1, max_n + 1):
        match, grams = F.col(f"match{k}"), F.col(f"grams{k}")
        missed = missed + F.when((match == 0) & (grams > 0), 1).otherwise(0)
        share = F.when(match == 0, F.lit(1.0) / (F.pow(F.lit(2.0), missed) * grams)).otherwise(_over(f"match{k}", f"grams{k}"))
        logs = logs + F.when(grams > 0, F.log(share)).otherwise(0.0)
        none = none | (grams == 0)
    short = F.col("tokens") < F.col("reference_tokens")
    penalty = F.when(short, F.exp(1 - F.try_divide(F.col("reference_tokens").cast("double"), F.col("tokens")))).otherwise(1.0)
    score = F.when(none, 0.0).otherwise(100 * penalty * F.exp(logs / max_n))
    return total.select(*by, score.alias("bleu"), F.when(F.col("tokens") > 0, penalty).otherwise(0.0).alias("brevity_penalty"), *names)


def _f_score(names: list[tuple[str, str, str]], beta: int) -> Column:
    """From (match, n-grams, n-grams of the reference) per n: F of the mean
    precision and recall over the n that both sides have."""
    used, precision, recall = F.lit(0), F.lit(0.0), F.lit(0.0)
    for match, mine, theirs in names:
        both = (F.col(mine) > 0) & (F.col(theirs) > 0)
        used = used + F.when(both, 1).otherwise(0)
        precision = precision + F.when(both, _over(match, mine)).otherwise(0.0)
        recall = recall + F.when(both, _over(match, theirs)).otherwise(0.0)
    p, r = F.try_divide(precision, used), F.try_divide(recall, used)
    return F.coalesce(F.try_divide((1 + beta**2) * p * r, beta**2 * p + r), F.lit(0.0))


def chrf(
    df: DataFrame, keys: list[str], by: list[str] = (), prediction: str = "prediction", references: str = "references",
    max_n: int = CHAR_N, beta: int = BETA, partitions: int | None = None,
) -> DataFrame:
    """Corpus chrF (0-100) of every group `by`: F score of the n-grams of 1 to
    max_n characters, white space left out, case kept.

    Of several references each row counts the one it scores best with, the
    first of equals. Rows with a null text or without a reference take no part;
    a group without any character in common scores 0.
    """
    by = list(by)
    texts = placed(df.where(_whole(prediction, references)), [*keys, *by], [prediction, references], partitions, CHAR_PART_BYTES)
    pairs = texts.select(*keys, *by, F.col(prediction).alias("_p"), F.posexplode(references).alias("_ref", "_r"))
    carried = [*keys, *by, "_ref"]
    sided = pairs.select(*carried, F.posexplode(F.array(_chars(F.col("_p")), _chars(F.col("_r")))).alias("_side", "_toks"))
    counted = ngrams(sided, [*carried, "_side"], "_toks", max_n).groupBy(*carried, "n", "gram").agg(
        F.count_if(F.col("_side") == 0).alias("c"), F.count_if(F.col("_side") == 1).alias("r")
    )
    names = [(f"match{k}", f"grams{k}", f"reference_grams{k}") for k in range(1, max_n + 1)]
    of = lambda k, c: F.sum(F.when(F.col("n") == k, c).otherwise(0))
    sums = [
        of(k, c).alias(name) for k, three in enumerate(names, 1)
        for name, c in zip(three, (F.least("c", "r"), F.col("c"), F.col("r")))
    ]
    flat = [n for three in names for n in three]
    each = counted.groupBy(*carried).agg(*sums).withColumn("_score", _f_score(names, beta))
    best = each.groupBy(*keys, *by).agg(F.max_by(F.struct(*flat), F.struct("_score", -F.col("_ref"))).alias("b"))
    total = best.groupBy(*by).agg(*[F.coalesce(F.sum(F.col("b").getField(n)), F.lit(0)).alias(n) for n in flat])
    return total.select(*by, (100 * _f_score(names, beta)).alias("chrf"), *flat)
