"""Lines that several documents share, kept in the first document only.

Every line long enough is a normalised key, told by 128 bits of hash. Keys
are counted by distinct documents; the lines of a key over the threshold go
from all documents but the first that holds it. What moves are hashes and
positions; the texts move once, to meet the positions that they lose, and are
put together again around those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plainweave.operators.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\v\f\r"
MIN_CHARS, MIN_DOCUMENTS = 10, 2
NEW = ["n_lines", "n_dropped"]


def keys(text: Column) -> Column:
    """Every line without space around it, A-Z lower-cased."""
    return F.transform(split(F.translate(text, UPPER, LOWER)), lambda line: F.btrim(line, F.lit(SPACE)))


def digest(text: Column) -> list[Column]:
    """128 bits as two longs, g and h."""
    return [F.xxhash64(text).alias("g"), F.xxhash64(F.lit("line"), text).alias("h")]


def split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def without(lines: Column, gone: Column) -> Column:
    """Lines but those at the rising positions `gone`, run by run between them,
    so in time linear in the lines."""
    before = lambda k: F.coalesce(F.get(gone, k - 1), F.lit(-1))
    upto = lambda k: F.coalesce(F.get(gone, k), F.size(lines))
    runs = F.transform(
        F.sequence(F.lit(0), F.size(gone)), lambda k: F.slice(lines, before(k) + 2, upto(k) - before(k) - 1)
    )
    return F.flatten(runs)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and the text's digest, by which a row finds what it loses."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    return own.select("*", *[d.alias(f"t{n}") for d, n in zip(digest(F.col("text")), "gh")])


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """A row per line of at least `min_chars`: id, digests of text and key, position."""
    each = rows.select("id", "tg", "th", F.posexplode(keys(F.col("text"))).alias("position", "key"))
    long = each.where(F.char_length("key") >= min_chars)
    return long.select("id", "tg", "th", "position", *digest(F.col("key")))


def repeated(lines: DataFrame, min_documents: int) -> DataFrame:
    """g, h of keys in at least `min_documents` documents, and the first of
    these. Each document counts once per key; both steps add up in the tasks
    that read before anything moves, so a key in every document is no hot one."""
    once = lines.select("g", "h", "id").distinct()
    counted = once.groupBy("g", "h").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("owner"))
    return counted.where(F.col("n") >= min_documents).select("g", "h", "owner")


def drop_repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """`docs` with `text_col` replaced by the lines that stay, n_lines (before)
    and n_dropped.

    Null and empty texts are one empty line. Rows with one id are one document;
    rows with a null id are one document too, after all others, and so never
    the first. A document keeps every copy of a line that it is the first to
    hold. Long texts are read whole. An empty table gives an empty result;
    columns with the names of the new ones are replaced, others pass unchanged
    whatever their names.
    """
    lines = stage(_lines(_rows(docs, id_col, text_col), min_chars))
    # written, so that both sides of the join are plain shuffles, in which
    # adaptive execution splits a line that a third of all documents hold
    shared = stage(repeated(lines, min_documents))
    lost = lines.join(shared, ["g", "h"]).where(~F.col("id").eqNullSafe(F.col("owner")))
    gone = lost.groupBy("id", "tg", "th").agg(F.array_sort(F.collect_set("position")).alias("gone"))

    names = [c for c in docs.columns if c not in (text_col, *NEW)]  # the text travels once
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.struct(*[F.col(c).alias(c) for c in dict.fromkeys([id_col, *names])]).alias("row"), text.alias("text"))
    own = own.withColumn("doc", F.col("row").getField(id_col))
    own = own.select("*", *[d.alias(f"o{n}") for d, n in zip(digest(F.col("text")), "gh")])
    same = F.col("doc").eqNullSafe(F.col("id")) & (F.col("og") == F.col("tg")) & (F.col("oh") == F.col("th"))
    joined = own.join(gone, same, "left").select("row", "text", "gone", split(F.col("text")).alias("lines"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(without(F.col("lines"), F.col("gone")), "\n"))
    fields = [
        (kept if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns if c == text_col or c not in NEW
    ]
    return joined.select(
        *fields, F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
