"""Seeded randomness that depends on the row alone.

``rand(seed)`` changes with the partitioning and with task retries. A digest of
(seed, purpose, row key) does not: the same row draws the same number on any
cluster, in a batch or on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_DIGITS = 4
BUCKETS = 16**BUCKET_DIGITS


def row_key(keys: list[str]) -> Column:
    """Text form of a row's key columns; one column stays as it is."""
    return F.concat_ws(":", *[F.col(k).cast("string") for k in keys])


def order_key(seed: int, purpose: str, keys: list[str]) -> Column:
    """32 hex digits; sorting by them is a seeded shuffle."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(purpose), row_key(keys)))


def uniform(seed: int, purpose: str, keys: list[str]) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of the digest."""
    head = F.substring(order_key(seed, purpose, keys), 1, 8)
    return F.conv(head, 16, 10).cast("long") / F.lit(4294967296.0)


def choice(u: Column, options: list[str]) -> Column:
    """The option a uniform draw falls on, each equally likely."""
    k = F.floor(u * F.lit(float(len(options)))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(o) for o in options]), k)


def bucket(order: Column) -> Column:
    """Leading digits of an order key: equal-sized, order-preserving buckets."""
    return F.conv(F.substring(order, 1, BUCKET_DIGITS), 16, 10).cast("int")
