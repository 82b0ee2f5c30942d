"""Placing documents on shards through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size. The shards take turns, each claiming its first free slot, until the
table is full; so all get nearly the same number of slots, and a shard that
leaves hands on its own slots and few others. A document's key gives a slot,
the slot the shard. The table has `slots` rows whatever the data, so it may be
broadcast.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 65537


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def preference(shard: str, slots: int) -> tuple[int, int]:
    """First slot and step of a shard's order; the step is coprime to the prime."""
    digest = hashlib.blake2b(shard.encode(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1


def fill(shards: list[str], slots: int = SLOTS, turns: dict[str, int] | None = None) -> list[str]:
    """The shard of every slot. `turns` lets a shard claim several slots a round."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be given, each once")
    if not is_prime(slots) or slots < len(shards):
        raise ValueError("the table needs a prime size, not below the number of shards")
    order = sorted(shards)
    at, step = map(list, zip(*(preference(s, slots) for s in order)))
    table: list[str | None] = [None] * slots
    free = slots
    while free:
        for k, shard in enumerate(order):
            for _ in range((turns or {}).get(shard, 1)):
                if not free:
                    break
                while table[at[k]] is not None:
                    at[k] = (at[k] + step[k]) % slots
                table[at[k]] = shard
                free -= 1
    return table


def place(docs: DataFrame, shards: list[str], key_col: str = "doc_id", slots: int = SLOTS, turns: dict[str, int] | None = None) -> DataFrame:
    """`docs` with slot (long) and shard (string).

    Equal keys go to one shard, and a null key counts as a key like any other.
    Rows are placed each on its own, repeated ones alike, texts are not
    looked at, an empty table gives an empty result; columns named slot or
    shard are replaced.
    """
    table = list(enumerate(fill(shards, slots, turns)))
    lookup = docs.sparkSession.createDataFrame(table, "slot long, shard string")
    keep = [c for c in docs.columns if c not in ("slot", "shard")]
    slot = F.pmod(F.xxhash64(F.col(key_col)), F.lit(slots)).cast("long")
    slotted = docs.select(*keep, slot.alias("slot"))
    return slotted.join(F.broadcast(lookup), "slot").select(*keep, "slot", "shard")
