"""Sharding by a permutation-filled lookup table.

Every shard has its own order of the slots of a prime-sized table, an offset and a stride drawn
from its name. The shards take turns, each claiming the next free slot of its order, until the
table is full: all shards get equal shares (or shares by weight), and when a shard comes or goes
few other slots change hands. A row's key is hashed to a slot and the slot names its shard: one
look-up in a table whose size is fixed, so it is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime, about a thousand times the number of shards at hand; the table is broadcast.
SLOTS = 65_537
MOST_SLOTS = 1 << 20
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS) -> list[str]:
    """The shard of each slot. A mapping gives weights: claims in each round of turns.

    ``slots`` must be a prime (every stride then visits every slot), larger than the number of
    shards, and at most ``MOST_SLOTS``, the bound of what is broadcast.
    """
    weights = shards if isinstance(shards, Mapping) else dict.fromkeys(shards, 1)
    takers = {name: weight for name, weight in weights.items() if weight > 0}
    if not takers or len(takers) >= slots:
        raise ValueError("give at least one shard with a weight, and more slots than shards")
    if slots > MOST_SLOTS or any(slots % n == 0 for n in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime of at most {MOST_SLOTS}")
    at = {name: _hash(f"offset {name}") % slots for name in takers}
    stride = {name: _hash(f"stride {name}") % (slots - 1) + 1 for name in takers}
    table: list[str | None] = [None] * slots
    free = slots
    while free:
        for name in sorted(takers):
            for _ in range(min(takers[name], free)):
                while table[at[name]] is not None:
                    at[name] = (at[name] + stride[name]) % slots
                table[at[name]] = name
                free -= 1
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 15 hex digits of the MD5 of its text, modulo the table's size."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def place(
    rows: DataFrame, key: str, shards: Sequence[str] | Mapping[str, int] = SHARDS, slots: int = SLOTS,
) -> DataFrame:
    """All rows with their ``slot`` and ``shard``; nothing is shuffled.

    Equal keys share a shard, so choose a key that no large group of rows has in common. A NULL
    key counts as the empty text. Columns named ``slot`` or ``shard`` are replaced; repeated rows
    stay repeated.
    """
    table = rows.sparkSession.createDataFrame(
        list(enumerate(fill(shards, slots))), "slot int, shard string")
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("slot", "shard")]
    return rows.select(*kept, slot_of(F.col(f"`{key}`"), slots).alias("slot")).join(
        F.broadcast(table), "slot", "left").select(*kept, "slot", "shard")
