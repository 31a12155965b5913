"""Sharding by a permutation-filled lookup table.

Every shard owns a permutation of the slots of a prime-sized table, given by
an offset and a skip (both from a hash of its name). Shards take turns; each
turn claims the shard's next free slot, until all slots are taken. Loads are
even to one slot, and adding or removing a shard moves few other slots.

The table holds ``slots`` rows, fixed by a parameter and independent of the
data, so it is broadcast: a row's shard is one hash and one lookup, in a map-only plan. Rows
with one key share a shard; placement itself shuffles nothing, so a hot key
costs no task more than its own rows.

Defined cases: a null key goes to slot 0; repeated keys share a shard;
an empty table gives an empty result; other columns are carried, but for
own columns named slot or shard, which the result's replace.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65537


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Slot -> index of the shard that claimed it."""
    if not is_prime(slots):
        raise ValueError(f"{slots} slots: the table size must be prime")
    if not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("shard names must be distinct, at least one and at most one a slot")
    at = [_number(f"offset:{s}") % slots for s in shards]
    skip = [_number(f"skip:{s}") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    owner = [-1] * slots
    free = slots
    while free:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.substring(F.md5(key.cast("string").cast("binary")), 1, 15)
    return F.coalesce(F.conv(digest, 16, 10).cast("bigint") % slots, F.lit(0)).cast("int")


def place(rows: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with the columns slot and shard."""
    owner = fill(shards, slots)
    carried = [c for c in rows.columns if c.lower() not in ("slot", "shard")]
    number = "slot"
    while number in (c.lower() for c in rows.columns):
        number += "_"
    lookup = rows.sparkSession.createDataFrame(
        [(i, shards[s]) for i, s in enumerate(owner)], f"{number} int, shard string")
    keyed = rows.select(*carried, slot_of(F.col(key), slots).alias(number))
    return (keyed.join(F.broadcast(lookup), number)
            .select(F.col(number).alias("slot"), *carried, "shard"))


def write(placed: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """One folder a shard. Each shard's rows are dealt over several tasks by a
    salt, so a hot shard is not written by one task."""
    salt = F.pmod(F.xxhash64(*[c for c, t in placed.dtypes if c != "shard" and not t.startswith("map")]),
                  F.lit(files_per_shard))
    (placed.withColumn("_salt", salt)
     .repartition("shard", "_salt").drop("_salt")
     .write.mode("errorifexists").partitionBy("shard").parquet(path))
