"""Sharding by a lookup table that the shards fill in turn.

The table has a prime number of slots. Every shard has its own order of
preference over all slots, a permutation that starts at an offset and goes on
by a step, both from the shard's name. The shards take turns, each claiming the
first slot of its order that is still free, until the table is full. So shares
differ by one slot at most, and a shard that leaves gives up its slots while
the others mostly keep theirs. A document's key is hashed to a slot; the table
is broadcast, its size being a parameter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime, a hundred times the number of shards or more.
SLOTS = 65_537
_DIGITS = 15  # hexadecimal digits of a digest that fit a long


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:_DIGITS], 16)


def filled_slots(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The number of the shard that holds each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need names of their own")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime and not below the number of shards")
    at = [_number(f"{name}/offset") % slots for name in shards]
    step = [_number(f"{name}/step") % (slots - 1) + 1 for name in shards]
    table, free = [-1] * slots, slots
    while free:
        for shard in range(min(len(shards), slots)):
            if not free:
                break
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            table[at[shard]] = shard
            free -= 1
    return table


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``slot`` and ``shard`` (name) of every slot."""
    holders = ",".join(map(str, filled_slots(shards, slots)))
    names = F.array(*map(F.lit, shards))
    return spark.range(1).select(F.posexplode(F.split(F.lit(holders), ",")).alias("slot", "holder")).select(
        F.col("slot").cast("long").alias("slot"), F.get(names, F.col("holder").cast("int")).alias("shard")
    )


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key by its text's digest; a NULL key has that of the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("long") % slots


def with_shard(docs: DataFrame, shards: Sequence[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot`` and ``shard``, which replace columns of these names; no shuffle."""
    table = F.broadcast(lookup_table(docs.sparkSession, shards, slots))
    placed = docs.drop("shard").withColumn("slot", slot_of(F.col(key), slots))
    return placed.join(table, "slot").select(*[placed[c] for c in placed.columns], "shard")


def write_shards(docs: DataFrame, shards: Sequence[str], path: str, key: str = "doc_id", pieces: int = 1) -> None:
    """Write Parquet folders ``shard=<name>``, each from ``pieces`` tasks."""
    placed = with_shard(docs, shards, key)
    piece = F.pmod(F.xxhash64(key), F.lit(pieces))
    placed.withColumn("__piece", piece).repartition(len(shards) * pieces, "shard", "__piece").drop("__piece").write.partitionBy(
        "shard"
    ).parquet(path)
