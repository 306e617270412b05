"""Shards by a permutation-filled lookup table (the table of the Maglev load balancer's paper).

Every shard has a permutation of the slots of a table of prime size: (offset + i * skip) mod size. Shards
take turns, each claiming the next slot of its permutation that is free, until the table is full. Placing a
row is one hash and one look into the table, which is broadcast; its size is fixed by its parameters and not
by the data. Adding or removing a shard moves little more than that shard's share of the rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 64
SIZE = 8191
#: The table is broadcast, so its size has a bound.
SIZE_MOST = 1 << 20


def _hash(name: str) -> int:
    """The first 60 bits of MD5, as slot_of() has them in SQL."""
    return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], size: int = SIZE) -> list[int]:
    """The shard's place in shards for each slot; size must be prime and at least the number of shards."""
    if not shards or not len(shards) <= size <= SIZE_MOST or len(set(shards)) < len(shards) or any(size % x == 0 for x in range(2, int(size**0.5) + 1)):
        raise ValueError("give distinct shards, and a prime size of at least their number and at most 2^20")
    at = [_hash(f"offset:{x}") % size for x in shards]
    skip = [_hash(f"skip:{x}") % (size - 1) + 1 for x in shards]
    table, free = [-1] * size, size
    while free:
        for k in range(len(shards)):
            while table[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % size
            table[at[k]] = k
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, size: int = SIZE) -> Column:
    """The slot of a key's text; a null key counts as the empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(size).cast("bigint"))


def place(df: DataFrame, key: str, shards: list[str] | None = None, size: int = SIZE, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """df with the columns slot and shard added; columns of these names in df are replaced.

    All rows with the same key share a shard; a null key goes where the empty text goes. Empty tables give
    empty tables, and repeated rows stay.
    """
    names = shards or [f"shard-{x:03d}" for x in range(SHARDS)]
    spark: SparkSession = df.sparkSession
    # the filled table in one row of text, which Spark splits into rows: slot, place of the shard
    filled = spark.range(1).select(F.posexplode(F.split(F.lit(",".join(map(str, lookup_table(names, size)))), ",")).alias("_slot", "_k"))
    table = filled.select(F.col("_slot").cast("bigint").alias("_slot"), F.element_at(F.array(*map(F.lit, names)), F.col("_k").cast("int") + 1).alias("_shard"))
    keyed = df.withColumn("_at", slot_of(F.col(key), size))
    joined = keyed.join(F.broadcast(table), F.col("_at") == F.col("_slot"), "left")
    kept = [F.col(f"`{x}`") for x in df.columns if x not in (slot, shard)]
    return joined.select(*kept, F.col("_at").alias(slot), F.col("_shard").alias(shard))


def oracle(shards: list[str] | None = None, size: int = SIZE) -> str:
    """The same for documents in DuckDB, with the filled table as a list."""
    names = shards or [f"shard-{x:03d}" for x in range(SHARDS)]
    return f"""
WITH filled AS (SELECT {lookup_table(names, size)} AS t, {names} AS names),
slots AS (SELECT doc_id, source, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {size} AS slot FROM documents)
SELECT doc_id, source, slot, names[t[slot + 1] + 1] AS shard FROM slots, filled"""
