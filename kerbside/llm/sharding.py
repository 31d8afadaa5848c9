"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table. The shards take turns and
claim the next free slot of their order until the table is full, so each gets its share of the slots within
one, and a shard that joins or leaves moves few slots besides its own. A row's slot is a hash of its key modulo
the size of the table. The table is broadcast: its size is a parameter and does not grow with the rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TABLE_SIZE = 65_537


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(shard: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{shard}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> np.ndarray:
    """Index of the shard that owns each slot. ``size`` must be prime, so that every preference visits all slots."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, and one at least")
    if not is_prime(size) or size < len(shards):
        raise ValueError("the table's size must be a prime of at least the number of shards")
    places = [(_number(s, "offset") % size, _number(s, "skip") % (size - 1) + 1) for s in shards] if size > 2 else [
        (_number(s, "offset") % size, 1) for s in shards
    ]
    owner = np.full(size, -1, np.int32)
    tried = [0] * len(shards)
    claimed = 0
    while claimed < size:
        for shard, (offset, skip) in enumerate(places):
            slot = (offset + tried[shard] * skip) % size
            while owner[slot] >= 0:
                tried[shard] += 1
                slot = (offset + tried[shard] * skip) % size
            owner[slot] = shard
            tried[shard] += 1
            claimed += 1
            if claimed == size:
                break
    return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo the table's size. NULL is hashed as ''."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % size).cast("int")


def table_frame(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """The lookup table as rows (slot, shard)."""
    owner = lookup_table(shards, size)
    return spark.createDataFrame([(i, shards[o]) for i, o in enumerate(owner.tolist())], "slot int, shard string")


def place(rows: DataFrame, key: str, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """``rows`` with their ``slot`` and ``shard``; columns of ``rows`` with these names are replaced.

    Rows with equal keys, NULL included, share a shard. The join never shuffles ``rows``.
    """
    kept = rows.drop(*[c for c in ("slot", "shard") if c != key])
    table = table_frame(rows.sparkSession, shards, size).withColumnRenamed("slot", "_slot")
    slot = slot_of(F.col(key), size)
    if key in ("slot", "shard"):
        raise ValueError("the key column may not be called slot or shard")
    return (
        kept.withColumn("slot", slot)
        .join(F.broadcast(table), F.col("slot") == F.col("_slot"), "left")
        .drop("_slot")
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Placed rows as Parquet, one folder per shard; tasks write to all folders, so a hot shard is no one task."""
    placed.write.mode("errorifexists").partitionBy("shard").parquet(path)
