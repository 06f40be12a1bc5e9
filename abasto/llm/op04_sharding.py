"""Sharding by a permutation-filled lookup table.

Every shard has a preference order of the table's slots: a start and a step from hashes of its name, modulo the table's
prime size, which visits every slot. The shards take turns; each claims the first slot of its order that is still free,
until the table is full. Shards differ by one slot at most, and a shard that comes or goes moves few slots of the others.
A row's slot is a hash of its key modulo the size; the table, of a fixed size, is broadcast.

Null key: the slot of the empty text. Repeated keys share a shard. Empty table: no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIZE = 65_537  # prime, more than 100 slots a shard for some hundred shards


def _number(text: str, salt: str, modulus: int) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8, person=salt.encode()).digest(), "big") % modulus


def lookup_table(shards: list[str], size: int = SIZE) -> np.ndarray:
    """The shard number of every slot."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("give different shard names, at least one and no more than there are slots")
    if size < 2 or any(size % divisor == 0 for divisor in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size has to be prime")
    at = [_number(name, "start", size) for name in shards]
    step = [_number(name, "step", size - 1) + 1 for name in shards]
    table, free = np.full(size, -1, dtype=np.int32), size
    while free:
        for shard in range(min(len(shards), free)):
            slot = at[shard]
            while table[slot] >= 0:
                slot = (slot + step[shard]) % size
            table[slot] = shard
            at[shard] = (slot + step[shard]) % size
            free -= 1
    return table


def slot_of(key, size: int = SIZE):
    """A column: the slot of a key."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards: list[str], size: int = SIZE) -> DataFrame:
    """The table with the columns ``slot`` and ``shard`` (the name) behind it, which replace columns of these names."""
    spark = df.sparkSession
    table = lookup_table(shards, size)
    rows = [(slot, shards[shard]) for slot, shard in enumerate(table.tolist())]
    found = spark.createDataFrame(rows, "slot int, shard string")
    kept = df.select(*(F.col(f"`{name}`") for name in df.columns if name not in ("slot", "shard")), slot_of(df[key], size).alias("slot"))
    return kept.join(F.broadcast(found), "slot").select(*(f"`{name}`" for name in kept.columns), "shard")


def write_shards(df: DataFrame, key: str, shards: list[str], folder: str, size: int = SIZE) -> None:
    """One folder per shard. Rows are brought together by shard first, and a large shard is dealt over several tasks."""
    placed = place(df, key, shards, size).hint("rebalance", F.col("shard"))
    placed.write.partitionBy("shard").option("compression", "zstd").parquet(folder)


def read_shards(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of all shards, with the shard's name; ``schema`` is that of the table that was sharded."""
    kept = [field for field in schema if field.name not in ("slot", "shard")]
    extra = [T.StructField("slot", T.IntegerType()), T.StructField("shard", T.StringType())]
    return spark.read.schema(T.StructType([*kept, *extra])).parquet(folder)
