"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size: slots
``offset, offset + skip, offset + 2 skip, ...`` modulo the size, both numbers from a hash of
the shard's name (the size is prime, so any skip visits every slot). Shards take turns
claiming the next free slot they prefer until the table is full; a shard of weight w takes w
turns a round. So each shard owns its share of the slots within one turn, and a changed
shard list moves few keys beyond those that must move. A row's slot is a hash of its key;
its shard is one lookup in the table, which is broadcast: its size is a parameter, at most
``MAX_SLOTS`` rows, whatever the data.

Placement needs no shuffle. A key that holds a third of all rows would put them in one
shard; ``spread`` > 1 splits every key over that many slots by a second hash of ``salt``.

Defined cases: a null key is a key of its own (all null keys share a slot); repeated rows get
the same place; an empty table gives no rows; a data column named ``slot`` or ``shard``
is replaced by the result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_SLOTS = 1_000_003


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def fill_table(shards: dict[str, int], size: int) -> np.ndarray:
    """Shard number (in the order of ``shards``: name to weight) of each slot."""
    if not _is_prime(size) or size > MAX_SLOTS:
        raise ValueError(f"the table size is a prime up to {MAX_SLOTS}, not {size}")
    if not shards or len(shards) > size or any(w < 1 for w in shards.values()):
        raise ValueError("at least one shard, no more shards than slots, and weights of 1 or more")
    table = np.full(size, -1, np.int32)
    at, skip = [], []
    for name in shards:
        h = hashlib.sha256(name.encode()).digest()
        at.append(int.from_bytes(h[:8], "big") % size)
        skip.append(int.from_bytes(h[8:16], "big") % (size - 1) + 1 if size > 2 else 1)
    turns = [k for k, w in enumerate(shards.values()) for _ in range(w)]
    left = size
    while True:
        for k in turns:
            while table[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % size
            table[at[k]] = k
            left -= 1
            if not left:
                return table


def lookup(spark: SparkSession, shards: dict[str, int], size: int) -> DataFrame:
    """The table as rows ``slot, shard`` (the shard's name)."""
    names = list(shards)
    rows = [(slot, names[k]) for slot, k in enumerate(fill_table(shards, size).tolist())]
    return spark.createDataFrame(rows, "slot int, shard string")


def place(df: DataFrame, key: str, shards: dict[str, int], size: int = 65_537, spread: int = 1, salt: str | None = None) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` of each row."""
    if spread > 1 and salt is None:
        raise ValueError("spread needs a salt column")
    hashed = [F.col(key).cast("string")]
    if spread > 1:
        hashed.append(F.pmod(F.xxhash64(F.col(salt).cast("string")), F.lit(spread)))
    slotted = df.withColumn("slot", F.pmod(F.xxhash64(*hashed), F.lit(size)).cast("int")).drop("shard")
    return slotted.join(F.broadcast(lookup(df.sparkSession, shards, size)), "slot").select(*[c for c in df.columns if c not in ("slot", "shard")], "slot", "shard")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard; each task writes what it holds, so no shard is gathered in one task."""
    placed.write.partitionBy("shard").parquet(path)
