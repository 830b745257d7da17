"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime
size: an offset and a skip, both from the md5 of its name. The shards take
turns; at its turn a shard claims the first slot of its order that is still
free. Every shard gets as many slots as any other, give or take one, and when a
shard leaves, nearly all slots of the others stay where they are. A row's slot
is the hash of its key modulo the size, its shard one lookup away.

The table depends on the shards' names alone, never on the data. It is
broadcast: its size is a parameter, checked against a bound.

Defined cases: null keys hash as the empty string; equal keys share a shard;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.llm.common import unit_hash

SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
TABLE_SIZE = 2039
MAX_TABLE = 1 << 20


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup(shards=SHARDS, size: int = TABLE_SIZE, turns=None) -> list[int]:
    """The shard number of each slot. ``turns`` gives a shard several turns a round."""
    shards = list(shards)
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards need distinct names, one at least")
    if not _is_prime(size) or not len(shards) <= size <= MAX_TABLE:
        raise ValueError(f"the table size must be a prime from the number of shards to {MAX_TABLE}")
    digests = [hashlib.md5(name.encode()).hexdigest() for name in shards]
    at = [int(d[:15], 16) % size for d in digests]
    skip = [int(d[15:30], 16) % (size - 1) + 1 for d in digests]
    table, free = [-1] * size, size
    while free:
        for i in range(len(shards)):
            for _ in range((turns or {}).get(shards[i], 1)):
                if not free:
                    break
                while table[at[i]] >= 0:
                    at[i] = (at[i] + skip[i]) % size
                table[at[i]] = i
                free -= 1
    return table


def lookup_frame(spark: SparkSession, shards=SHARDS, size: int = TABLE_SIZE, turns=None) -> DataFrame:
    """The table as rows (slot, shard)."""
    numbers = F.from_json(F.lit(json.dumps(lookup(shards, size, turns))), "array<int>")
    names = F.from_json(F.lit(json.dumps(list(shards))), "array<string>")
    return (
        spark.range(1)
        .select(names.alias("names"), F.posexplode(numbers).alias("slot", "number"))
        .select("slot", F.element_at("names", F.col("number") + 1).alias("shard"))
    )


def place(df: DataFrame, key: str = "doc_id", shards=SHARDS, size: int = TABLE_SIZE, turns=None) -> DataFrame:
    """The rows of ``df`` with the columns ``slot`` and ``shard`` (columns of these names give way)."""
    table = lookup_frame(df.sparkSession, shards, size, turns).withColumnRenamed("slot", "_slot")
    slot = F.pmod(unit_hash(F.col(key)), F.lit(size)).cast("int")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]).alias("row"),
                     slot.alias("slot"))
    return rows.join(F.broadcast(table), F.col("slot") == F.col("_slot")).select("row.*", "slot", "shard")
