"""Placement of keys on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table
(start and step from a digest of its name).  The shards take turns; at a turn a
shard claims the first free slot of its order.  So slots are even to within one
turn, and when a shard joins or leaves most slots keep their owner.  A key hashes
to a slot; placement is one look-up in a table whose size is the parameter
``slots``, never the data's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm.common import whole
from catalith.llm.registry import query

#: Prime, some thousand times the number of shards.
SLOTS = 65_537
SHARDS = 64


def preference(name: str, slots: int) -> tuple[int, int]:
    """Start and step of a shard's order: slot ``(start + k * step) % slots`` for k = 0, 1, ..."""
    digest = hashlib.sha256(name.encode()).digest()
    return int.from_bytes(digest[:8], "little") % slots, int.from_bytes(digest[8:16], "little") % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The owner (index into ``shards``) of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, one at least")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)) or len(shards) > slots:
        raise ValueError("slots must be a prime, no smaller than the number of shards")
    orders = [preference(s, slots) for s in shards]
    nxt, owner, filled = [0] * len(shards), [-1] * slots, 0
    while filled < slots:
        for k, (start, step) in enumerate(orders):
            if filled == slots:
                break
            while owner[at := (start + nxt[k] * step) % slots] >= 0:
                nxt[k] += 1
            owner[at] = k
            nxt[k] += 1
            filled += 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: its XXH64 as text; a null key counts as the empty text."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(slots)).cast("int")


def place(df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot``, ``shard_no`` and ``shard`` added (columns of these names are replaced).

    Equal keys, repeated rows and null keys go to one shard each time; an empty
    table stays empty.  Every row is kept, without a shuffle: the table of ``slots``
    rows is broadcast.
    """
    spark = df.sparkSession
    rows = [(slot, k, shards[k]) for slot, k in enumerate(lookup_table(shards, slots))]
    table = spark.createDataFrame(rows, "slot int, shard_no int, shard string")
    plain = df.drop("shard_no", "shard").withColumn("slot", slot_of(F.col(key), slots))
    return plain.join(F.broadcast(table), "slot").select(*[c for c in plain.columns if c != "slot"], "slot", "shard_no", "shard")


def write_shards(df: DataFrame, key: str, shards: Sequence[str], path: str, files: int = 8, slots: int = SLOTS) -> None:
    """Write a folder per shard; a shard's rows are dealt over ``files`` files, so none waits for one task."""
    placed = place(df, key, shards, slots).withColumn("_file", F.pmod(F.col("slot"), F.lit(files)))
    placed.repartition(len(shards) * files, "shard", "_file").drop("_file").write.partitionBy("shard").parquet(path)


@query("op9_sharding")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place among 64 shards."""
    docs = whole(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    return place(docs, "doc_id", [f"shard-{k:03d}" for k in range(SHARDS)]).select("doc_id", "slot", "shard_no", "shard")
