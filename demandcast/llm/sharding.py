"""Placement of documents on shards by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own. The shards take turns,
each claiming the first slot it likes that is still free, until the table is full. A document's
slot is a hash of its key modulo the table size, so placing it takes one lookup in a broadcast
table of fixed size. Shares are equal to within one slot for each unit of weight, and a shard more
or less moves few documents that it does not itself gain or lose.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.llm.common import fresh_name

SHARDS = 64
TABLE_SIZE = 65_537
#: Most slots a table may have: it is broadcast, at 12 bytes a slot.
LARGEST_TABLE = 1 << 22
TEXTS_PER_FILE = 200_000


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:7], "big")


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE, weights: Sequence[int] | None = None) -> list[int]:
    """For each slot the place of its shard in ``shards``.

    ``size`` has to be a prime above the number of shards. A shard of weight w takes w turns in a round.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names have to be given and be different")
    if size <= len(shards) or size > LARGEST_TABLE or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size has to be a prime above the number of shards, and within LARGEST_TABLE")
    if weights is not None and (len(weights) != len(shards) or min(weights) < 1):
        raise ValueError("each shard takes at least one turn")
    offset = [_hash(f"offset {s}") % size for s in shards]
    skip = [_hash(f"skip {s}") % (size - 1) + 1 for s in shards]
    nth = [0] * len(shards)
    table, filled = [-1] * size, 0
    turns = [n for n in range(len(shards)) for _ in range(weights[n] if weights else 1)]
    while filled < size:
        for n in turns:
            while True:
                slot = (offset[n] + nth[n] * skip[n]) % size
                nth[n] += 1
                if table[slot] < 0:
                    break
            table[slot] = n
            filled += 1
            if filled == size:
                break
    return table


def table_rows(spark: SparkSession, table: Sequence[int], names: tuple[str, str] = ("slot", "shard")) -> DataFrame:
    """The lookup table as rows, made on the executors from one binary literal."""
    held = F.lit(b"".join(n.to_bytes(4, "big") for n in table))
    entry = F.conv(F.hex(F.substring(held, (F.col("id") * 4 + 1).cast("int"), 4)), 16, 10).cast("int")
    return spark.range(len(table)).select(F.col("id").cast("int").alias(names[0]), entry.alias(names[1]))


def slot_of(key: Column, size: int) -> Column:
    """Slot of a key: 56 bits of its md5 modulo the table size. A null key counts as the empty text."""
    digest = F.md5(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8"))
    return F.pmod(F.conv(F.substring(digest, 1, 14), 16, 10).cast("long"), F.lit(size)).cast("int")


def assign_shards(
    docs: DataFrame,
    shards: Sequence[str],
    size: int = TABLE_SIZE,
    key: str = "doc_id",
    weights: Sequence[int] | None = None,
    slot: str = "slot",
    shard: str = "shard",
) -> DataFrame:
    """``docs`` with the columns ``slot`` and ``shard``; nothing is shuffled.

    Rows of one key share a shard, null keys too. ``docs`` may be empty; it must not have the two columns.
    """
    if {slot, shard} & set(docs.columns):
        raise ValueError(f"columns {slot} and {shard} are taken, name others")
    rows = table_rows(docs.sparkSession, lookup_table(shards, size, weights), (slot, shard))
    return docs.withColumn(slot, slot_of(F.col(key), size)).join(F.broadcast(rows), slot)


def write_shards(docs: DataFrame, folder: str, shards: Sequence[str], per_file: int = TEXTS_PER_FILE, **options) -> None:
    """Write ``docs`` to one folder per shard, in files of at most ``per_file`` rows.

    Each shard's rows are dealt to several tasks by slot, so a shard is never one task's work.
    """
    shard = fresh_name(docs, "shard")
    slot = fresh_name(docs, "slot")
    placed = assign_shards(docs, shards, shard=shard, slot=slot, **options)
    (
        placed.repartition(F.col(shard), F.col(slot) % 16)
        .drop(slot)
        .write.partitionBy(shard)
        .option("maxRecordsPerFile", per_file)
        .mode("errorifexists")
        .parquet(folder)
    )
