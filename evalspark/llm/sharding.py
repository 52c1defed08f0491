"""Sharding by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a prime-sized table, (offset + j * skip) mod size. Shards take turns,
each claiming its next free slot, until the table is full. A row's key is hashed to a slot, and the broadcast table of
``size`` rows gives its shard: constant time, no shuffle, and few rows move when a shard joins or leaves.

The table depends on the shard names and its size alone and is filled while the plan is made, at ``size`` rows at most;
placement of the data is DataFrame expressions and one broadcast join.

Edge cases: a null key is placed by the row's text instead, and where that is null too, as an empty text. Empty tables
give empty results. Equal keys always share a shard, repeated rows included. Other columns pass through; an older
``slot`` or ``shard`` column is replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

SHARDS, SIZE = 16, 2039  # the size is a prime above 100 slots a shard, so shares differ by under 1 %


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup(shards: list[str], size: int = SIZE) -> list[int]:
    """For each slot the number of the shard that claimed it."""
    offset = [_number(f"offset:{s}") % size for s in shards]
    skip = [_number(f"skip:{s}") % (size - 1) + 1 for s in shards]
    slots, tried, filled = [-1] * size, [0] * len(shards), 0
    while filled < size and shards:
        for i in range(len(shards)):
            at = (offset[i] + tried[i] * skip[i]) % size
            while slots[at] >= 0:
                tried[i] += 1
                at = (offset[i] + tried[i] * skip[i]) % size
            slots[at] = i
            tried[i] += 1
            filled += 1
            if filled == size:
                break
    return slots


def slot_of(key: Column, size: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(docs: DataFrame, shards: int = SHARDS, size: int = SIZE, key: str = "doc_id") -> DataFrame:
    """docs with slot and shard."""
    filled = ",".join(map(str, lookup([f"shard-{i}" for i in range(shards)], size)))
    lookup_table = docs.sparkSession.range(1).select(F.posexplode(F.split(F.lit(filled), ",")).alias("slot", "shard")).select("slot", F.col("shard").cast("int").alias("shard"))
    by = F.coalesce(F.col(key).cast("string"), F.col("text") if "text" in docs.columns else F.lit(None), F.lit(""))
    kept = docs.drop("slot", "shard")
    return kept.withColumn("slot", slot_of(by, size)).join(F.broadcast(lookup_table), "slot").select(*(F.col(f"`{c}`") for c in kept.columns), "slot", "shard")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


OP2_SQL = f"""
WITH RECURSIVE s AS (
  SELECT i::INT AS i, (('0x' || substr(md5('offset:shard-' || i), 1, 15))::BIGINT % {SIZE})::INT AS o,
    (('0x' || substr(md5('skip:shard-' || i), 1, 15))::BIGINT % {SIZE - 1} + 1)::INT AS k
  FROM range({SHARDS}) t(i)),
perm AS (SELECT i, list((o + j * k) % {SIZE} ORDER BY j) AS slots FROM s, range({SIZE}) t(j) GROUP BY i),
turns AS (
  SELECT 0 AS n, []::BIGINT[] AS taken, -1 AS shard, -1::BIGINT AS slot
  UNION ALL
  SELECT n + 1, list_append(taken, c), i, c FROM (
    SELECT n, taken, p.i, list_filter(p.slots, lambda x: NOT list_contains(taken, x))[1] AS c
    FROM turns JOIN perm p ON p.i = n % {SHARDS} WHERE n < {SIZE})),
d AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT % {SIZE})::INT AS slot FROM documents)
SELECT d.doc_id, d.slot, turns.shard FROM d JOIN turns ON turns.slot = d.slot
"""
