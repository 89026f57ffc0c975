"""Sharding by jump consistent hashing.

A row's shard depends only on its key and the number of shards: no ring table
is kept, and with one more shard a row either stays or moves to the new shard.
Slots number the rows of a shard without gaps, by a two-level prefix sum over
ranges of keys, so no task numbers a whole shard.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from voxelframe.llm.common import crc_text, shuffle_parts, staged

# fixed values: multiplier of the published jump hash; mixing constants of SplitMix64
JUMP = 2862933555777941757
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mixed(keys):
    """64-bit keys spread over all bits (one-to-one)."""
    import numpy as np
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64(MIX[0])
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def jump(keys, shards: int):
    """Jump consistent hash of an array of unsigned 64-bit keys."""
    import numpy as np
    key = keys.copy()
    b = np.zeros(len(key), np.int64)
    j = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        b[live] = j[live]
        with np.errstate(over="ignore"):
            key[live] = key[live] * np.uint64(JUMP) + np.uint64(1)
        step = (2.0 ** 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        j[live] = ((b[live] + 1).astype(np.float64) * step).astype(np.int64)
        live = live[j[live] < shards]
    return b.astype(np.int32)


def _place(batches, shards: int):
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    seen = np.zeros(shards, np.int64)
    for b in batches:
        ids = b.column(0)
        key = mixed(ids.fill_null(0).to_numpy(zero_copy_only=False))
        shard = jump(key, shards)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(shard), np.int64)
        counts = np.bincount(shard, minlength=shards)
        starts = np.cumsum(counts) - counts
        place[order] = np.arange(len(shard)) - starts[shard[order]] + seen[shard[order]]
        seen += counts
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(shard), pa.array(jump(key, shards + 1)), pa.array(np.full(len(shard), part, np.int32)),
             pa.array(place)], names=[*b.schema.names, "shard", "grown_shard", "part", "place"])


def assign_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus one (null text: one), text_crc32 its
    unsigned CRC-32 (null: that of the empty text), shard the jump hash of the
    id over ``shards``, grown_shard that over one more.  slot numbers a
    shard's rows from 0 in order of id, checksum and size; rows that are equal
    in all three take consecutive slots.  Null ids share the shard of id 0 and
    come first.  Other columns are not read."""
    if shards < 1:
        raise ValueError("at least one shard")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("bigint").alias("size"),
                       crc_text(F.col(text_col)).alias("text_crc32"))
    order = ["doc_id", "text_crc32", "size"]
    placed = (rows.repartitionByRange(shuffle_parts(docs.sparkSession), *order).sortWithinPartitions(*order)
              .mapInArrow(partial(_place, shards=shards), "doc_id bigint, size bigint, text_crc32 bigint, shard int, "
                                                          "grown_shard int, part int, place bigint"))
    placed = staged(placed, "placed")
    # at most one row per partition and shard
    first = placed.groupBy("shard", "part").count().withColumn(
        "first", F.sum("count").over(W.partitionBy("shard").orderBy("part")) - F.col("count")).drop("count")
    return (placed.join(first, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("place")).alias("slot"), "grown_shard"))
