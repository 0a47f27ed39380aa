"""Sharding by jump consistent hashing.

A stable key and the number of shards decide the shard: no ring, no table, no look at other rows. With one more shard a
row either stays or moves into the new one, and about 1/(n+1) of the rows move.

Slots number the rows of a shard without gaps. Each task counts its rows of each shard as it reads them; the counts (tasks x
shards, no texts) give each task's offset in each shard. No row is shuffled and no shard meets in one task.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import quoted, written

SHARDS = 16
#: The multiplier of the generator in the published algorithm; a fixed value.
STEP = np.uint64(2862933555777941757)


def key_hash(key: str | None) -> int:
    """64 bits of the key as text (the first of its MD5); a null key hashes as an empty text."""
    return int.from_bytes(hashlib.md5((key or "").encode()).digest()[:8], "big")


def jump(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit hash: the last jump that lands below the number of shards."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = hashes.astype(np.uint64)
    shard = np.zeros(len(state), dtype=np.int64)
    nxt = np.zeros(len(state), dtype=np.int64)
    going = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(going):
            shard[going] = nxt[going]
            state[going] = state[going] * STEP + np.uint64(1)
            draw = (state[going] >> np.uint64(33)).astype(np.float64) + 1
            nxt[going] = ((shard[going] + 1) * (float(1 << 31) / draw)).astype(np.int64)
            going = going[nxt[going] < shards]
    return shard


def sharded(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``.

    Size is the text's UTF-8 bytes (null: none) plus 1; the checksum of a null text is that of an empty one. Equal keys
    share a shard, each row with a slot of its own; null keys have one shard, too. Equal texts under different keys
    are placed apart: under this law only the key counts. Which row of a shard has which slot follows the input's order
    and is not part of the law. A key with a third of all rows makes its shard large, by definition of the law, but
    no task: rows are written where they are read.
    """
    narrow = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(key)).cast("string").alias("id"), F.col(quoted(text)).alias("text"))
    key_type = narrow.schema["key"].dataType.simpleString()

    def place(batches):
        part = TaskContext.get().partitionId()
        seen = np.zeros(shards, dtype=np.int64)
        for batch in batches:
            hashes = np.array([key_hash(k) for k in batch.column(1).to_pylist()], dtype=np.uint64)
            texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
            now, grown = jump(hashes, shards), jump(hashes, shards + 1)
            slot = np.zeros(len(now), dtype=np.int64)
            for s in np.unique(now):
                mine = np.flatnonzero(now == s)
                slot[mine] = seen[s] + np.arange(len(mine))
                seen[s] += len(mine)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(t) + 1 for t in texts], pa.int64()), pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                pa.array(now, pa.int32()), pa.array(grown, pa.int32()), pa.array(slot), pa.array([part] * len(now), pa.int32())],
                ["key", "size", "text_crc32", "shard", "grown_shard", "local", "part"])

    # written once: a repeated task must not see other counts than the offsets were made from
    placed = written(narrow.mapInArrow(place, f"key {key_type}, size bigint, text_crc32 bigint, shard int, grown_shard int, local bigint, part int"), "shards")
    counts = placed.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    offsets = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    out = placed.join(offsets, ["shard", "part"])
    return out.select(F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("local")).alias("slot"), "grown_shard")
