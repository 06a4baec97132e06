"""Shards by jump consistent hashing.

A stable key decides, with the number of shards, where a row goes; there is no
table of ring positions. When a shard is appended, a row stays or moves into the
new shard, and about one row in n + 1 moves.

Slots (gapless from 0 within a shard) come from the writing tasks' own counters
and a prefix sum over tasks, so no shard is ever sorted or gathered.

Defined results: a null key is the key 0; a null text has no bytes (size 1) and
CRC-32 0; rows with equal keys share a shard and have slots of their own; empty
table: no rows; negative keys are taken as unsigned 64-bit numbers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_batches, pandas_udf, partition_id, stored, with_rank

SHARDS = 8


def spread(keys: np.ndarray) -> np.ndarray:
    """Mix 64-bit keys, so that neighbouring ids do not stay neighbours."""
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard (0 to shards - 1) of each mixed 64-bit key, all keys jumping at once:
    a key's next shard is drawn from its own pseudo-random sequence until the
    draw lies beyond the last shard."""
    state = keys.astype(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = ahead[moving]
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[moving] = ((shard[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return shard


def shard_of(keys: pd.Series, shards: int) -> np.ndarray:
    return jump_hash(spread(keys.to_numpy(np.int64).view(np.uint64)), shards)


def assign_shards(docs: DataFrame, key: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row for each row of ``docs``: its key as ``doc_id``, ``size``,
    ``text_crc32``, ``shard``, ``slot`` and ``grown_shard`` (with one shard more)."""
    text = F.col(text_col).cast("string")
    own = F.col(key).cast("long")
    narrow = docs.select(
        F.coalesce(own, F.lit(0)).alias("doc_id"),
        own.isNull().alias("no_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )

    def deal(frames):
        part, seen = partition_id(), np.zeros(shards, np.int64)
        for frame in frames:
            shard = shard_of(frame["doc_id"], shards)
            number = np.zeros(len(shard), np.int64)
            for s in range(shards):
                mine = np.flatnonzero(shard == s)
                number[mine] = seen[s] + np.arange(len(mine))
                seen[s] += len(mine)
            yield frame.assign(shard=shard, grown_shard=shard_of(frame["doc_id"], shards + 1), part=part, number=number)

    schema = "doc_id long, no_id boolean, size long, text_crc32 long, shard int, grown_shard int, part long, number long"
    dealt = stored(map_batches(narrow, deal, schema), "sharded")
    ranked = with_rank(dealt, "shard", "part", "number", "slot")
    return ranked.withColumn("doc_id", F.when(~F.col("no_id"), F.col("doc_id"))).drop("part", "number", "no_id")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", shards: int = SHARDS) -> None:
    """Write ``docs`` into one folder for each shard (``shard=0`` and so on), each
    task writing its own files; no shard passes through one task."""

    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(shard_of(keys, shards), dtype="int32")

    docs.withColumn("shard", pandas_udf(shard, "int")(F.coalesce(F.col(key).cast("long"), F.lit(0)))).write.partitionBy("shard").parquet(path)
