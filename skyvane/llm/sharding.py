"""Sharding by jump consistent hashing.

A row's shard follows from its stable key and the shard count alone: no ring
table, no lookup. Appending a shard moves only the rows that land in the new one,
about 1/(n+1) of all. Slots number a shard's rows without gaps in key order; they come
from one range-partitioned pass with small per-range totals, so no task holds a shard.

Defined cases: a null key hashes as a fixed sentinel; null text has size 1 and
the crc of no bytes; repeated keys share a shard and take slots next to each other;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, read, with_offsets
from skyvane.llm._text import U64, mix

NULL_KEY = -0x6A09E667F3BCC909


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash (Lamping and Veach) of mixed 64-bit keys, vectorised."""
    k = mix(keys.astype(np.int64).view(U64))
    b = np.full(len(k), -1, np.int64)
    j = np.zeros(len(k), np.int64)
    live = np.arange(len(k))
    while len(live):
        b[live] = j[live]
        k[live] = k[live] * U64(2862933555777941757) + U64(1)
        step = ((b[live] + 1) * (float(1 << 31) / ((k[live] >> U64(33)) + U64(1)).astype(np.float64))).astype(np.int64)
        j[live] = step
        live = live[step < shards]
    return b


def assign(docs: DataFrame, shards: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (with one shard more)."""
    begin(docs.sparkSession)
    base = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("text_crc32"))

    def place(it):
        for b in it:
            k = b.column(0).fill_null(NULL_KEY).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(jump_hash(k, shards), pa.int32()), pa.array(jump_hash(k, shards + 1), pa.int32()),
                 pa.array(np.ones(len(k), np.int64))],
                names=["doc_id", "size", "text_crc32", "shard", "grown_shard", "one"])

    placed = base.mapInArrow(place, "doc_id long, size long, text_crc32 long, shard int, grown_shard int, one long")
    out = with_offsets(placed, ["shard", "doc_id", "text_crc32"], {"slot": "one"}, "shards", group="shard")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(read(spark, sf_dir, "documents"), 16)
