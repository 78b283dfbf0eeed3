"""The online model as keyed streaming state (STR11, STA2-STA5).

Model state per (asset, sensor, phase) is one small record (phase-seen flag,
mean and previous value per feature), kept in the state store (RocksDB), so
state grows with the number of keys, never with the number of readings.
Within a micro-batch a key's rows are folded in (ts, kind, event_id) order
with the same step the batch fold uses, so batch and stream agree.

Two operators:

* :func:`score_stream_sharded`: ``transformWithStateInPandas``
  keyed by (sensor, phase, hash shard of asset). One handler call folds all
  assets of a shard at once, vectorised across assets; the shard's state is
  a set of parallel arrays. Python calls per batch = touched shards.
* :func:`score_stream_ordered`: the sharded operator in event-time mode; rows
  wait in keyed list state until the watermark passes them, so the order is
  exact across micro-batches.

Sharding trades a Python call per key for rewriting a shard's arrays when it is
touched, so the shard count should keep a shard's state to a few MB. Messages
may name no asset: they are then one key per sensor and phase.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .. import schema as S
from ..session import prepare
from ..operators import fold as FD
from ..operators import model as M

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def kept_columns(rows: DataFrame) -> list[str]:
    """Input columns that the scored rows keep: what alert and scored messages carry."""
    return [*M.MODEL_KEYS, "event_id", "kind", *[c for c in ("timestamp", "payload") if c in rows.columns]]


def output_schema(rows: DataFrame, features: Sequence[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    cols = [f"{c} {types[c]}" for c in kept_columns(rows)]
    cols += ["score double", "is_anomaly boolean"] + [f"mean_{f} double" for f in features]
    return ", ".join(cols)


# Stands for "no asset" inside the state; never leaves this module.
NO_ASSET = -(1 << 63)


def keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("asset_id", F.coalesce(F.col("asset_id"), F.lit(NO_ASSET)))


def unkeyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("asset_id", F.when(F.col("asset_id") != NO_ASSET, F.col("asset_id")))


def row_weights(rows: DataFrame, features: Sequence[str], weights: dict[str, float] | None) -> dict[str, float] | None:
    """The default weights, unless the rows carry their own (``w_<feature>``)."""
    if weights is None and f"w_{list(features)[0]}" not in rows.columns:
        return S.all_weights()
    return weights


SHARD_KEYS = ("sensor", "phase", "_shard")
ASSETS_PER_SHARD = 5000


def fleet_shards(n_assets: int, per_shard: int = ASSETS_PER_SHARD) -> int:
    """Shards per (sensor, phase) for a fleet: each keyed-state call costs a
    Python round trip, each touched shard rewrites its arrays; ~5,000 assets
    per shard balances the two."""
    return max(1, -(-n_assets // per_shard))


# Scored rows that leave a handler call at a time.
OUT_ROWS = 10_000


def compact(part: pd.DataFrame) -> pd.DataFrame:
    """Payload texts as Arrow strings: a key's rows wait for each other, and Python strings take twice the memory."""
    if "payload" not in part.columns:
        return part
    return part.assign(payload=part["payload"].astype(pd.ArrowDtype(pa.large_string())))


class ShardProcessor(StatefulProcessor):
    """Folds every asset of one (sensor, phase, shard) key in a micro-batch."""

    def __init__(self, features: Sequence[str], weights: dict[str, float] | None, alpha: float = 0.2,
                 keep: Sequence[str] = (*M.MODEL_KEYS, "event_id", "kind")):
        self.fold = M.model_step(list(features), weights, alpha)
        self.fields = list(self.fold.state)
        self.keep = list(keep)

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = StructType([StructField("assets", ArrayType(LongType()), True)]
                            + [StructField(f, ArrayType(DoubleType()), True) for f in self.fields])
        self.state = handle.getValueState("shard", schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat([compact(part) for part in rows], ignore_index=True)
        order = pdf[["asset_id", *M.MODEL_ORDER]].sort_values(["asset_id", *M.MODEL_ORDER], kind="stable").index.to_numpy()
        # only what the fold reads is sorted as a whole; the rows go out in slices
        told = pdf[list(dict.fromkeys(["asset_id", *self.fold.inputs]))].take(order).reset_index(drop=True)
        _, starts, _ = FD.key_groups(told, ["asset_id"])
        batch_assets = told["asset_id"].to_numpy()[starts].astype(np.int64)
        saved = self.state.get()
        init = {f: np.full(len(starts), v, dtype=float) for f, v in self.fold.state.items()}
        if saved is not None:
            known = np.asarray(saved[0], dtype=np.int64)
            stored = {f: np.asarray(saved[i + 1], dtype=float) for i, f in enumerate(self.fields)}
            loc = pd.Index(known).get_indexer(batch_assets)
            hit = loc >= 0
            for f in self.fields:
                init[f][hit] = stored[f][loc[hit]]
        else:
            known = np.empty(0, dtype=np.int64)
            stored = {f: np.empty(0) for f in self.fields}
            loc = np.full(len(starts), -1)
            hit = loc >= 0
        outs, final, _ = FD.fold_frame(told, ["asset_id"], self.fold, init)
        for f in self.fields:
            stored[f] = stored[f].copy()
            stored[f][loc[hit]] = final[f][hit]
            stored[f] = np.concatenate([stored[f], final[f][~hit]])
        known = np.concatenate([known, batch_assets[~hit]])
        self.state.update((known.tolist(), *[stored[f].tolist() for f in self.fields]))
        kept = pdf[self.keep]
        del pdf, told
        for i in range(0, len(order), OUT_ROWS):
            part = slice(i, i + OUT_ROWS)
            yield FD.output_frame(kept.take(order[part]), self.keep, self.fold, {o: v[part] for o, v in outs.items()})

    def close(self) -> None:
        pass


def score_stream_sharded(rows: DataFrame, features: Sequence[str] = S.EVENT_FEATURES,
                         weights: dict[str, float] | None = None, alpha: float = 0.2,
                         shards: int = 8) -> DataFrame:
    """Keyed model state sharded by (sensor, phase, hash(asset) mod shards)."""
    spark = prepare(rows.sparkSession)
    if rows.isStreaming and spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    weights = row_weights(rows, features, weights)
    sharded = keyed(rows).withColumn("_shard", F.pmod(F.xxhash64("asset_id"), F.lit(shards)))
    return unkeyed(sharded.groupBy(*SHARD_KEYS).transformWithStateInPandas(
        statefulProcessor=ShardProcessor(features, weights, alpha, kept_columns(rows)),
        outputStructType=output_schema(rows, features), outputMode="Append", timeMode="None"))


class OrderedShardProcessor(ShardProcessor):
    """:class:`ShardProcessor` that buffers rows until the event-time
    watermark passes them, then folds them in (ts, kind, event_id) order: the
    result no longer depends on how rows are split into micro-batches (rows
    arriving behind the watermark are dropped by the watermark)."""

    def __init__(self, features, weights, alpha, row_schema: StructType, keep: Sequence[str]):
        super().__init__(features, weights, alpha, keep)
        self.row_schema = row_schema
        self.cols = [f.name for f in row_schema.fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.pending = handle.getListState("pending", self.row_schema)

    def _drain(self, new: pd.DataFrame | None, watermark_ms: int) -> Iterator[pd.DataFrame]:
        old = (pd.DataFrame(list(self.pending.get()), columns=self.cols)
               if self.pending.exists() else pd.DataFrame(columns=self.cols))
        rows = old if new is None else pd.concat([old, new[self.cols]], ignore_index=True)
        if len(rows) == 0:
            return
        ts_ms = pd.to_datetime(rows["ts"]).astype("int64") // 1_000_000
        ready = rows[ts_ms <= watermark_ms]
        wait = rows[ts_ms > watermark_ms]
        self.pending.clear()
        if len(wait):
            self.pending.put([tuple(r) for r in wait.itertuples(index=False, name=None)])
            self.handle.registerTimer(int(ts_ms[ts_ms > watermark_ms].min()))
        if len(ready):
            yield from super().handleInputRows(None, iter([ready.reset_index(drop=True)]), None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._drain(pd.concat(list(rows), ignore_index=True),
                               timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._drain(None, timerValues.getCurrentWatermarkInMs())


def score_stream_ordered(rows: DataFrame, delay: str = "2 seconds",
                         features: Sequence[str] = S.EVENT_FEATURES,
                         weights: dict[str, float] | None = None, alpha: float = 0.2,
                         shards: int = 8) -> DataFrame:
    """Event-time ordered variant of :func:`score_stream_sharded`: rows are
    held in keyed list state until the watermark (``delay`` behind the
    latest ``ts``) passes them, then folded in order. Rows not yet passed by
    the watermark when the stream stops stay buffered."""
    spark = prepare(rows.sparkSession)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    weights = row_weights(rows, features, weights)
    sharded = (keyed(rows).withColumn("ts", F.col("ts").cast("timestamp"))
                   .withWatermark("ts", delay)
                   .withColumn("_shard", F.pmod(F.xxhash64("asset_id"), F.lit(shards))))
    row_schema = StructType([f for f in sharded.schema.fields if f.name != "_shard"])
    proc = OrderedShardProcessor(features, weights, alpha, row_schema, kept_columns(rows))
    return unkeyed(sharded.groupBy(*SHARD_KEYS).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=output_schema(rows, features),
        outputMode="Append", timeMode="EventTime"))
