"""Structured Streaming jobs (STR1-STR12, SNK1-SNK6).

Messages are read and decoded once, into a table whose file log commits each
micro-batch as a whole (:func:`decoded_log`); every other query reads that table, so none ever
sees half a batch and each can fail and be restarted alone. Each query has its own
checkpoint under the shared checkpoint folder; files written from ``foreachBatch``
are keyed by the batch id, so a replayed batch overwrites instead of duplicating (a replay to
Kafka sends its messages again). Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import feeds as FE
from .. import schema as S
from ..functions import decode as D
from ..operators import aggregations as A
from ..operators import lookups as L
from ..operators import model as M
from ..session import prepare, scratch_path
from . import model_state as MS
from . import ordered_scores as OS
from . import versions as V


def decoded(records: DataFrame, key_map: dict[str, str] | None = None,
            spec: list[tuple[str, list[str]]] | None = None) -> tuple[DataFrame, DataFrame]:
    """PRJ1-PRJ10 + FIL8 on a stream: (telemetry, dead letters)."""
    return D.split_dead_letters(D.decode_stream(records, key_map, spec))


def _writer(df: DataFrame, name: str, checkpoint: str, mode: str, trigger: dict | None):
    w = (df.writeStream.queryName(name).outputMode(mode)
           .option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"}))


def monitoring_rows(telemetry: DataFrame, duration: str = "5 seconds",
                    watermark: str = "2 seconds", keys: Sequence[str] = ("sensor", "phase"),
                    features: Sequence[str] = S.EVENT_FEATURES) -> DataFrame:
    """STR1 + STR2 + AGG2: watermarked tumbling windows. The watermark bounds
    the state: a window's state is dropped once the watermark passes its end,
    and rows older than the watermark are dropped (and counted)."""
    return A.window_rows(telemetry.withWatermark("event_time", watermark), duration,
                         keys=keys, features=features, time_col="event_time")


def training_rows(telemetry: DataFrame, duration: str = "1 second",
                  watermark: str = "2 seconds") -> DataFrame:
    """AGG1 on a stream: wide one-row-per-window training set, with a date column."""
    w = A.wide_window(telemetry.withWatermark("event_time", watermark), duration)
    return w.withColumn("date", F.to_date("timestamp"))


def start_parquet(df: DataFrame, path: str, checkpoint: str, name: str,
                  mode: str = "append", trigger: dict | None = None,
                  partition_by: Sequence[str] = ()) -> StreamingQuery:
    """SNK4 (+STR3/STR8): parquet sink with checkpoint."""
    w = _writer(df, name, checkpoint, mode, trigger).format("parquet").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start()


def start_console(df: DataFrame, checkpoint: str, name: str = "console",
                  mode: str = "update", trigger: dict | None = None) -> StreamingQuery:
    """SNK5: debug console sink (tests use parquet or noop)."""
    return _writer(df, name, checkpoint, mode, trigger).format("console") \
        .option("truncate", False).start()


def to_messages(df: DataFrame) -> DataFrame:
    """SNK1/SNK2 shape: one JSON text ``value`` per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_messages(df: DataFrame, target: str, fmt: str = "text", **options: str) -> None:
    """Write JSON messages to a bus (``fmt="kafka"`` with ``topic`` and
    ``kafka.bootstrap.servers``) or to files (``text``)."""
    out = to_messages(df)
    if fmt == "kafka":
        w = out.write.format("kafka").option("topic", target)
        for k, v in options.items():
            w = w.option(k, v)
        w.save()
    else:
        out.write.mode("overwrite").text(target)


#: Topics of the original bus; other names can be given to :func:`start_feed`.
TOPICS = {"scored": "sensor-data", "alerts": "alerts", "updates": "model-updates"}


def update_batch_writer(target: str, allowed: DataFrame, sensors: DataFrame,
                        features: Sequence[str] = S.EVENT_FEATURES,
                        fmt: str = "text", topic: str = TOPICS["updates"], **options: str) -> Callable[[DataFrame, int], None]:
    """SNK3 (+STR6, PRJ12-14, FIL3, FIL5): per micro-batch, build update
    messages from all window rows of sensors that have a model and write them
    as JSON, to a folder below ``target`` or to ``topic``. In update mode a window is sent
    again whenever it changes; ``version`` (the batch) tells the latest."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        msgs = L.update_messages(L.known_sensors(batch, sensors), allowed, features)
        msgs = msgs.withColumn("version", F.lit(epoch_id).cast("long"))
        write_messages(msgs, topic if fmt == "kafka" else f"{target}/batch={epoch_id}", fmt, **options)
    return run


def scored_messages(scored: DataFrame) -> DataFrame:
    """SNK1: the scored envelope of each reading."""
    return scored.select("timestamp", "sensor", F.col("payload").alias("value"), F.col("score").alias("prediction"),
                         "is_anomaly", "phase")


def alert_rows(scored: DataFrame) -> DataFrame:
    """SNK2: the alert of each anomalous reading, with its payload text."""
    return scored.filter("is_anomaly").select(
        "timestamp", "sensor", F.col("score").alias("prediction"), F.col("payload").alias("value"),
        F.concat(F.lit("Anomaly detected in "), F.col("sensor")).alias("message"))


def fan_out_writer(base: str, fmt: str = "text", topics: dict[str, str] | None = None,
                   **options: str) -> Callable[[DataFrame, int], None]:
    """SNK1 + SNK2 in one ``foreachBatch``: the scored batch is written once;
    the alerts are read back from that written table (durable, so the model
    never runs twice and a lost executor only re-reads files). Rows that carry
    their payload also go out as JSON messages (to the topics with ``fmt="kafka"``)."""
    topics = {**TOPICS, **(topics or {})}

    def run(batch: DataFrame, epoch_id: int) -> None:
        scored_path = f"{base}/scored/batch={epoch_id}"
        batch.write.mode("overwrite").parquet(scored_path)
        scored = batch.sparkSession.read.parquet(scored_path)
        alerts = scored.filter(F.col("kind") == M.READING).filter(F.col("is_anomaly")).select(
            "event_id", "asset_id", "sensor", "phase", "score",
            F.concat(F.lit("Anomaly detected in "), F.col("sensor")).alias("message"))
        alerts.write.mode("overwrite").parquet(f"{base}/alerts/batch={epoch_id}")
        if "payload" in scored.columns:
            readings = scored.filter(F.col("kind") == M.READING)
            for what, folder, rows in (("scored", "scored_messages", scored_messages(readings)),
                                       ("alerts", "alert_messages", alert_rows(readings))):
                write_messages(rows, topics[what] if fmt == "kafka" else f"{base}/{folder}/batch={epoch_id}", fmt, **options)
    return run


def with_effective_ts(updates: DataFrame, window: str) -> DataFrame:
    """STA5 input: an update message applies at the end of the window it
    summarises (its ``timestamp`` is the window start, as text)."""
    return updates.withColumn(
        "effective_ts", F.to_timestamp("timestamp") + F.expr(f"INTERVAL {window}"))


def scored_stream(telemetry: DataFrame, updates: DataFrame | None = None,
                  features: Sequence[str] = S.EVENT_FEATURES, shards: int = 8,
                  order_delay: str | None = None) -> DataFrame:
    """STA2-STA5 on a stream: readings (and optional update messages with
    ``effective_ts``) folded per (asset, sensor, phase) in keyed state.

    ``order_delay`` (e.g. ``"1 minute"``) buffers rows until the watermark
    passes them, for an order that does not depend on arrival.

    ``shards``: hash shards of the asset id per (sensor, phase). A touched
    shard rewrites its state arrays, so size it to the fleet: about one shard
    per 5,000 assets keeps each shard's state near 200 kB.
    """
    rows = M.model_input(telemetry.withColumn("ts", F.col("event_time")), features)
    if updates is not None:
        rows = rows.unionByName(M.update_input(updates, features))
    if order_delay:
        # exact event order across micro-batches, emitted after the delay
        return MS.score_stream_ordered(rows, order_delay, features, shards=shards)
    return MS.score_stream_sharded(rows, features, shards=shards)


def udf_scorer(df: DataFrame, scorer: Callable[[pd.DataFrame], pd.Series],
               inputs: Sequence[str], name: str = "udf_score") -> DataFrame:
    """SNK6 / UDF1: a user scoring function on Arrow batches (``mapInPandas``),
    replacing a per-row call to a model service."""
    prepare(df.sparkSession)
    cols = list(dict.fromkeys([*df.columns]))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {types[c]}" for c in cols] + [f"`{name}` double"])

    def run(it):
        for pdf in it:
            out = pdf[cols].copy()
            out[name] = scorer(pdf[list(inputs)]).astype(float).to_numpy()
            yield out
    return df.mapInPandas(run, schema)


def run_available(queries: Sequence[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait for ``availableNow`` queries; re-raise the first failure (STR9)."""
    for q in queries:
        q.awaitTermination(timeout_s)
        if q.exception() is not None:
            raise q.exception()


def stream_paths(spark: SparkSession, kind: str) -> dict[str, str]:
    base = scratch_path(spark, kind)
    return {"base": base, "input": f"{base}/input", "out": f"{base}/out", "ckpt": f"{base}/ckpt"}


def upsert_writer(base: str) -> Callable[[DataFrame, int], None]:
    """STR4 consumer side: update mode re-emits changed windows each trigger;
    each batch is stored under its id so readers can keep the latest version."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/batch={epoch_id}")
    return run


def latest_versions(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """Latest emitted version of each window key across update-mode batches."""
    rows = spark.read.parquet(base)
    cols = [c for c in rows.columns if c != "batch"]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("batch")).alias("r"))
    return latest.select("r.*")


def scored_feed(tel: DataFrame, feed: FE.Feed, updates: DataFrame | None = None, shards: int = 8) -> DataFrame:
    """The model over a feed's telemetry as keyed state, in arrival order: readings and, from ``updates`` (messages with
    ``effective_ts``), the feedback blend. Scored rows keep their time and payload."""
    return MS.score_stream_sharded(feed_rows(tel, feed, updates), feed.slots, shards=shards)


def feed_rows(tel: DataFrame, feed: FE.Feed, updates: DataFrame | None = None) -> DataFrame:
    """The rows that the model folds: readings and, if given, update messages."""
    rows = FE.model_rows(tel, feed, extra=("timestamp", "payload"))
    if updates is not None:
        rows = rows.unionByName(FE.update_rows(updates, feed), allowMissingColumns=True)
    return rows


def decoded_log(decoded_rows: DataFrame, base: str, trigger: dict | None) -> tuple[StreamingQuery, DataFrame, DataFrame]:
    """STR9: read and decode the source once. The file sink's log commits a micro-batch's files together, and its
    readers go by that log: a batch that failed half-way is not seen, and its replay is seen once.

    Returns the started query and, as streams over its table, (telemetry, dead letters). With an ``availableNow``
    trigger the decode is awaited first, so the readers find everything.
    """
    spark = decoded_rows.sparkSession
    path = f"{base}/decoded"
    V.make_folder(spark, path)
    rows = decoded_rows.withColumn("dead", ~D.valid_envelope(decoded_rows))
    query = start_parquet(rows, path, f"{base}/ckpt/decode", "decode", "append", trigger, ("dead",))
    if trigger and trigger.get("availableNow"):
        run_available([query])
    table = spark.readStream.schema(rows.schema).parquet(path)
    return query, table.filter(~F.col("dead")).drop("json_str", "dead"), table.filter("dead").select("json_str")


def start_feed(spark: SparkSession, records: DataFrame, base: str, feed: FE.Feed,
               trigger: dict | None = None, monitoring: str = "5 seconds", training: str = "1 second",
               watermark: str = "2 seconds", updates: DataFrame | None = None, model_shards: int = 8,
               order_delay: str | None = None, fmt: str = "text", topics: dict[str, str] | None = None,
               update_mode: str = "update", console: bool = False, **options: str) -> list[StreamingQuery]:
    """The whole job on a feed's messages: one decode (STR9), then monitoring rows and model updates, the training set,
    scored and alert messages, dead letters. ``updates``: the stream of model-update messages to feed back
    (:func:`with_effective_ts` of :func:`skyvane.sources.files.update_stream`). ``update_mode="append"``
    sends each window once, when it is closed (``console`` prints them too, SNK5), so a model fed by them blends it once. With ``order_delay`` readings are
    scored in event order (:func:`skyvane.streaming.ordered_scores.ordered_score_writer`), else in arrival order."""
    decode, tel, dead = decoded_log(FE.decode(records, feed), base, trigger)
    topics = {**TOPICS, **(topics or {})}
    allowed = spark.createDataFrame([(s, f) for s, fs in sorted(feed.update_features.items()) for f in fs],
                                    "sensor string, feature string")
    sensors = spark.createDataFrame([(s,) for s in sorted(feed.thresholds)], "sensor string")
    mon = monitoring_rows(FE.monitoring_input(tel, feed), monitoring, watermark, features=feed.monitoring)
    train = FE.training_row(tel.withWatermark("event_time", watermark), feed, training).withColumn("date", F.to_date("timestamp"))
    sink = fan_out_writer(f"{base}/scored", fmt, topics, **options)
    if order_delay:
        # event order, and sensors whose rows are more than one task's work
        scoring, score_sink = feed_rows(tel, feed, updates), OS.ordered_score_writer(f"{base}/model", feed.slots, order_delay, sink)
    else:
        scoring, score_sink = scored_feed(tel, feed, updates, model_shards), sink
    debug = [start_console(mon, f"{base}/ckpt/console", "monitoring_console", trigger=trigger)] if console else []
    return [
        decode, *debug,
        _writer(mon, "model_updates", f"{base}/ckpt/updates", update_mode, trigger).foreachBatch(
            update_batch_writer(f"{base}/updates", allowed, sensors, feed.monitoring, fmt, topics["updates"], **options)).start(),
        start_parquet(train, f"{base}/training", f"{base}/ckpt/training", "training", "append", trigger, ("date",)),
        _writer(scoring, "scoring", f"{base}/ckpt/scoring", "append", trigger).foreachBatch(score_sink).start(),
        start_parquet(dead, f"{base}/dead_letters", f"{base}/ckpt/dead", "dead_letters", "append", trigger),
    ]


def start_pipeline(spark: SparkSession, records: DataFrame, base: str,
                   trigger: dict | None = None, monitoring: str = "5 seconds",
                   training: str = "1 second", watermark: str = "2 seconds",
                   model_shards: int = 8,
                   order_delay: str | None = None) -> list[StreamingQuery]:
    """The whole job on the derived feed's messages (:func:`start_feed` serves any other feed): one decode (STR9),
    monitoring rows (update mode -> model-update messages), the training set
    (append -> parquet by date), scored readings with alerts, and dead letters.
    Every query has its own checkpoint; returns the started queries (wait with
    ``spark.streams.awaitAnyTermination()`` or :func:`run_available`)."""
    decode, tel, dead = decoded_log(D.decode_stream(records), base, trigger)
    mon = monitoring_rows(tel, monitoring, watermark)
    sink = fan_out_writer(f"{base}/scored")
    if order_delay:
        scoring = M.model_input(tel.withColumn("ts", F.col("event_time")))
        score_sink = OS.ordered_score_writer(f"{base}/model", S.EVENT_FEATURES, order_delay, sink)
    else:
        scoring, score_sink = scored_stream(tel, shards=model_shards), sink
    return [
        decode,
        _writer(mon, "model_updates", f"{base}/ckpt/updates", "update", trigger)
        .foreachBatch(update_batch_writer(f"{base}/updates", S.update_feature_table(spark), S.sensor_table(spark))).start(),
        start_parquet(training_rows(tel, training, watermark), f"{base}/training",
                      f"{base}/ckpt/training", "training", "append", trigger, ("date",)),
        _writer(scoring, "scoring", f"{base}/ckpt/scoring", "append", trigger).foreachBatch(score_sink).start(),
        start_parquet(dead, f"{base}/dead_letters", f"{base}/ckpt/dead", "dead_letters", "append", trigger),
    ]


# --------------------------------------------------------------------------
# Side outputs that need one number or one row per sensor between batches
# (:mod:`skyvane.streaming.versions`).
# --------------------------------------------------------------------------
def late_rows_writer(base: str, duration: str, watermark: str, time_col: str = "event_time") -> Callable[[DataFrame, int], None]:
    """STR10: keep the rows that the windows of ``duration`` drop as late.

    The rule is Spark's own: a row is late if its window ends at or before the watermark, which is the latest time
    of all earlier batches (in whole milliseconds) less ``watermark``. Late rows go to ``late``;
    the latest time is one row per batch in ``clock``.
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        clock = f"{base}/clock"
        before = V.before(spark, clock, epoch_id, "latest_ms long").agg(F.max("latest_ms").alias("latest_ms"))
        seen = batch.agg(F.max(F.unix_millis(time_col)).alias("latest_ms"))
        before.unionByName(seen).agg(F.max("latest_ms").alias("latest_ms")).write.mode("overwrite").parquet(f"{clock}/batch={epoch_id}")
        V.forget(spark, clock, epoch_id)
        passed = F.timestamp_millis("latest_ms") - F.expr(f"INTERVAL {watermark}")
        ends = batch.withColumn("_end", F.window(time_col, duration)["end"])
        late = ends.join(F.broadcast(before), F.col("_end") <= passed)      # one row
        late.drop("latest_ms", "_end").write.mode("overwrite").parquet(f"{base}/late/batch={epoch_id}")
    return run


def silence_writer(base: str, expected: DataFrame, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """AGG8 on a stream: input are the closed ticks of :func:`closed_ticks`. ``silent/batch=N`` gets
    the stretches without a tick that batch N's ticks end, ``open/batch=N`` those that still last at its latest tick;
    expected sequences that never reported are open from the first tick on. State: one row per sequence, its
    last tick, and the first and last tick of the feed."""
    from ..operators import timeline as TL
    keys = list(keys)
    types = {f.name: f.dataType.simpleString() for f in expected.schema.fields}
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", tick long, first_tick long, last_tick long"

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        ticks_path = f"{base}/ticks/batch={epoch_id}"
        batch.select(*keys, F.col("tick").cast("long").alias("tick")).distinct().write.mode("overwrite").parquet(ticks_path)
        new = spark.read.parquet(ticks_path)
        old = V.before(spark, f"{base}/state", epoch_id, schema)
        span = old.agg(F.min("first_tick").alias("a"), F.max("last_tick").alias("b")).unionByName(
            new.agg(F.min("tick").alias("a"), F.max("tick").alias("b"))).agg(F.min("a"), F.max("b")).first()      # two numbers
        first, last = (0, -1) if span[0] is None else (span[0], span[1])
        wanted = expected.select(*keys).distinct()
        known = old.select(*keys, "tick").filter("tick is not null").join(wanted, keys, "left_semi")
        new = new.join(wanted, keys, "left_semi")
        before = wanted.join(known, keys, "left").select(*keys, F.coalesce("tick", F.lit(first) - 1).cast("long").alias("tick"))
        TL.between(before.unionByName(new), keys).write.mode("overwrite").parquet(f"{base}/silent/batch={epoch_id}")
        reached = known.unionByName(new).groupBy(*keys).agg(F.max("tick").alias("tick"))
        state = wanted.join(reached, keys, "left").select(
            *keys, "tick", F.lit(first if last >= first else None).cast("long").alias("first_tick"),
            F.lit(last if last >= first else None).cast("long").alias("last_tick"))
        state.write.mode("overwrite").parquet(f"{base}/state/batch={epoch_id}")
        state = spark.read.parquet(f"{base}/state/batch={epoch_id}")
        V.forget(spark, f"{base}/state", epoch_id)
        at = F.coalesce(F.col("tick"), F.col("first_tick") - 1)
        state.filter(at < F.col("last_tick")).select(
            *keys, (at + 1).alias("from_tick"), F.col("last_tick").alias("to_tick"), (F.col("last_tick") - at).alias("n_missing")).write.mode("overwrite").parquet(f"{base}/open/batch={epoch_id}")
    return run


def closed_ticks(tel: DataFrame, duration: str, seconds: int, watermark: str, keys: Sequence[str]) -> DataFrame:
    """keys and ``tick`` of every tick that the watermark has passed and in which the sequence reported."""
    w = tel.withWatermark("event_time", watermark).groupBy(F.window("event_time", duration).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return w.select(*keys, F.floor(F.unix_seconds("w.start") / seconds).alias("tick"), "n")
