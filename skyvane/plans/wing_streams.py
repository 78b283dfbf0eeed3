"""Registered queries of the wing feed's stream side: feedback (SRC2, STA5), late rows (STR10), silence (AGG8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import feeds as FE
from .. import schema as S
from ..operators import lookups as L
from ..operators import model as M
from ..session import materialize, scratch_path
from ..sources import files as FS
from ..sources import telemetry as T
from ..streaming import ordered_scores as OS
from ..streaming import pipeline as P
from ..streaming import versions as V
from . import oracle as O
from .catalog import _model_out, _model_sql, fmt, r6, register
from .wing import (MODEL_ORDER, NAMES, _MONITOR_SQL, _READING_ROWS, _case, _run_feed, _scored_sql, UPDATED, EXPECTED, WING_CTE, messages)

# --------------------------------------------------------------------------
# Feedback: the updates that the job sent are read back into the model.
# --------------------------------------------------------------------------
_OWN = {f: at for f, at in EXPECTED.items()}


def _reports(sensor: str, position: int) -> bool:
    """Whether the sensor's updates carry the payload position."""
    names = [f for f, at in _OWN.items() if at == (sensor, position)]
    return any(f in UPDATED[sensor] or (f == "node_strain" and "strain" in UPDATED[sensor]) for f in names)


_UPDATE_ROWS = ("SELECT CAST(-1 AS BIGINT) AS event_id, t + INTERVAL 5 SECOND AS ts, CAST(NULL AS DOUBLE) AS \"timestamp\", sensor, phase, "
                "0 AS kind, CAST(0.0 AS DOUBLE) AS threshold, " + ", ".join(
                    _case({s: f"mx{o[i]}" for s, o in MODEL_ORDER.items() if i < len(o) and _reports(s, o[i])}, "CAST(NULL AS DOUBLE)")
                    + f" AS x_f{i}, CAST(1.0 AS DOUBLE) AS w_f{i}" for i in range(5))
                + " FROM (SELECT time_bucket(INTERVAL '5 seconds', ts) AS t, sensor, phase, bool_or(is_anomaly) AS an, "
                + ", ".join(f"max(b * {j + 1} + k) AS mx{j}" for j in range(5))
                + f" FROM w WHERE sensor IN ({', '.join(repr(n) for n in NAMES)}) GROUP BY ALL) WHERE NOT an")


@register("wing_feedback", _scored_sql(
    'SELECT round("timestamp", 6) AS "timestamp", sensor, phase, round(score, 6) AS score, anomaly AS is_anomaly FROM fold WHERE rn > 0 AND kind = 1',
    f"{_READING_ROWS} UNION ALL {_UPDATE_ROWS}"))
def wing_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2 + FIL4 + STA5: the update messages that the job sent, the last version of each window, streamed back into
    the model beside the decoded readings; scored messages of that second run."""
    out = _run_feed(spark, sf_dir)
    base = scratch_path(spark, "wing-feedback")
    sent = spark.read.text(f"{out}/updates").select(F.from_json("value", S.UPDATE_MESSAGE).alias("u")).select("u.*")
    latest = sent.groupBy("timestamp", "sensor", "phase").agg(F.max_by(F.struct(*sent.columns), "version").alias("u")).select("u.*")
    L.update_json(latest).write.text(f"{base}/updates")
    updates = P.with_effective_ts(L.learnable(FS.update_stream(spark, "text", f"{base}/updates")), "5 seconds")
    decoded = spark.read.parquet(f"{out}/decoded")
    tel = spark.readStream.schema(decoded.schema).parquet(f"{out}/decoded").filter(~F.col("dead")).drop("dead", "json_str")
    q = (P.scored_feed(tel, FE.WING, updates).writeStream.queryName("feedback").option("checkpointLocation", f"{base}/ckpt")
         .foreachBatch(P.fan_out_writer(f"{base}/out")).trigger(availableNow=True).start())
    P.run_available([q])
    m = spark.read.text(f"{base}/out/scored_messages").select(F.from_json(
        "value", "timestamp double, sensor string, prediction double, is_anomaly boolean, phase string").alias("m")).select("m.*")
    return m.select(r6("timestamp").alias("timestamp"), "sensor", "phase", r6("prediction").alias("score"), "is_anomaly")


# --------------------------------------------------------------------------
# Messages that arrive in parts, some of them one part late.
# --------------------------------------------------------------------------
def _arrivals(spark: SparkSession, sf_dir: str, kind: str, parts: int, part, start) -> str:
    """Let the messages arrive part by part; ``start(records, base)`` runs the stream over what is new."""
    base = scratch_path(spark, kind)
    messages(spark, sf_dir, more={"part": part}, keep=["part"], spread=True).write.partitionBy("part").text(f"{base}/parts")
    V.make_folder(spark, f"{base}/in")
    for i in range(parts):
        some = spark.read.schema("value string, part int").text(f"{base}/parts").filter(F.col("part") == i)
        some.select("value").write.mode("append").text(f"{base}/in")
        P.run_available([start(FS.telemetry_stream(spark, "text", f"{base}/in"), base)])
    return base


_PART = "CAST(least((day(ts) - 1) // 8, 3) AS BIGINT)"
_LATE_SQL = f"""WITH {WING_CTE},
a AS (SELECT *, {_PART} + CASE WHEN event_id % 37 = 0 THEN 1 ELSE 0 END AS part FROM w),
m AS (SELECT part, max(epoch_ms(ts)) AS latest FROM a GROUP BY part),
c AS (SELECT DISTINCT a.part, (SELECT max(latest) FROM m WHERE m.part < a.part) - 2000 AS passed FROM a)
SELECT round("timestamp", 6) AS "timestamp", sensor, phase FROM a JOIN c USING (part)
WHERE epoch_ms(time_bucket(INTERVAL '1 second', ts)) + 1000 <= passed"""


@register("wing_late_rows", _LATE_SQL)
def wing_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR10: the readings that the one-second windows drop because they arrive behind the watermark, all kept."""
    T.prepare(spark)
    part = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)).cast("int") + F.when(F.col("event_id") % 37 == 0, 1).otherwise(0)

    def start(records, base):
        tel, _ = FE.telemetry(records, FE.WING)
        return (tel.writeStream.queryName("late_rows").option("checkpointLocation", f"{base}/ckpt")
                .foreachBatch(P.late_rows_writer(f"{base}/out", "1 second", "2 seconds")).trigger(availableNow=True).start())

    base = _arrivals(spark, sf_dir, "wing-late", 5, part, start)
    late = spark.read.parquet(f"{base}/out/late")
    return late.select(r6("timestamp").alias("timestamp"), "sensor", "phase")


_TICK = 3600
_EXPECTED_SENSORS = [*NAMES, "tail_camera"]


@register("wing_silence", f"""WITH {WING_CTE},
z AS (SELECT max(epoch_ms(ts)) - 2000 AS passed FROM w),
t AS (SELECT DISTINCT sensor, epoch_ms(ts) // {_TICK * 1000} AS tick FROM w, z
      WHERE (epoch_ms(ts) // {_TICK * 1000} + 1) * {_TICK * 1000} <= passed),
g AS (SELECT s.sensor, u.tick FROM (SELECT unnest([{", ".join(repr(s) for s in _EXPECTED_SENSORS)}]) AS sensor) s,
      (SELECT unnest(range((SELECT min(tick) FROM t), (SELECT max(tick) + 1 FROM t))) AS tick) u
      ANTI JOIN t ON t.sensor = s.sensor AND t.tick = u.tick)
SELECT sensor, CAST(min(tick) AS BIGINT) AS from_tick, CAST(max(tick) AS BIGINT) AS to_tick, count(*) AS n_missing
FROM (SELECT *, tick - row_number() OVER (PARTITION BY sensor ORDER BY tick) AS island FROM g) GROUP BY sensor, island""")
def wing_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8 on a stream: the hours in which a sensor sent nothing, among them those of one that never did."""
    T.prepare(spark)
    expected = spark.createDataFrame([(s,) for s in _EXPECTED_SENSORS], "sensor string")

    def start(records, base):
        tel, _ = FE.telemetry(records, FE.WING)
        ticks = P.closed_ticks(tel, "1 hour", _TICK, "2 seconds", ["sensor"])
        return (ticks.writeStream.queryName("silence").outputMode("append").option("checkpointLocation", f"{base}/ckpt")
                .foreachBatch(P.silence_writer(f"{base}/out", expected, ["sensor"])).trigger(availableNow=True).start())

    part = (F.dayofmonth("ts") > 14).cast("int")
    base = _arrivals(spark, sf_dir, "wing-silence", 2, part, start)
    still = spark.read.parquet(f"{base}/out/open")
    last = still.agg(F.max("batch").alias("batch"))
    silent = spark.read.parquet(f"{base}/out/silent").drop("batch")
    return silent.unionByName(still.join(F.broadcast(last), "batch", "left_semi").drop("batch"))


# --------------------------------------------------------------------------
# Scores in event order, whatever order messages arrive in and however much one key holds.
# --------------------------------------------------------------------------
def _keep(base: str):
    """A sink that keeps the scored rows of each batch."""
    def sink(scored: DataFrame, epoch_id: int) -> None:
        scored.write.mode("overwrite").parquet(f"{base}/scored/batch={epoch_id}")
    return sink


@register("wing_ordered_scores", _scored_sql(
    'SELECT round("timestamp", 6) AS "timestamp", sensor, phase, round(score, 6) AS score, anomaly AS is_anomaly FROM fold WHERE rn > 0'))
def wing_ordered_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA2-STA4 + STR11: messages that arrive in three parts, a fifth of them a part late, scored in event order."""
    T.prepare(spark)
    part = F.least(F.floor((F.dayofmonth("ts") - 1) / 15), F.lit(1)).cast("int") + F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    seen = {}

    def start(records, base):
        rows = P.feed_rows(FE.telemetry(records, FE.WING)[0], FE.WING)
        seen["writer"] = OS.ordered_score_writer(f"{base}/model", FE.WING.slots, "30 days", _keep(f"{base}/out"))
        seen["schema"] = rows.schema
        return (rows.writeStream.queryName("ordered_scores").option("checkpointLocation", f"{base}/ckpt")
                .foreachBatch(seen["writer"]).trigger(availableNow=True).start())

    base = _arrivals(spark, sf_dir, "wing-ordered", 3, part, start)
    OS.finish(seen["writer"], seen["schema"], spark, OS.next_batch(spark, f"{base}/model"))
    out = spark.read.parquet(f"{base}/out/scored")
    return out.select(r6("timestamp").alias("timestamp"), "sensor", "phase", r6("score").alias("score"), "is_anomaly")


# Four of five readings belong to one sensor, so three keys hold most rows.
_HOT_SENSOR = "CASE WHEN event_id % 5 < 4 THEN 'view' ELSE sensor END"
HOT_ROWS, HOT_CHUNK = 400, 400


@register("hot_stream_scored", _model_sql(
    "SELECT *, row_number() OVER (PARTITION BY sensor, phase ORDER BY ts, event_id) AS rn FROM ("
    f"SELECT {_HOT_SENSOR} AS sensor, phase, ts, 1 AS kind, event_id, {O.threshold_case('(' + _HOT_SENSOR + ')')} AS threshold, "
    "value AS x_value, k AS x_k FROM readings)", keys=["sensor", "phase"]))
def hot_stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR11 with a hot key: readings stream in; the keys that hold most rows of a batch are folded in parts."""
    T.prepare(spark)
    r = T.readings(spark, sf_dir).withColumn("asset_id", F.lit(None).cast("long")).withColumn("sensor", F.expr(_HOT_SENSOR))
    base = scratch_path(spark, "hot-stream")
    rows = M.model_input(r).withColumn("ts", F.col("ts").cast("timestamp"))
    rows.withColumn("part", (F.dayofmonth("ts") > 15).cast("int")).write.partitionBy("part").parquet(f"{base}/parts")
    V.make_folder(spark, f"{base}/in")
    writer = OS.ordered_score_writer(f"{base}/model", S.EVENT_FEATURES, "1 day", _keep(f"{base}/out"),
                                     split_above=HOT_ROWS, chunk_rows=HOT_CHUNK)
    for i in range(2):
        spark.read.parquet(f"{base}/parts/part={i}").write.mode("append").parquet(f"{base}/in")
        P.run_available([spark.readStream.schema(rows.schema).parquet(f"{base}/in").writeStream.queryName("hot_scores")
                         .option("checkpointLocation", f"{base}/ckpt").foreachBatch(writer).trigger(availableNow=True).start()])
    OS.finish(writer, rows.schema, spark, OS.next_batch(spark, f"{base}/model"))
    return _model_out(spark.read.parquet(f"{base}/out/scored"))


# --------------------------------------------------------------------------
# Logs: one JSON array per sensor, read by byte ranges; ten feeds merged; PRJ26 beside.
# --------------------------------------------------------------------------
_LOG_SQL = f"""WITH {WING_CTE}
SELECT sensor, false AS is_faulty, round("timestamp", 6) AS "timestamp", phase,
       {_case({s: "b + k" for s in NAMES}, "NULL")} AS first_value FROM w WHERE sensor <> 'gyro'"""


@register("wing_array_logs", _LOG_SQL)
def wing_array_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3: the payloads logged as one JSON array per sensor and read back, an array by several tasks."""
    base = scratch_path(T.prepare(spark), "wing-logs")
    tel, _ = FE.telemetry(messages(spark, sf_dir), FE.WING)
    FS.write_sensor_arrays(tel.filter(F.col("sensor").isin(NAMES)).select("sensor", "timestamp", F.col("payload").alias("value")), base)
    logs = FS.read_sensor_logs(spark, base, indent=4, pattern=r"/sensor=(\w+?)(_faulty)?/", of="file_path")
    m = F.from_json("value", "map<string,string>")
    return logs.select("sensor", "is_faulty", r6("timestamp").alias("timestamp"), F.try_element_at(m, F.lit("phase")).alias("phase"),
                       F.map_values(m)[0].cast("double").alias("first_value"))


@register("wing_merged_feeds", f"""WITH {WING_CTE}
SELECT sensor, round("timestamp", 6) AS "timestamp", {", ".join(f"{_v} AS {f}" for f, _v in (
    (f, f"CASE WHEN sensor = '{at[0]}' THEN b * {at[1] + 1} + k END") for f, at in EXPECTED.items()))} FROM w WHERE sensor <> 'gyro'""")
def wing_merged_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET1: ten tables, one per sensor with its own columns, merged into one feed."""
    tel = materialize(FE.telemetry(messages(spark, sf_dir), FE.WING)[0], "wing-feeds")
    feeds = [tel.filter(F.col("sensor") == s).select("sensor", r6("timestamp").alias("timestamp"), *[f for f, at in EXPECTED.items() if at[0] == s])
             for s in NAMES]
    return FS.merge_feeds(*feeds)


@register("wing_continuous_monitoring", f"WITH {WING_CTE} {_MONITOR_SQL}")
def wing_continuous_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4 + STR5: monitoring rows under a processing-time trigger in update mode, stopped once all input is
    through; the latest version of each window."""
    out = _run_feed(spark, sf_dir)
    base = scratch_path(spark, "wing-continuous")
    decoded = spark.read.parquet(f"{out}/decoded")
    tel = spark.readStream.schema(decoded.schema).parquet(f"{out}/decoded").filter(~F.col("dead"))
    rows = P.monitoring_rows(FE.monitoring_input(tel, FE.WING), features=FE.WING.monitoring)
    q = (rows.writeStream.queryName("continuous").outputMode("update").trigger(processingTime="1 second")
         .option("checkpointLocation", f"{base}/ckpt").foreachBatch(P.upsert_writer(f"{base}/out")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    latest = P.latest_versions(spark, f"{base}/out", ("timestamp", "sensor", "phase"))
    return latest.withColumn("timestamp", fmt("timestamp"))
