"""Structured Streaming: late data, batch = stream parity, sinks and sources."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from skyvane import schema as S
from skyvane.operators import model as M
from skyvane.session import scratch_path
from skyvane.sources import files as FS
from skyvane.sources import telemetry as T
from skyvane.streaming import pipeline as P

SF = "/root/testdata/sf0.001"


def _write_lines(folder, name, lines, mtime):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    os.utime(path, (mtime, mtime))


def _msg(ts, value, sensor="click"):
    return json.dumps({"timestamp": ts, "sensor": sensor, "phase": "cruise", "prediction": 0.1,
                       "is_anomaly": False, "asset_id": 1, "event_id": int(ts * 10),
                       "value": {"value": value, "k": 1}})


def test_late_row_is_dropped_and_counted(spark):
    """A row is late when its window ends at or before the watermark of the
    previous micro-batch (here 103 s - 2 s = 101 s): a reading at 95.5 s
    (window [95, 100)) arriving after 121 s is dropped and counted."""
    base = scratch_path(spark, "late")
    src = f"{base}/in"
    t0 = time.time() - 100
    _write_lines(src, "a.json", [_msg(t, 1.0) for t in (100.0, 101.0, 102.0, 103.0)], t0)
    _write_lines(src, "b.json", [_msg(t, 2.0) for t in (120.0, 121.0)], t0 + 10)
    _write_lines(src, "c.json", [_msg(95.5, 9.0)], t0 + 20)
    tel, _ = P.decoded(FS.telemetry_stream(spark, "text", src, maxFilesPerTrigger="1"))
    q = P.start_parquet(P.monitoring_rows(tel), f"{base}/out", f"{base}/ckpt", "late",
                        trigger={"availableNow": True})
    P.run_available([q])
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    assert dropped == 1
    out = spark.read.parquet(f"{base}/out").orderBy("timestamp").collect()
    starts = [r["timestamp"].timestamp() for r in out]
    # closed windows only: [100,105) is emitted once; the late row's window never
    # appears; [120,125) stays open because the watermark (119 s) has not passed it
    assert starts == [100.0]
    assert out[0]["value"] == 1.0


def test_streamed_model_over_batches_equals_batch_fold(spark):
    base = scratch_path(spark, "parity")
    r = T.readings(spark, SF)
    # time-ordered files, one micro-batch each: key order is kept across batches
    slices = r.withColumn("day", F.dayofmonth("ts")).select("day", T.envelope_json(r).alias("value"))
    t0 = time.time() - 1000
    for i, day in enumerate(sorted(x["day"] for x in slices.select("day").distinct().collect())):
        lines = [x["value"] for x in slices.filter(F.col("day") == day).collect()]
        _write_lines(f"{base}/in", f"d{day:02d}.json", lines, t0 + i)
    tel, _ = P.decoded(FS.telemetry_stream(spark, "text", f"{base}/in", maxFilesPerTrigger="1"))
    q = (P.scored_stream(tel).writeStream.option("checkpointLocation", f"{base}/ckpt")
         .foreachBatch(P.fan_out_writer(f"{base}/out")).trigger(availableNow=True).start())
    P.run_available([q])
    assert len(q.recentProgress) > 5
    streamed = {x["event_id"]: (round(x["score"], 9), x["is_anomaly"])
                for x in spark.read.parquet(f"{base}/out/scored").collect()}
    batch = {x["event_id"]: (round(x["score"], 9), x["is_anomaly"])
             for x in M.score(M.model_input(r)).collect()}
    assert streamed == batch
    alerts = spark.read.parquet(f"{base}/out/alerts")
    assert alerts.count() == sum(1 for v in batch.values() if v[1])


def test_sensor_json_array_logs(spark):
    base = scratch_path(spark, "logs")
    os.makedirs(base, exist_ok=True)
    entries = {"flap.json": [{"timestamp": 1.0, "value": {"flap_angle": 15.0, "status": "MOVING"}},
                             {"timestamp": 2.0, "value": {"flap_angle": 15.5}}],
               "slat_faulty.json": [{"timestamp": 1.5, "value": {"actual_angle_deg": 3.0}}]}
    for name, arr in entries.items():
        with open(os.path.join(base, name), "w") as fh:
            json.dump(arr, fh, indent=2)
    df = FS.read_sensor_logs(spark, base)
    rows = sorted((r["sensor"], r["is_faulty"], r["timestamp"]) for r in df.collect())
    assert rows == [("flap", False, 1.0), ("flap", False, 2.0), ("slat", True, 1.5)]
    from skyvane.functions import decode as D
    feats = df.select("sensor", D.edge_features(F.col("value"), S.WING_KEY_MAP).alias("f")) \
              .orderBy("sensor").collect()
    assert feats[0]["f"] == {"flap_angle": 15.0} and feats[2]["f"] == {"slat_actual": 3.0}


def test_update_writer_and_update_stream(spark):
    base = scratch_path(spark, "updates")
    r = T.readings(spark, SF)
    r.select(T.envelope_json(r).alias("value")).write.text(f"{base}/in")
    tel, _ = P.decoded(FS.telemetry_stream(spark, "text", f"{base}/in"))
    rows = P.monitoring_rows(tel, "1 hour", "2 seconds")
    q = (rows.writeStream.option("checkpointLocation", f"{base}/ckpt")
         .foreachBatch(P.update_batch_writer(f"{base}/msgs", S.update_feature_table(spark),
                                             S.sensor_table(spark)))
         .trigger(availableNow=True).start())
    P.run_available([q])
    ups = FS.update_stream(spark, "text", f"{base}/msgs")
    q2 = ups.writeStream.format("memory").queryName("ups").trigger(availableNow=True).start()
    P.run_available([q2])
    got = spark.sql("SELECT * FROM ups")
    assert got.count() > 0
    assert got.filter(F.size("features") == 0).count() == 0
    assert got.filter((F.col("sensor") == "error") & F.col("features").getItem("k").isNotNull()).count() == 0


def test_update_json_is_valid(spark):
    from skyvane.operators import aggregations as A
    from skyvane.operators import lookups as L
    r = T.readings(spark, SF)
    msgs = L.update_messages(A.window_rows(r, "1 hour", time_col="ts"), S.update_feature_table(spark))
    js = [json.loads(x["value"]) for x in L.update_json(msgs).limit(5).collect()]
    assert all(set(j) == {"timestamp", "sensor", "score", "is_anomaly", "phase", "features"} for j in js)


def test_full_pipeline_runs_all_queries(spark):
    base = scratch_path(spark, "pipeline")
    r = T.readings(spark, SF)
    r.select(T.envelope_json(r).alias("value")).write.text(f"{base}/in")
    _write_lines(f"{base}/in", "zz-bad.txt", ["{not json"], time.time())
    records = FS.telemetry_stream(spark, "text", f"{base}/in")
    qs = P.start_pipeline(spark, records, f"{base}/out", trigger={"availableNow": True})
    assert len(qs) == 5
    P.run_available(qs)
    assert spark.read.text(f"{base}/out/updates").count() > 0
    assert spark.read.parquet(f"{base}/out/training").select("date").distinct().count() > 1
    assert spark.read.parquet(f"{base}/out/scored/scored").count() == r.count()
    dead = spark.read.parquet(f"{base}/out/dead_letters").collect()
    assert [d["json_str"] for d in dead] == ["{not json"]


def test_merge_feeds_aligns_columns(spark):
    a = spark.createDataFrame([(1.0, 2.0)], "timestamp double, flap_angle double") \
             .withColumn("sensor", F.lit("flap"))
    b = spark.createDataFrame([(1.5, 3.0)], "timestamp double, slat_actual double") \
             .withColumn("sensor", F.lit("slat"))
    m = FS.merge_feeds(a, b)
    assert set(m.columns) == {"timestamp", "flap_angle", "slat_actual", "sensor"}
    assert m.filter(F.col("sensor") == "slat").first()["flap_angle"] is None


def test_feedback_updates_stream_into_the_model(spark):
    """STA5 on a stream: update messages (SRC2) unioned with readings feed the
    keyed model; in one micro-batch this equals the batch feedback fold."""
    from skyvane.plans import catalog as C
    from skyvane.operators import lookups as L
    base = scratch_path(spark, "feedback")
    r = T.readings(spark, SF)
    r.select(T.envelope_json(r).alias("value")).write.text(f"{base}/in")
    ups = C.daily_updates(r, spark).drop("effective_ts")
    L.update_json(ups).write.text(f"{base}/updates")
    tel, _ = P.decoded(FS.telemetry_stream(spark, "text", f"{base}/in"))
    upd = P.with_effective_ts(FS.update_stream(spark, "text", f"{base}/updates"), "1 day")
    q = (P.scored_stream(tel, upd).writeStream.option("checkpointLocation", f"{base}/ckpt")
         .foreachBatch(P.fan_out_writer(f"{base}/out")).trigger(availableNow=True).start())
    P.run_available([q])
    got = spark.read.parquet(f"{base}/out/scored").filter(F.col("kind") == M.READING)
    streamed = {x["event_id"]: (round(x["score"], 9), x["is_anomaly"]) for x in got.collect()}
    rows = M.model_input(r).unionByName(M.update_input(C.daily_updates(r, spark)))
    batch = {x["event_id"]: (round(x["score"], 9), x["is_anomaly"])
             for x in M.score(rows).filter(F.col("kind") == M.READING).collect()}
    assert streamed == batch
    plain = {x["event_id"]: round(x["score"], 9) for x in M.score(M.model_input(r)).collect()}
    assert any(plain[k] != v[0] for k, v in batch.items())  # the updates matter


def test_streaming_job_entry_point(spark, tmp_path):
    import subprocess
    import sys
    base = scratch_path(spark, "job")
    r = T.readings(spark, SF)
    r.select(T.envelope_json(r).alias("value")).write.text(f"{base}/in")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, "-m", "skyvane.streaming.job", "--source", "text", "--path", f"{base}/in",
         "--out", f"{base}/out", "--available-now", "--shuffle-partitions", "4", "--feed", "events"],
        capture_output=True, text=True, cwd=repo, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    assert spark.read.parquet(f"{base}/out/scored/scored").count() == r.count()


def test_event_time_ordered_model_is_independent_of_arrival_order(spark):
    """Rows arrive out of order (each file holds part of day d and the rest
    of day d-1); buffering to the watermark (1 day) restores event order."""
    import random
    from skyvane.streaming import model_state as MS
    base = scratch_path(spark, "ordered")
    r = T.readings(spark, SF)
    rows = r.select("event_id", F.dayofmonth("ts").alias("day"), T.envelope_json(r).alias("v")).collect()
    rnd = random.Random(1)
    by_day = {}
    for x in rows:
        by_day.setdefault(x["day"], []).append(x)
    days = sorted(by_day)
    t0 = time.time() - 1000
    carry = []
    for i, d in enumerate(days):
        now = [x for x in by_day[d] if rnd.random() < 0.5]
        later = [x for x in by_day[d] if x not in now]
        _write_lines(f"{base}/in", f"f{i:02d}.json", [x["v"] for x in now + carry], t0 + i)
        carry = later
    _write_lines(f"{base}/in", "f99.json", [x["v"] for x in carry], t0 + 99)
    tel, _ = P.decoded(FS.telemetry_stream(spark, "text", f"{base}/in", maxFilesPerTrigger="1"))
    model_rows = M.model_input(tel.withColumn("ts", F.col("event_time")))
    scored = MS.score_stream_ordered(model_rows, delay="1 day")
    q = (scored.writeStream.option("checkpointLocation", f"{base}/ckpt")
         .foreachBatch(P.fan_out_writer(f"{base}/out")).trigger(availableNow=True).start())
    P.run_available([q])
    got = {x["event_id"]: (round(x["score"], 9), x["is_anomaly"])
           for x in spark.read.parquet(f"{base}/out/scored").collect()}
    want = {x["event_id"]: (round(x["score"], 9), x["is_anomaly"])
            for x in M.score(M.model_input(r)).collect()}
    assert len(got) > 0.8 * len(want)
    assert all(got[k] == want[k] for k in got)


def test_streaming_job_with_exact_order(spark):
    import subprocess
    import sys
    base = scratch_path(spark, "job-ordered")
    r = T.readings(spark, SF)
    r.select(T.envelope_json(r).alias("value")).write.text(f"{base}/in")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, "-m", "skyvane.streaming.job", "--source", "text", "--path", f"{base}/in",
         "--out", f"{base}/out", "--available-now", "--shuffle-partitions", "4",
         "--exact-order-delay", "1 hour", "--feed", "events"],
        capture_output=True, text=True, cwd=repo, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    scored = spark.read.parquet(f"{base}/out/scored/scored")
    # rows within the last hour stay buffered until a later watermark
    assert 0.9 * r.count() < scored.count() <= r.count()
