"""The wing job: one decode, topics, replays, late rows, silence."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from skyvane import feeds as FE
from skyvane import schema as S
from skyvane.plans import wing
from skyvane.session import scratch_path
from skyvane.sources import files as FS
from skyvane.streaming import ordered_scores as OS
from skyvane.streaming import pipeline as P
from skyvane.streaming import versions as V

SF = "/root/testdata/sf0.001"
NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def lines(spark):
    base = scratch_path(spark, "test-wing-lines")
    wing.messages(spark, SF).write.text(f"{base}/in")
    return base


def test_source_is_read_by_the_decode_only(spark, lines):
    base = scratch_path(spark, "test-one-decode")
    qs = P.start_feed(spark, FS.telemetry_stream(spark, "text", f"{lines}/in"), base, FE.WING, trigger=NOW)
    P.run_available(qs)
    reads = {q.name: [s["description"] for p in q.recentProgress for s in p["sources"]] for q in qs}
    assert all(f"{lines}/in" in d for d in reads.pop("decode"))
    for name, sources in reads.items():
        assert sources and all(f"{base}/decoded" in d for d in sources), name
    n = spark.read.text(f"{lines}/in").count()
    dead = spark.read.parquet(f"{base}/dead_letters").count()
    assert dead and spark.read.text(f"{base}/scored/scored_messages").count() == n - dead


def test_failed_sink_replays_cleanly(spark, lines):
    """A sink that fails half-way through its batch is started again: the source is not read again, and
    its result is that of a run without failure. A decode that fails leaves nothing to read."""
    base = scratch_path(spark, "test-replay")
    V.make_folder(spark, f"{base}/in")
    spark.read.text(f"{lines}/in").write.mode("append").text(f"{base}/in")
    query, tel, _ = P.decoded_log(FE.decode(FS.telemetry_stream(spark, "text", f"{base}/in"), FE.WING), base, NOW)
    decoded = spark.read.parquet(f"{base}/decoded").count()
    writer = P.fan_out_writer(f"{base}/scored")

    def start(fail):
        def run(batch, epoch):
            if fail:
                batch.limit(5).write.mode("overwrite").parquet(f"{base}/scored/scored/batch={epoch}")
                raise RuntimeError("sink lost")
            writer(batch, epoch)
        return P.scored_feed(tel, FE.WING).writeStream.queryName("scoring").option(
            "checkpointLocation", f"{base}/ckpt/scoring").foreachBatch(run).trigger(availableNow=True).start()

    with pytest.raises(Exception, match="sink lost"):
        P.run_available([start(True)])
    P.run_available([start(False)])
    got = spark.read.text(f"{base}/scored/scored_messages")
    good = spark.read.parquet(f"{base}/decoded").filter("not dead")
    assert got.count() == good.count() and spark.read.parquet(f"{base}/decoded").count() == decoded
    assert got.distinct().count() == got.count()
    # a second decode run over the same checkpoint adds nothing
    P.decoded_log(FE.decode(FS.telemetry_stream(spark, "text", f"{base}/in"), FE.WING), base, NOW)
    assert spark.read.parquet(f"{base}/decoded").count() == decoded


def test_topics(spark, lines, monkeypatch):
    sent = []

    def fake(df, target, fmt="text", **options):
        sent.append((target, fmt, options, df.count()))

    monkeypatch.setattr(P, "write_messages", fake)
    base = scratch_path(spark, "test-topics")
    P.run_available(P.start_feed(spark, FS.telemetry_stream(spark, "text", f"{lines}/in"), base, FE.WING, trigger=NOW, fmt="kafka",
                                 topics={"alerts": "wing.alerts"}, **{"kafka.bootstrap.servers": "h:1"}))
    assert {t for t, _, _, n in sent if n} == {"sensor-data", "wing.alerts", "model-updates"}
    assert all(f == "kafka" and o == {"kafka.bootstrap.servers": "h:1"} for _, f, o, _ in sent)
    import re
    assert all(re.fullmatch(r"[A-Za-z0-9._-]{1,249}", t) for t, *_ in sent)


def test_job_topic_options():
    from skyvane.streaming import job
    args = job.parse(["--out", "x", "--sink", "kafka", "--topic", "updates=m.u"])
    assert dict(t.split("=", 1) for t in args.topic) == {"updates": "m.u"}


def test_job_with_console_feedback_and_event_order(spark, lines):
    """The job as a process: prints monitoring rows, feeds updates back, scores in event order."""
    import os
    import subprocess
    import sys
    base = scratch_path(spark, "test-job-flags")
    P.run_available(P.start_feed(spark, FS.telemetry_stream(spark, "text", f"{lines}/in"), f"{base}/first", FE.WING, trigger=NOW, update_mode="append"))
    spark.read.text(f"{base}/first/updates").select("value").write.text(f"{base}/sent")
    out = subprocess.run(
        [sys.executable, "-m", "skyvane.streaming.job", "--source", "text", "--path", f"{lines}/in", "--out", f"{base}/out", "--available-now",
         "--shuffle-partitions", "4", "--console", "--feedback", f"{base}/sent", "--exact-order-delay", "1 hour"],
        capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    assert "Batch: 0" in out.stdout and "node_deflection" in out.stdout
    scored = spark.read.parquet(f"{base}/out/scored/scored")
    n = spark.read.parquet(f"{base}/out/decoded").filter("not dead").count()
    assert 0.9 * n < scored.filter("kind = 1").count() <= n and scored.filter("kind = 0").count() > 0


def test_closed_windows_are_sent_once(spark, lines):
    base = scratch_path(spark, "test-closed")
    P.run_available(P.start_feed(spark, FS.telemetry_stream(spark, "text", f"{lines}/in"), base, FE.WING, trigger=NOW, update_mode="append"))
    u = spark.read.text(f"{base}/updates").select(F.from_json("value", S.UPDATE_MESSAGE).alias("u")).select("u.*")
    assert u.count() > 100 and u.groupBy("timestamp", "sensor", "phase").count().filter("count > 1").count() == 0
    assert u.filter("version is null").count() == 0


T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_late_rows_are_those_that_windows_drop(spark):
    """Every row is either in a window of the stream or among the late rows."""
    base = scratch_path(spark, "test-late")
    V.make_folder(spark, f"{base}/in")
    parts = [[0.0, 1.0, 2.5, 30.0], [29.2, 28.0, 27.9999, 27.0, 26.5, 60.0], [57.9, 58.0, 58.5, 59.0, 3.0, None], [200.0]]
    n = 0
    for rows in parts:
        body = [json.dumps({"timestamp": None if s is None else at(s).timestamp(), "sensor": "flap", "phase": "cruise", "value": {"flap_angle": 1.0 * i},
                            "prediction": 0.5, "is_anomaly": False}) for i, s in enumerate(rows)]
        n += len([s for s in rows if s is not None])
        spark.createDataFrame([(b,) for b in body], "value string").coalesce(1).write.mode("append").text(f"{base}/in")
        tel, _ = FE.telemetry(FS.telemetry_stream(spark, "text", f"{base}/in"), FE.WING)
        w = tel.withWatermark("event_time", "2 seconds").groupBy(F.window("event_time", "1 second")).agg(F.count(F.lit(1)).alias("n"))
        P.run_available([
            w.writeStream.outputMode("append").format("parquet").option("path", f"{base}/windows").option("checkpointLocation", f"{base}/c1")
            .trigger(availableNow=True).start(),
            tel.writeStream.foreachBatch(P.late_rows_writer(f"{base}/out", "1 second", "2 seconds"))
            .option("checkpointLocation", f"{base}/c2").trigger(availableNow=True).start()])
    late = spark.read.parquet(f"{base}/out/late")
    assert sorted((r["event_time"] - at(0).replace(tzinfo=None)).total_seconds() for r in late.collect()) == [3.0, 26.5, 27.0, 27.9999, 57.9]
    kept = spark.read.parquet(f"{base}/windows").agg(F.sum("n")).first()[0]
    assert kept + late.count() == n - 1                     # the last window is still open


def ticks(spark, rows):
    return spark.createDataFrame(rows, "sensor string, tick long")


def test_silence_across_batches(spark):
    """Stretches do not depend on how ticks are dealt to batches; a replayed batch changes nothing."""
    expected = spark.createDataFrame([("a",), ("b",), ("never",), ("a",)], "sensor string")
    every = [("a", 5), ("a", 6), ("a", 9), ("b", 8), ("a", 14), ("other", 20), ("b", 15)]

    def result(batches, replay=()):
        base = scratch_path(spark, "test-silence")
        w = P.silence_writer(base, expected, ["sensor"])
        for i, rows in enumerate(batches):
            w(ticks(spark, rows), i)
            if i in replay:
                w(ticks(spark, rows), i)
        last = spark.read.parquet(f"{base}/open/batch={len(batches) - 1}")
        both = spark.read.parquet(f"{base}/silent").drop("batch").unionByName(last)
        return sorted(tuple(r) for r in both.collect())

    one = result([every])
    assert one == [("a", 7, 8, 2), ("a", 10, 13, 4), ("a", 15, 20, 6), ("b", 5, 7, 3), ("b", 9, 14, 6), ("b", 16, 20, 5),
                   ("never", 5, 20, 16)]
    assert result([[], every[:2], [], every[2:4], every[4:]], replay=(1, 3)) == one
    assert result([[]]) == []


def test_messages_are_spread_and_decoded_in_compiled_methods(spark):
    """A table of one row group is shared out before its messages are built; the decode's stage is no method that
    HotSpot leaves interpreted."""
    base = scratch_path(spark, "test-spread")
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), 1, "view", float(i % 90), '{"k": 3}') for i in range(300)] + [(None, None, None, None, None, None)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(
        f"{base}/events.parquet")
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    plain, spread = wing.messages(spark, base), wing.messages(spark, base, spread=True)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert "REPARTITION_BY_COL" in spread._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    FE.telemetry(spread, FE.WING)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
