"""Scores in event order over micro-batches: equal to one batch fold, replayable, late rows kept."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyvane import schema as S
from skyvane.operators import model as M
from skyvane.session import scratch_path
from skyvane.streaming import ordered_scores as OS
from skyvane.streaming import versions as V

T0 = dt.datetime(2024, 1, 1)
ROWS = ("asset_id long, sensor string, phase string, ts timestamp, kind int, event_id long, threshold double, "
        "x_value double, x_k double")


def rows(n=1500, seed=4):
    """Readings of one hot and some small keys (no asset, no phase among them) and a few updates."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        hot = rnd.random() < 0.7
        key = (None, "view", "cruise") if hot else (rnd.choice([None, 3, 4]), rnd.choice(["click", None]), rnd.choice(["landing", None]))
        update = rnd.random() < 0.02
        out.append((*key, T0 + dt.timedelta(seconds=i * 60 + rnd.randint(0, 30)), 0 if update else 1, -1 if update else i, 0.0 if update else 0.6,
                    rnd.choice([None, 10 + rnd.gauss(0, 1), 10 + rnd.gauss(0, 1), 400.0]), rnd.choice([None, 5.0 + rnd.random()])))
    return out


def result(spark, batches, delay, replay=(), **kw):
    base = scratch_path(spark, "test-ordered-scores")

    def sink(scored, epoch):
        scored.write.mode("overwrite").parquet(f"{base}/out/batch={epoch}")

    writer = OS.ordered_score_writer(base, S.EVENT_FEATURES, delay, sink, **kw)
    for i, b in enumerate(batches):
        df = spark.createDataFrame(b, ROWS)
        if i in replay:                                   # a first try that dies after its work
            with pytest.raises(RuntimeError):
                OS.ordered_score_writer(base, S.EVENT_FEATURES, delay, lambda s, e: (_ for _ in ()).throw(RuntimeError("lost")), **kw)(df, i)
        writer(df, i)
    OS.finish(writer, df.schema, spark, OS.next_batch(spark, base))
    scored = spark.read.parquet(f"{base}/out").filter(F.col("kind") == M.READING)
    late = spark.read.parquet(f"{base}/late").count()
    return {r["event_id"]: (round(r["score"], 9), r["is_anomaly"], None if r["mean_value"] is None else round(r["mean_value"], 9))
            for r in scored.collect()}, late, base


def batch_fold(spark, data):
    got = M.score(spark.createDataFrame(data, ROWS)).filter(F.col("kind") == M.READING)
    return {r["event_id"]: (round(r["score"], 9), r["is_anomaly"], None if r["mean_value"] is None else round(r["mean_value"], 9))
            for r in got.collect()}


@pytest.mark.parametrize("split", [{}, {"split_above": 150, "chunk_rows": 60}])
def test_disordered_batches_equal_one_fold(spark, split):
    data = rows()
    want = batch_fold(spark, data)
    rnd = random.Random(1)
    # a row may arrive up to two batches after its turn
    parts = [[] for _ in range(5)]
    for i, r in enumerate(data):
        parts[min(4, i // 500 + rnd.choice([0, 0, 1, 2]))].append(r)
    for p in parts:
        rnd.shuffle(p)
    got, late, base = result(spark, parts, "26 hours", replay=(1, 3), **split)
    assert late == 0 and got == want
    # only the versions that a replay can need are kept
    import os
    assert len(os.listdir(f"{base}/state")) <= 3


def test_rows_behind_the_watermark_are_kept_apart(spark):
    data = rows(300)
    got, late, base = result(spark, [data[100:], data[:100]], "10 minutes")
    assert late == 100
    assert got == batch_fold(spark, data[100:])
    kept = {r["ts"] for r in spark.read.parquet(f"{base}/late").collect()}
    assert kept == {r[3] for r in data[:100]}


def test_empty_batches_and_an_empty_stream(spark):
    data = rows(60)
    got, late, _ = result(spark, [[], data[:30], [], data[30:], []], "1 minute")
    assert late == 0 and got == batch_fold(spark, data)
    assert result(spark, [[]], "1 minute")[0] == {}


def test_versions_keep_what_a_replay_needs(spark):
    base = scratch_path(spark, "test-versions")
    for i in range(4):
        spark.range(i).write.mode("overwrite").parquet(f"{base}/batch={i}")
        V.forget(spark, base, i)
    assert V.before(spark, base, 3, "id long").count() == 2 and V.before(spark, base, 0, "id long").count() == 0
    assert spark.read.parquet(base).select("batch").distinct().count() == 2


def test_a_batch_is_computed_once(spark):
    """The clock, the late rows, the waiting rows and the fold read what the batch wrote, not the batch again."""
    acc = spark.sparkContext.accumulator(0)

    @F.udf("timestamp")
    def decoded(ts):
        acc.add(1)
        return ts

    data, base, out = rows(400), scratch_path(spark, "test-ordered-once"), []
    writer = OS.ordered_score_writer(base, S.EVENT_FEATURES, "1 hour", lambda s, e: out.append(s.count()))
    writer(spark.createDataFrame(data, ROWS).withColumn("ts", decoded("ts")), 0)
    assert acc.value == 400
    n = spark.read.parquet(f"{base}/waiting/batch=0").count()
    assert 0 < n < 400 and out == [400 - n]


def test_states_are_kept_once_a_stretch(spark):
    """The state after a row is only stored where a key's walk ends, and is the key's last one."""
    data = [(None, "view", "cruise", T0 + dt.timedelta(seconds=i), 1, i, 0.6, 10.0 + i % 7, None) for i in range(300)]
    base = scratch_path(spark, "test-ordered-after")
    writer = OS.ordered_score_writer(base, S.EVENT_FEATURES, "0 seconds", lambda s, e: None)
    writer(spark.createDataFrame(data, ROWS), 0)
    folded = spark.read.parquet(f"{base}/folded/batch=0")
    assert folded.count() == 300 and folded.filter("_after_hp IS NOT NULL").count() == 1
    last = folded.orderBy(F.desc("event_id")).first()
    state = spark.read.parquet(f"{base}/state/batch=0").collect()
    assert [(r["_init_hp"], r["_init_m_value"], r["_init_p_value"], r["_init_m_k"]) for r in state] == [(1.0, last["mean_value"], 10.0 + 299 % 7, None)]


def test_rows_without_a_time_wait(spark):
    data = rows(100)
    data[7] = (*data[7][:3], None, *data[7][4:])
    got, late, base = result(spark, [data[:50], data[50:]], "1 minute")
    assert late == 0 and got == batch_fold(spark, data[:7] + data[8:])
    assert spark.read.parquet(f"{base}/waiting/batch=2").count() == 1
