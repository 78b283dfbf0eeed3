"""Bucketed (halo / two-level) ordered operators equal the single-sequence result.

The fixture has one hot key holding most rows spread over many buckets, some
buckets with a single row, and gaps, plus a few small keys.
"""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skyvane.operators import ordered as W

COLS = "asset_id long, sensor string, ts timestamp_ntz, event_id long, timestamp double, " \
       "phase string, value double, k double, prediction double, is_anomaly boolean"


@pytest.fixture(scope="module")
def seq(spark):
    rnd = random.Random(11)
    rows = []
    eid = 0
    t0 = dt.datetime(2024, 1, 1)
    for asset, n in ((1, 1500), (2, 7), (3, 1), (4, 40)):
        t = t0
        for _ in range(n):
            t += dt.timedelta(minutes=rnd.choice([1, 5, 30, 200, 900]))
            h = t.hour
            phase = "takeoff" if h < 8 else ("cruise" if h < 16 else "landing")
            v = rnd.choice([10.0, 10.0, 10.005, 12.5, 40.0, rnd.uniform(0, 100)])
            k = float(rnd.randint(0, 3))
            eid += 1
            rows.append((asset, "click", t, eid, (t - dt.datetime(1970, 1, 1)).total_seconds(),
                         phase, v, k, v / 100, v > 30))
    df = spark.createDataFrame(rows, COLS)
    return W.with_bucket(df, "hour", split_above=None)


def _whole(df):
    return Window.partitionBy(*W.KEYS).orderBy(*W.ORDER)


def _same(a, b, key="event_id"):
    da = {r[key]: tuple(r) for r in a.collect()}
    db = {r[key]: tuple(r) for r in b.collect()}
    assert da == db


def test_bounded_matches_whole_key_window(spark, seq):
    build = lambda w: {"ma3": W.moving_average("value", w, 3),
                       "inertia": W.thermal_inertia("value", w),
                       "smooth": W.growing_smooth("value", w),
                       "pressure": W.smooth_pressure("value", w),
                       "lag1": F.lag("value", 1).over(w)}
    got = W.bounded(seq, 5, build).select("event_id", "ma3", "inertia", "smooth", "pressure", "lag1")
    w = _whole(seq)
    want = seq.select("event_id", *[c.alias(n) for n, c in build(w).items()])
    _same(got, want)


def test_islands_match_whole_key_window(spark, seq):
    w = _whole(seq)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = (seq.withColumn("seq", F.row_number().over(w))
               .withColumn("st", F.coalesce(F.lag("phase").over(w) != F.col("phase"), F.lit(True))))
    want = base.select(
        "event_id",
        F.sum(F.col("st").cast("long")).over(run).alias("run_id"),
        (F.col("seq") - F.max(F.when(F.col("st"), F.col("seq"))).over(run) + 1).alias("reading_in_run"))
    got = W.phase_runs(seq).select("event_id", "run_id", "reading_in_run")
    _same(got, want)


def test_plateau_and_latch_match_whole_key_window(spark, seq):
    w = _whole(seq)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pl = F.coalesce(F.abs(F.col("k") - F.lag("k").over(w)) < 0.01, F.lit(False))
    b = seq.withColumn("seq", F.row_number().over(w)).withColumn("pl", pl)
    want = b.select("event_id", (F.col("seq") - F.max(F.when(~F.col("pl"), F.col("seq"))).over(run))
                    .alias("plateau_len"))
    got = W.plateau_runs(seq, "k").select("event_id", "plateau_len")
    _same(got, want)
    ev = F.when(F.col("value") > 50, 1).when(F.col("value") < 11, 0)
    want = seq.select("event_id", F.coalesce(F.last(ev, True).over(run) == 1, F.lit(False))
                      .alias("latched"))
    got = W.hysteresis(seq, F.col("value") > 50, F.col("value") < 11).select("event_id", "latched")
    _same(got, want)


def test_held_condition_matches_whole_key_window(spark, seq):
    w = _whole(seq)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = F.coalesce(F.col("is_anomaly"), F.lit(False))
    b = seq.withColumn("c", c).withColumn(
        "ent", F.col("c") & F.coalesce(~F.lag("c").over(w), F.lit(True)))
    want = b.select("event_id", F.when(F.col("c"), F.col("timestamp") - F.max(
        F.when(F.col("ent"), F.col("timestamp"))).over(run)).alias("held_s"))
    got = W.held_condition(seq, F.col("is_anomaly"), 60.0).select("event_id", "held_s")
    _same(got, want)


def test_no_operator_partitions_by_the_key_alone(spark, seq):
    plan = W.phase_runs(seq)._jdf.queryExecution().executedPlan().toString()
    # every window over the data is partitioned by (asset_id, sensor, _bucket)
    assert "_bucket" in plan


def test_adaptive_buckets_split_only_hot_keys(spark, seq):
    base = seq.drop("_bucket")
    b = W.with_bucket(base, "hour", split_above=100)
    per_key = {r["asset_id"]: r["n"] for r in
               b.groupBy("asset_id").agg(F.countDistinct("_bucket").alias("n")).collect()}
    assert per_key[1] > 1 and per_key[2] == per_key[3] == per_key[4] == 1
    got = W.phase_runs(b).select("event_id", "run_id", "reading_in_run")
    want = W.phase_runs(seq).select("event_id", "run_id", "reading_in_run")
    _same(got, want)


def test_random_sequences_match_whole_key_windows(spark):
    """Property: for random sequences, random bucket cuts and look-back n,
    the halo window and the two-level scan equal the whole-key window."""
    from hypothesis import given, settings, HealthCheck
    from hypothesis import strategies as st

    rows_st = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 40), st.integers(0, 3),
                                 st.sampled_from(["takeoff", "cruise", "landing"])),
                       min_size=1, max_size=60)

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(rows_st, st.integers(1, 4))
    def check(items, n):
        t0 = dt.datetime(2024, 1, 1)
        data = [(a, "click", t0 + dt.timedelta(hours=h, minutes=i), i, float(h * 3600 + i * 60),
                 ph, float(v), float(v), float(v) / 100, v > 1)
                for i, (a, h, v, ph) in enumerate(items)]
        df = W.with_bucket(spark.createDataFrame(data, COLS), "hour", split_above=None)
        w = _whole(df)
        build = lambda ww: {"ma": W.moving_average("value", ww, n + 1),
                            "lagn": F.lag("value", n).over(ww)}
        got = W.bounded(df, n, build).select("event_id", "ma", "lagn")
        want = df.select("event_id", *[c.alias(k) for k, c in build(w).items()])
        _same(got, want)
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        got = W.scan(df, sums={"s": F.col("value")}, last_pos={"p": F.col("value") > 1}) \
               .select("event_id", "seq", "s", "p")
        b = df.withColumn("seq", F.row_number().over(w))
        want = b.select("event_id", F.col("seq").cast("long").alias("seq"),
                        F.sum("value").over(run).alias("s"),
                        F.max(F.when(F.col("value") > 1, F.col("seq"))).over(run).cast("long")
                        .alias("p"))
        _same(got, want)

    check()


def test_null_keys_keep_their_sequence(spark):
    t0 = dt.datetime(2024, 1, 1)
    data = [(None, "click", t0 + dt.timedelta(hours=i), i, float(i), "cruise", float(i % 3),
             1.0, 0.1, False) for i in range(6)]
    df = W.with_bucket(spark.createDataFrame(data, COLS), "hour", split_above=None)
    got = {r["event_id"]: (r["seq"], r["s"]) for r in
           W.scan(df, sums={"s": F.col("value")}).select("event_id", "seq", "s").collect()}
    assert got == {i: (i + 1, float(sum(j % 3 for j in range(i + 1)))) for i in range(6)}
