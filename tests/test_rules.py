"""Failure rules: shared pass, actuator faults and moment states."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyvane import schema as S
from skyvane.operators import moments as MO
from skyvane.operators import ordered as W
from skyvane.operators import rules as R
from skyvane.plans import wing_rules

SF = "/root/testdata/sf0.01"


def spoiler(spark, rows):
    """rows: (time, phase, command, actual, current, lag)"""
    data = [(i, float(t), "spoiler", p, c, a, m, lag) for i, (t, p, c, a, m, lag) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id long, timestamp double, sensor string, phase string, spoiler_cmd double, "
                               "spoiler_actual double, spoiler_motor double, spoiler_lag double")
    return df.withColumn("event_time", F.timestamp_seconds("timestamp"))


def faults(df):
    out = R.actuator_faults(df, S.SPOILER_LAG_LIMITS, S.SPOILER_LAG_DEFAULT, S.SPOILER_STALL_SECONDS)
    return [(r["command_lag"], r["actuator_stall"], r["excessive_lag"], r["signal_miss"], r["status"])
            for r in out.orderBy("event_id").collect()]


ROWS = [
    (0, "cruise", 0.0, 0.0, 0.0, 0.0),
    (1, "cruise", 3.0, 0.0, 0.0, 150.0),        # command lag over 100: excess until the phase ends
    (2, "cruise", 3.0, 0.5, 0.0, 0.0),          # applies, error above 2, no current: the stall begins
    (3, "cruise", 3.0, 0.5, 0.0, 0.0),
    (4, "cruise", 3.0, 0.5, 0.0, 0.0),          # 2 s are not more than 2 s
    (4.5, "cruise", 3.0, 0.5, 0.0, 0.0),        # stalled
    (5, "cruise", 3.0, 0.5, 0.9, 0.0),          # current flows
    (6, "landing", 3.0, 3.0, 0.0, 0.0),         # new phase: no command lag, so a signal miss
    (7, "landing", 40.0, 3.0, 0.0, 180.0),      # within 200; the miss stays
    (8, "landing", 40.0, 3.0, 0.0, 0.0),        # stall begins
    (9, "takeoff", 40.0, 3.0, 0.0, 0.0),        # idle: not tested, all flags are clear
    (12, "cruise", 40.0, 3.0, 0.0, 0.0),        # the stall goes on from 8
    (13, "cruise", None, 3.0, 0.0, None),
]
EXPECTED = [
    (0.0, False, False, False, "normal"), (150.0, False, True, False, "degraded"), (150.0, False, True, False, "degraded"),
    (150.0, False, True, False, "degraded"), (150.0, False, True, False, "degraded"), (150.0, True, True, False, "degraded"),
    (150.0, False, True, False, "degraded"), (0.0, False, False, True, "degraded"), (180.0, False, False, True, "degraded"),
    (180.0, False, False, True, "degraded"), (0.0, False, False, False, "normal"), (0.0, True, False, True, "degraded"),
    (0.0, False, False, True, "degraded"),
]


def test_actuator_faults_by_hand(spark):
    assert faults(spoiler(spark, ROWS)) == EXPECTED


@pytest.mark.parametrize("grain", ["second", "minute"])
def test_actuator_faults_over_split_keys(spark, grain):
    df = spoiler(spark, [(t * 7, *r) for t, *r in ROWS] + [(t * 7 + 200, *r) for t, *r in ROWS])
    split = W.with_bucket(df, grain, "event_time", split_above=None, keys=("sensor",))
    assert faults(split) == faults(df)


def test_every_rule_fires_and_rests(spark):
    """On the flight readings each rule fires for some of its sensor's readings only, split or not."""
    tel = wing_rules._flight(spark, SF)
    tel = tel.persist()
    per_sensor = {r["sensor"]: r["n"] for r in tel.groupBy("sensor").agg(F.count(F.lit(1)).alias("n")).collect()}
    whole = R.fired(tel, S.WING_RULES, S.WING_PHASE_LIMITS)
    split = R.fired(W.with_bucket(tel, "day", "event_time", split_above=None, keys=("sensor",)), S.WING_RULES, S.WING_PHASE_LIMITS)

    def rows(df):
        return sorted((r["event_id"], r["rule"], r["held"]) for r in df.select("event_id", F.inline("fired")).collect())

    a = rows(whole)
    assert a == rows(split)
    count = {}
    for _, rule, _ in a:
        count[rule] = count.get(rule, 0) + 1
    for name, sensor, _, _ in S.WING_RULES:
        if name == "node_impossible" or name == "strain_implausible":
            continue                                  # seen in the next test
        assert 0 < count.get(name, 0) < per_sensor[sensor], name
    tel.unpersist()


def test_rules_on_single_readings(spark):
    cols = "event_id long, event_time timestamp, sensor string, phase string, node_deflection double, node_accel double, " \
           "node_strain double, strain double, snr double, strain_temp double"
    base = spark.sql("select timestamp'2024-01-01 00:00:00' t").first()["t"]
    rows = [(1, base, "wingtip_node", "cruise", 88.0, 0.3, 371.0, None, None, None),
            (2, base, "wingtip_node", "cruise", 88.0, 0.6, 370.0, None, None, None),
            (3, base, "wingtip_strain", "landing", None, None, None, 0.0, 18.0, None),
            (4, base, "wingtip_strain", "cruise", None, None, None, 480.0, 18.0, -31.0),
            (5, base, "wingtip_strain", "cruise", None, None, None, 100.0, 18.0, -20.0),
            (6, base, "wingtip_strain", None, None, None, None, 100.0, 18.0, None),
            (7, base, "wingtip_strain", "cruise", None, None, None, None, None, None),
            (8, base, "gyro", "cruise", 88.0, 0.3, 400.0, 0.0, 1.0, None)]
    rules = [r for r in S.WING_RULES if r[1] in ("wingtip_node", "wingtip_strain")]
    limits = [x for x in S.WING_PHASE_LIMITS if x[2] in ("strain_temp", "node_strain")]
    out = R.fired(spark.createDataFrame(rows, cols), rules, limits).collect()
    got = {r["event_id"]: [(x["rule"], x["held"]) for x in r["fired"]] for r in out}
    assert got == {1: [("high_node_strain", 1), ("node_impossible", 1), ("node_strain_high", 1)], 2: [("high_node_strain", 1)],
                   3: [("strain_implausible", 1)], 4: [("low_strain_temp", 1), ("strain_implausible", 1)],
                   5: [], 6: [("strain_snr_low", 4)], 7: []}


def test_moment_states_merge_like_one_pass(spark):
    rng = np.random.default_rng(4)
    n = 400
    t = 1.7e9 + np.sort(rng.integers(0, 40_000, n)).astype(float)
    x, y = rng.normal(5e4, 3, n), rng.normal(0, 1, n)
    y += x - 5e4
    rows = [(float(a), "s", None if i % 17 == 0 else float(b), None if i % 13 == 0 else float(c)) for i, (a, b, c) in enumerate(zip(t, x, y))]
    df = spark.createDataFrame(rows, "timestamp double, sensor string, x double, y double").repartition(5)
    pairs = [("xy", F.col("x"), F.col("y")), ("ty", MO.TIME, F.col("y"))]
    out = MO.spans(MO.bin_states(df, pairs, 3600), pairs, 3, 3600)
    got = {r["bin"]: r for r in out.select("bin", "n_readings", MO.corr("xy").alias("c"), MO.slope("ty").alias("s"),
                                           F.col("xy.lo").alias("lo")).collect()}
    bins = np.floor(t / 3600)
    assert set(got) == set(bins)
    for b in set(bins):
        inside = (bins > b - 3) & (bins <= b)
        i = np.flatnonzero(inside)
        both = [k for k in i if k % 17 and k % 13]
        ys = [k for k in i if k % 13]
        assert got[b]["n_readings"] == len(i)
        assert math.isclose(got[b]["c"], np.corrcoef(x[both], y[both])[0, 1], abs_tol=1e-9)
        assert math.isclose(got[b]["s"], np.polyfit(t[ys] - t[ys].mean(), y[ys], 1)[0], rel_tol=1e-6, abs_tol=1e-12)
        assert got[b]["lo"] == y[both].min()


def test_spans_without_spread_or_readings_do_not_fire(spark):
    df = spark.createDataFrame([(float(i), "slat", 2.0) for i in range(10)] + [(9000.0, "slat", None)],
                               "timestamp double, sensor string, slat_error double")
    out = MO.growing_error(df, "slat_error", 2, 3600).orderBy("bin").collect()
    assert [(r["bin"], r["fired"]) for r in out] == [(0, False), (2, False)]
    up = spark.createDataFrame([(float(i), "slat", -2.0 - i) for i in range(5)], "timestamp double, sensor string, slat_error double")
    assert [r["fired"] for r in MO.growing_error(up, "slat_error", 2, 3600).collect()] == [True]
    assert MO.growing_error(up.limit(0), "slat_error", 2, 3600).count() == 0
