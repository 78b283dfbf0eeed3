"""EWMA without a fold, as-of tags and silence."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from skyvane.operators import ordered as W
from skyvane.operators import timeline as TL
from skyvane.operators.ewma import ewma


def fold(values, alpha):
    out, m = [], None
    for v in values:
        if v is not None and not math.isnan(v):
            m = v if m is None else alpha * v + (1 - alpha) * m
        out.append(m)
    return out


@pytest.mark.parametrize("alpha", [0.2, 0.97, 0.01, 1.0])
@pytest.mark.parametrize("split", [False, True])
def test_ewma_equals_the_fold(spark, alpha, split):
    rnd = random.Random(2)
    seqs = {None: [None, None, 5.0, None, float("nan"), 7.0], 1: [rnd.uniform(-1e3, 1e3) for _ in range(2500)],
            2: [1e9] + [1.0] * 900, 3: [None] * 4,
            4: [rnd.choice([None, rnd.gauss(0, 1), float("nan")]) for _ in range(1500)]}
    rows = [(k, "s", i, i * 60.0, v) for k, vs in seqs.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "asset_id long, sensor string, event_id long, timestamp double, value double").repartition(6)
    df = df.withColumn("ts", F.timestamp_seconds("timestamp"))
    if split:
        df = W.with_bucket(df, "hour", split_above=None)
    got = {}
    for r in ewma(df, "value", alpha).collect():
        got[(r["asset_id"], r["event_id"])] = r["ewma"]
    assert len(got) == len(rows)
    for k, vs in seqs.items():
        for i, want in enumerate(fold(vs, alpha)):
            have = got[(k, i)]
            assert (have is None) == (want is None), (k, i)
            if want is not None:
                assert math.isclose(have, want, rel_tol=1e-9, abs_tol=1e-9), (k, i, have, want)


def test_ewma_runs_no_python(spark):
    df = spark.range(10).select(F.lit(1).alias("asset_id"), F.lit("s").alias("sensor"), F.col("id").alias("event_id"),
                                F.timestamp_seconds("id").alias("ts"), F.col("id").cast("double").alias("value"))
    plan = ewma(df, "value")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


POINTS = "id long, k string, ts timestamp, tag string"
SPANS = "k string, start timestamp, end timestamp, name string, tag string, n int"


@pytest.mark.parametrize("split_above", [1_000_000, None])
def test_asof_tag_equals_brute_force(spark, split_above):
    t = lambda h: None if h is None else __import__("datetime").datetime(2024, 1, 1) + __import__("datetime").timedelta(hours=h)
    rnd = random.Random(8)
    spans = [("a", t(-9000), t(5), "past", "x", 1), ("a", t(5), t(9), "next", "x", 2), ("a", t(20), t(20), "empty", "x", 3),
             ("a", t(30), None, "open", "x", 4), ("b", t(3), t(4), "b", "x", 5), (None, t(0), t(50), "null key", "x", 6),
             ("a", None, t(7), "no start", "x", 7), ("c", t(1), t(2), "short", "x", 8), ("c", t(1), t(3), "long", "x", 9)]
    points = [(i, rnd.choice(["a", "b", "c", None]), t(rnd.uniform(-3, 45)), "own") for i in range(300)]
    points += [(900 + i, "a", t(h), "own") for i, h in enumerate([5, 9, 20, 30, None])] + [(900, "a", t(5), "own")]
    got = TL.asof_tag(spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS), ("k",), split_above=split_above)
    assert got.columns == ["id", "k", "ts", "tag", "name", "n"]
    live = [s for s in spans if s[1] is not None and (s[2] is None or s[2] > s[1])]

    def tag(k, at):
        if at is None:
            return None, None
        last = max(((s[1], s[2] or t(10**5), s) for s in live if s[0] == k and s[1] <= at), default=None, key=lambda x: x[:2])
        return (None, None) if last is None or at >= last[1] else (last[2][3], last[2][5])

    want = sorted((i, *tag(k, at)) for i, k, at, _ in points)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["id"], r["name"], r["n"]) for r in got.collect()), key=key) == sorted(want, key=key)
    none = TL.asof_tag(spark.createDataFrame(points, POINTS), spark.createDataFrame([], SPANS), ("k",))
    assert none.filter("name is null").count() == len(points)


def test_long_intervals_are_one_row_each(spark):
    """Rows of the window are points plus intervals, whatever the length of these."""
    points = spark.range(1000).select("id", F.timestamp_seconds(F.col("id") * 3600).alias("ts"))
    iv = spark.sql("select timestamp'1970-01-01' start, timestamp'2070-01-01' end, 'century' name")
    out = TL.asof_tag(points, iv)
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.filter("name = 'century'").count() == 1000


@pytest.mark.parametrize("split_above", [1_000_000, None])
def test_silences(spark, split_above):
    day = 86400
    ticks = [(1, "a", 3), (1, "a", 3), (1, "a", 4), (1, "a", day + 9), (1, "b", 0), (1, "b", 20), (2, "a", 7), (9, "zz", 5), (1, "a", 99 * day)]
    expected = [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (2, "b")]
    out = TL.silences(spark.createDataFrame(ticks, "asset_id long, sensor string, tick long"),
                      spark.createDataFrame(expected, "asset_id long, sensor string"), 0, day + 10, ("asset_id", "sensor"), split_above)
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, "a", 0, 2, 3), (1, "a", 5, day + 8, day + 4), (1, "a", day + 10, day + 10, 1), (1, "b", 1, 19, 19),
                   (1, "b", 21, day + 10, day - 10), (2, "a", 0, 6, 7), (2, "a", 8, day + 10, day + 3), (2, "b", 0, day + 10, day + 11)]


def test_missing_per_tick(spark):
    silent = spark.createDataFrame([(1, "a", 0, 2, 3), (1, "b", 2, 2, 1)], "asset_id long, sensor string, from_tick long, to_tick long, n_missing long")
    got = sorted(tuple(r) for r in TL.missing_per_tick(silent, ("asset_id", "sensor"), ("asset_id",)).collect())
    assert got == [(0, 1, 1, "a"), (1, 1, 1, "a"), (2, 1, 2, "a,b")]


def test_array_logs_are_split_by_bytes(spark, tmp_path):
    """One file is read by several tasks; entries are whole wherever a block ends, and nothing in a text ends an entry."""
    import json

    from skyvane.sources import files as FS
    rnd = random.Random(6)
    nasty = ["},\n    {", "a\n    },", "[", "]", "\"", "\\", "é🤦", "\n]", "}\n    },\n    {"]
    entries = [{"timestamp": i / 8, "value": {"k": i, "s": rnd.choice(nasty), "in": {"deep": {"er": rnd.choice(nasty)}}, "l": [1, {"x": 2}]}}
               for i in range(3000)]
    (tmp_path / "flap.json").write_text(json.dumps(entries, indent=4))
    (tmp_path / "slat_faulty.json").write_text(json.dumps(entries[:1], indent=4))
    (tmp_path / "spar.json").write_text("[]")
    (tmp_path / "node.json").write_text(json.dumps(entries[1:3], indent=4, ensure_ascii=False) + "\n")
    (tmp_path / "none.json").write_text("")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("20000", "7777", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            df = FS.read_sensor_logs(spark, str(tmp_path), indent=4)
            if size != "128m":
                assert df.rdd.getNumPartitions() > 20
            got = sorted((r["sensor"], r["is_faulty"], r["timestamp"], r["value"]) for r in df.collect())
            want = [("flap", False, e) for e in entries] + [("slat", True, entries[0])] + [("node", False, e) for e in entries[1:3]]
            assert sorted((s, f, t) for s, f, t, _ in got) == sorted((s, f, e["timestamp"]) for s, f, e in want)
            assert all(json.loads(v) == entries[int(t * 8)]["value"] for _, _, t, v in got)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_array_logs_round_trip(spark, tmp_path):
    from skyvane.sources import files as FS
    rows = [("flap", 2.0, '{"a":1}'), ("flap", 1.5, '{"a":{"b":"},"}}'), ("slat", 1.0, "{}"), ("slat", None, "{}"), ("slat", 3.0, None)]
    FS.write_sensor_arrays(spark.createDataFrame(rows, "sensor string, timestamp double, value string"), str(tmp_path / "logs"))
    for indent in (4, None):
        df = FS.read_sensor_logs(spark, str(tmp_path / "logs"), indent=indent, pattern=r"/sensor=(\w+?)(_faulty)?/", of="file_path")
        assert sorted(tuple(r) for r in df.collect()) == [("flap", False, 1.5, '{"a":{"b":"},"}}'), ("flap", False, 2.0, '{"a":1}'),
                                                          ("slat", False, 1.0, "{}")]
