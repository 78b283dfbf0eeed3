"""The speculative chunked fold equals the sequential fold exactly."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyvane import schema as S
from skyvane.operators import chunked as CH
from skyvane.operators import fold as FD
from skyvane.operators import model as M

SCHEMA = ("asset_id long, sensor string, phase string, ts timestamp_ntz, kind int, "
          "event_id long, threshold double, x_value double, x_k double")


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    out, eid = [], 0
    t0 = dt.datetime(2024, 1, 1)
    # one hot key (most rows, many chunks), a few small keys, and update rows
    for asset, n in ((1, 3000), (2, 40), (3, 3), (4, 1)):
        t = t0
        for _ in range(n):
            t += dt.timedelta(minutes=rnd.choice([1, 7, 60, 400]))
            eid += 1
            kind = M.UPDATE if rnd.random() < 0.03 else M.READING
            base = 10.0 if rnd.random() < 0.9 else rnd.uniform(0, 60)
            out.append((asset, "click", "cruise", t, kind, -eid if kind == M.UPDATE else eid,
                        0.8, base + rnd.uniform(-0.3, 0.3), float(rnd.randint(1, 3))))
    return spark.createDataFrame(out, SCHEMA)


def _as_dict(df, key="event_id"):
    return {r[key]: tuple(r) for r in df.collect()}


@pytest.mark.parametrize("prefix", [1, 4, 256])
def test_model_chunked_equals_sequential(spark, rows, prefix):
    fold = M.model_step(list(S.EVENT_FEATURES), S.all_weights())
    want = FD.sorted_fold(rows, M.MODEL_KEYS, M.MODEL_ORDER, fold)
    got = CH.chunked_fold(rows, M.MODEL_KEYS, M.MODEL_ORDER, fold,
                          F.date_trunc("day", F.col("ts")), prefix=prefix, split_above=20)
    assert got.columns == want.columns
    assert _as_dict(got) == _as_dict(want)


def test_simple_folds_chunked_equal_sequential(spark, rows):
    r = rows.withColumn("timestamp", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6) \
            .withColumn("limit", F.lit(0.5))
    keys, order = ["asset_id", "sensor"], ["ts", "event_id"]
    for fold in (FD.ewma_fold("x_value", passthrough=("event_id",)),
                 FD.slew_fold("x_value", 2.0, passthrough=("event_id",)),
                 FD.smoothing_fold("x_value", 0.7, 0.5, 0.0, 30.0, 0.0, passthrough=("event_id",)),
                 FD.violation_fold("x_value", "timestamp", "limit", 3, passthrough=("event_id",))):
        want = FD.sorted_fold(r, keys, order, fold)
        got = CH.chunked_fold(r, keys, order, fold, F.date_trunc("day", F.col("ts")), prefix=64,
                              split_above=0)
        assert _as_dict(got) == _as_dict(want)


def test_unsplit_keys_need_no_resolution(spark, rows):
    fold = M.model_step(list(S.EVENT_FEATURES), S.all_weights())
    want = FD.sorted_fold(rows, M.MODEL_KEYS, M.MODEL_ORDER, fold)
    got = CH.chunked_fold(rows, M.MODEL_KEYS, M.MODEL_ORDER, fold,
                          F.date_trunc("day", F.col("ts")), prefix=8)
    assert _as_dict(got) == _as_dict(want)


def test_chunks_by_rate_equal_sequential(spark, rows):
    fold = M.model_step(list(S.EVENT_FEATURES), S.all_weights())
    want = FD.sorted_fold(rows, M.MODEL_KEYS, M.MODEL_ORDER, fold)
    got = CH.chunked_fold(rows, M.MODEL_KEYS, M.MODEL_ORDER, fold, prefix=16, split_above=20, chunk_rows=150)
    assert _as_dict(got) == _as_dict(want)


def test_locked_gate_settles_in_rounds(spark):
    """A level shift locks the gate: nothing converges in the first round, the next one settles
    the rest, and no task folds more than a chunk."""
    t0 = dt.datetime(2024, 1, 1)
    out = [(None, "click", "cruise", t0 + dt.timedelta(seconds=30 * i), M.READING, i, 0.8,
            10.0 + (i % 7) * 0.01 if i < 400 else 500.0 + (i % 5), 1.0) for i in range(6000)]
    df = spark.createDataFrame(out, SCHEMA)
    fold = M.model_step(list(S.EVENT_FEATURES), S.all_weights())
    want = FD.sorted_fold(df, M.MODEL_KEYS, M.MODEL_ORDER, fold)
    rounds = []
    got = CH.chunked_fold(df, M.MODEL_KEYS, M.MODEL_ORDER, fold, prefix=32, split_above=100, chunk_rows=500, rounds=rounds)
    assert _as_dict(got) == _as_dict(want)
    assert 1 < len(rounds) <= 4 and rounds[-1] == 0


def test_resolving_makes_few_array_steps(spark):
    """A chunk's first rows are walked in plain floats, not one array step per row."""
    n = 200
    fold = M.model_step(["f0"], None)
    calls = []
    fold = FD.Fold(fold.inputs, fold.state, fold.outputs, lambda st, x: calls.append(1) or fold.step(st, x), (), fold.rows)
    xs = {"kind": np.ones(n), "threshold": np.full(n, 0.8), "x_f0": np.full(n, 500.0), "w_f0": np.ones(n)}
    spec = FD.fold_frame(pd.DataFrame({"k": 1, **xs}), ["k"], CH._speculative(fold, []))[0]
    head = pd.DataFrame({"k": 1, CH.CHUNK: 1, "_tag": 0, "_pos": np.arange(1.0, n + 1), **xs,
                         **{f"_st_{f}": spec[f"_st_{f}"] for f in fold.state}})
    ends = pd.DataFrame({"k": 1, CH.CHUNK: [0, 1], "_tag": 1, "_len": float(n), "_fin_hp": 1.0, "_fin_m_f0": 10.0, "_fin_p_f0": 10.0})
    rows = pd.concat([ends[:1], head, ends[1:]], ignore_index=True)
    got = pd.concat(CH._resolve(iter([rows]), ["k"], ["_pos"], fold, 256))
    assert not calls
    assert list(got["_pos"]) == list(range(1, n + 1)) and got["is_anomaly"].all() and (got["mean_f0"] == 10.0).all()
