"""Golden folds and properties of the gated EWMA model (STA2-STA5)."""

import random

import numpy as np
import pandas as pd
import pytest

from skyvane import schema as S
from skyvane.operators import fold as FD
from skyvane.operators import model as M

SCHEMA = ("asset_id long, sensor string, phase string, ts timestamp_ntz, kind int, "
          "event_id long, threshold double")


def _rows(spark, sensor, feats, items, phase="cruise"):
    """items: list of (kind, {feature: value})."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i, (kind, vals) in enumerate(items):
        rows.append((1, sensor, phase, t0 + dt.timedelta(seconds=i), kind, i,
                     S.all_thresholds().get(sensor, 1.0), *[vals.get(f) for f in feats]))
    schema = SCHEMA + "".join(f", x_{f} double" for f in feats)
    return spark.createDataFrame(rows, schema)


def _score(spark, sensor, feats, items, **kw):
    df = _rows(spark, sensor, feats, items)
    out = M.score(df, features=feats, **kw).orderBy("event_id").collect()
    return out


def _r(x):
    return None if x is None else round(x, 6)


def test_golden_fold_a_with_update(spark):
    R, U = M.READING, M.UPDATE
    items = [(R, {"accel_x": 0.10}), (R, {"accel_x": 0.11}), (R, {"accel_x": 0.40}),
             (R, {"accel_x": 0.12}), (U, {"accel_x": 0.20}), (R, {"accel_x": 0.13})]
    out = _score(spark, "accelerometer", ["accel_x"], items)
    assert [_r(o["score"]) for o in out] == [0.0, 0.099999, 4.23971, 0.526468, None, 0.08601]
    assert [o["is_anomaly"] for o in out] == [False, False, True, False, None, False]
    assert [_r(o["mean_accel_x"]) for o in out] == [0.1, 0.102, 0.102, 0.1056, 0.12448, 0.125584]


def test_golden_fold_b_weighted_feature(spark):
    items = [(M.READING, {"damping_ratio": v}) for v in (0.07, 0.06, 0.12)]
    out = _score(spark, "flutter", ["damping_ratio"], items)
    assert [_r(o["score"]) for o in out] == [0.0, 0.428565, 2.642818]
    assert [o["is_anomaly"] for o in out] == [False, True, True]
    assert [_r(o["mean_damping_ratio"]) for o in out] == [0.07, 0.07, 0.07]


def test_golden_fold_c_two_features(spark):
    feats = ["slat_actual", "tracking_error_deg"]
    items = [(M.READING, dict(zip(feats, v))) for v in ((10.0, 0.2), (10.5, 0.3), (10.0, 2.0))]
    out = _score(spark, "slat", feats, items)
    assert [_r(o["score"]) for o in out] == [0.0, 0.524997, 9.52439]
    assert [o["is_anomaly"] for o in out] == [False, False, True]
    assert [(_r(o["mean_slat_actual"]), _r(o["mean_tracking_error_deg"])) for o in out] == \
        [(10.0, 0.2), (10.1, 0.22), (10.1, 0.22)]


def test_constant_series_scores_zero_and_scores_are_bounded(spark):
    items = [(M.READING, {"value": 5.0})] * 20
    assert all(o["score"] == 0.0 for o in _score(spark, "click", ["value"], items))
    rnd = random.Random(7)
    items = [(M.READING, {"value": rnd.choice([0.001, 1000.0, 3.0])}) for _ in range(60)]
    assert all(0.0 <= o["score"] <= 10.0 for o in _score(spark, "click", ["value"], items))


def test_anomalous_readings_leave_means_unchanged(spark):
    items = [(M.READING, {"value": v}) for v in (1.0, 1.0, 50.0, 1.0)]
    out = _score(spark, "click", ["value"], items)
    assert out[2]["is_anomaly"] and out[2]["mean_value"] == out[1]["mean_value"]


def test_input_permutation_and_batching_do_not_change_results(spark):
    rnd = random.Random(3)
    rows = []
    import datetime as dt
    for key in range(30):
        for i in range(rnd.randint(1, 40)):
            rows.append((key, "click", "cruise", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i),
                         M.READING, key * 1000 + i, 0.8, rnd.uniform(1, 3)))
    df = spark.createDataFrame(rows, SCHEMA + ", x_value double")
    base = {r["event_id"]: (r["score"], r["mean_value"])
            for r in M.score(df, features=["value"], num_partitions=1).collect()}
    rnd.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df2 = spark.createDataFrame(rows, SCHEMA + ", x_value double").repartition(5)
        other = {r["event_id"]: (r["score"], r["mean_value"])
                 for r in M.score(df2, features=["value"], num_partitions=3).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert base == other


def test_ewma_alpha_one_is_last_value(spark):
    import datetime as dt
    vals = [3.0, 1.0, 4.0, 1.5]
    df = spark.createDataFrame(
        [(1, "s", dt.datetime(2024, 1, 1, 0, i), i, v) for i, v in enumerate(vals)],
        "asset_id long, sensor string, ts timestamp_ntz, event_id long, value double")
    out = FD.sorted_fold(df, ["asset_id", "sensor"], ["ts", "event_id"],
                         FD.ewma_fold("value", 1.0, passthrough=("event_id",)))
    assert [r["ewma"] for r in out.orderBy("event_id").collect()] == vals


def _random_rows(n: int, seed: int, features: int):
    rng = np.random.default_rng(seed)
    xs = {f"x_f{i}": np.where(rng.random(n) < 0.3, np.nan, 10 + rng.normal(0, 4, n)) for i in range(features)}
    xs["x_f0"][n // 2:n // 2 + 3] = [np.inf, -np.inf, 0.0]
    ws = {f"w_f{i}": rng.choice([1.0, 2.5], n) for i in range(features)}
    return {"kind": rng.choice([M.READING, M.READING, M.UPDATE], n).astype(float), "threshold": rng.choice([0.3, 1.5], n), **xs, **ws}


@pytest.mark.parametrize("weights", [None, {"f0": 2.0, "f2": 3.0}])
def test_plain_float_walk_equals_array_step_bit_for_bit(weights):
    """Few keys are walked in plain floats: same outputs, same states, and far fewer numpy calls than rows."""
    fold = M.model_step(["f0", "f1", "f2"], weights)
    xs = _random_rows(400, 3, 3)
    pdf = pd.DataFrame({"key": np.repeat([1, 2], [300, 100]), **xs})
    calls = []
    counted = FD.Fold(fold.inputs, fold.state, fold.outputs, lambda st, x: calls.append(1) or fold.step(st, x), (), fold.rows)
    stepped = FD.Fold(fold.inputs, fold.state, fold.outputs, fold.step)
    want, end, _ = FD.fold_frame(pdf, ["key"], stepped)
    got, last, _ = FD.fold_frame(pdf, ["key"], counted)
    assert not calls
    for a, b in ((want, got), (end, last)):
        assert list(a) == list(b)
        for c in a:
            assert np.array_equal(a[c], b[c], equal_nan=True), c


def test_walk_takes_over_when_few_keys_are_left():
    fold = M.model_step(["f0"], None)
    sizes = [200, 7] + [3] * 60
    pdf = pd.DataFrame({"key": np.repeat(np.arange(len(sizes)), sizes), **_random_rows(sum(sizes), 4, 1)})
    calls = []
    counted = FD.Fold(fold.inputs, fold.state, fold.outputs, lambda st, x: calls.append(1) or fold.step(st, x), (), fold.rows)
    got, last, _ = FD.fold_frame(pdf, ["key"], counted)
    want, end, _ = FD.fold_frame(pdf, ["key"], FD.Fold(fold.inputs, fold.state, fold.outputs, fold.step))
    assert len(calls) == 3
    assert all(np.array_equal(want[c], got[c], equal_nan=True) for c in want)
    assert all(np.array_equal(end[c], last[c], equal_nan=True) for c in end)
