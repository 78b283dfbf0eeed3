"""Phase-aware gated EWMA anomaly model (STA2-STA5) as a Spark fold.

Per (asset, sensor, phase) the model keeps, for every feature, a running
mean and the last value seen while a mean existed. Each row is either

* a reading (``kind`` = 1): predict -> threshold -> learn (STA4):
  - no state yet for the phase: score 0 and nothing else;
  - else for every feature with a mean: ``|v−mean|/(|mean|+1e-6)·weight``
    plus ``0.5·|v−prev|/(|prev|+1e-6)`` when a prev exists; prev := v;
  - score = mean of those errors over matched features (0 if none), capped at 10;
  - anomaly = score > threshold(sensor) (strict);
  - learn only when not anomalous: mean := α·v + (1−α)·mean (insert if absent);
* a model update (``kind`` = 0): ``mean := 0.8·mean + 0.2·v`` (insert if
  absent), the feedback blend (STA5). Updates sort before readings at equal
  time.

Batch runs use :func:`skyvane.operators.fold.sorted_fold`, or for keys too
large for one task :func:`skyvane.operators.chunked.chunked_fold`; streams
use the same step inside ``transformWithStateInPandas``
(:mod:`skyvane.streaming.model_state`).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .chunked import chunked_fold
from .fold import Fold, sorted_fold

MODEL_KEYS = ("asset_id", "sensor", "phase")
MODEL_ORDER = ("ts", "kind", "event_id")
READING, UPDATE = 1, 0


def model_step(features: Sequence[str], weights: dict[str, float] | None, alpha: float = 0.2,
               cap: float = 10.0, feedback: float = 0.2):
    """The vectorised fold step. State: ``hp`` (phase seen, 0/1), ``m_<f>``,
    ``p_<f>`` (NaN = absent). Inputs: ``kind``, ``threshold``, ``x_<f>`` and, without
    ``weights``, each row's own weights ``w_<f>``."""
    w = [None if weights is None else weights.get(f, S.DEFAULT_WEIGHT) for f in features]

    def step(st, xs):
        kind, thr = xs["kind"], xs["threshold"]
        is_reading = kind == READING
        hp = st["hp"] == 1.0
        total = np.zeros_like(thr)
        count = np.zeros_like(thr)
        new = dict(st)
        for f, wt in zip(features, w):
            v, m, p = xs[f"x_{f}"], st[f"m_{f}"], st[f"p_{f}"]
            matched = is_reading & hp & ~np.isnan(v) & ~np.isnan(m)
            with np.errstate(invalid="ignore", divide="ignore"):
                err = np.abs(v - m) / (np.abs(m) + 1e-6) * (xs[f"w_{f}"] if wt is None else wt)
                trend = 0.5 * (np.abs(v - p) / (np.abs(p) + 1e-6))
            err = np.where(np.isnan(p), err, err + trend)
            total = np.where(matched, total + err, total)
            count = count + matched
            new[f"p_{f}"] = np.where(matched, v, p)
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where(count > 0, total / np.maximum(count, 1), 0.0)
        score = np.minimum(score, cap)
        anomaly = score > thr
        learn = is_reading & ~anomaly
        for f in features:
            v, m = xs[f"x_{f}"], st[f"m_{f}"]
            has_v = ~np.isnan(v)
            ewma = np.where(np.isnan(m), v, alpha * v + (1 - alpha) * m)
            blend = np.where(np.isnan(m), v, (1 - feedback) * m + feedback * v)
            upd = np.where(learn & has_v, ewma, m)
            new[f"m_{f}"] = np.where(~is_reading & has_v, blend, upd)
        new["hp"] = np.where(learn | ~is_reading, 1.0, st["hp"])
        out = {
            "score": np.where(is_reading, score, np.nan),
            "is_anomaly": np.where(is_reading, anomaly.astype(float), np.nan),
        }
        for f in features:
            out[f"mean_{f}"] = new[f"m_{f}"]
        return new, out

    def rows(st, xs):
        # the step above in plain floats, for one key's rows
        hp = st["hp"] == 1.0
        means, prevs = [st[f"m_{f}"] for f in features], [st[f"p_{f}"] for f in features]
        values = zip(*[xs[f"x_{f}"].tolist() for f in features])
        weigh = repeat(w) if weights is not None else zip(*[xs[f"w_{f}"].tolist() for f in features])
        scores, anomalies, after = [], [], []
        for kind, thr, vs, wts in zip(xs["kind"].tolist(), xs["threshold"].tolist(), values, weigh):
            if kind == READING:
                total, count = 0.0, 0
                if hp:
                    for j, v in enumerate(vs):
                        m = means[j]
                        if v == v and m == m:
                            p = prevs[j]
                            err = abs(v - m) / (abs(m) + 1e-6) * wts[j]
                            if p == p:
                                err = err + 0.5 * (abs(v - p) / (abs(p) + 1e-6))
                            total, count = total + err, count + 1
                            prevs[j] = v
                score = total / count if count else 0.0
                score = cap if score > cap else score
                anomaly = score > thr
                scores.append(score)
                anomalies.append(float(anomaly))
                if not anomaly:
                    for j, v in enumerate(vs):
                        if v == v:
                            m = means[j]
                            means[j] = alpha * v + (1 - alpha) * m if m == m else v
                    hp = True
            else:
                for j, v in enumerate(vs):
                    if v == v:
                        m = means[j]
                        means[j] = (1 - feedback) * m + feedback * v if m == m else v
                hp = True
                scores.append(np.nan)
                anomalies.append(np.nan)
            after.append((1.0 if hp else 0.0, *means, *prevs))
        states = dict(zip(["hp", *[f"m_{f}" for f in features], *[f"p_{f}" for f in features]], np.array(after, dtype=float).T))
        return {"score": np.array(scores), "is_anomaly": np.array(anomalies), **{f"mean_{f}": states[f"m_{f}"] for f in features}}, states

    state = {"hp": 0.0, **{f"m_{f}": np.nan for f in features},
             **{f"p_{f}": np.nan for f in features}}
    outputs = {"score": "double", "is_anomaly": "boolean",
               **{f"mean_{f}": "double" for f in features}}
    inputs = ["kind", "threshold", *[f"x_{f}" for f in features],
              *([f"w_{f}" for f in features] if weights is None else [])]
    return Fold(inputs, state, outputs, step, passthrough=("event_id", "kind"), rows=rows)


def model_input(readings: DataFrame, features: Sequence[str] = S.EVENT_FEATURES,
                thresholds: dict[str, float] | None = None) -> DataFrame:
    """Readings in the fold's input shape (``kind`` = reading)."""
    thresholds = thresholds if thresholds is not None else S.all_thresholds()
    thr = F.coalesce(F.element_at(S.as_map_literal(thresholds), F.col("sensor")),
                     F.lit(S.DEFAULT_THRESHOLD))
    return readings.select(
        *MODEL_KEYS, "ts", F.lit(READING).alias("kind"), "event_id",
        thr.alias("threshold"), *[F.col(f).cast("double").alias(f"x_{f}") for f in features])


def update_input(updates: DataFrame, features: Sequence[str] = S.EVENT_FEATURES) -> DataFrame:
    """Update messages (``features`` map, ``effective_ts``) in the fold's input shape."""
    return updates.select(
        *MODEL_KEYS, F.col("effective_ts").alias("ts"), F.lit(UPDATE).alias("kind"),
        F.lit(-1).cast("long").alias("event_id"), F.lit(0.0).alias("threshold"),
        *[F.col("features").getItem(f).alias(f"x_{f}") for f in features])


def score(rows: DataFrame, features: Sequence[str] = S.EVENT_FEATURES,
          weights: dict[str, float] | None = None, alpha: float = 0.2,
          num_partitions: int | None = None, chunk: Column | None = None) -> DataFrame:
    """STA2-STA5 over model-input rows (readings, optionally unioned with updates).

    Returns one row per input row: keys, event_id, kind, score, is_anomaly and
    the means after the row. With ``chunk`` (a time bucket of ``ts``), keys
    too large for one task are folded in parallel chunks, exactly
    (:func:`skyvane.operators.chunked.chunked_fold`).
    """
    if weights is None and f"w_{features[0]}" not in rows.columns:
        weights = S.all_weights()
    fold = model_step(features, weights, alpha)
    if chunk is not None:
        return chunked_fold(rows, MODEL_KEYS, MODEL_ORDER, fold, chunk)
    return sorted_fold(rows, MODEL_KEYS, MODEL_ORDER, fold, num_partitions)
