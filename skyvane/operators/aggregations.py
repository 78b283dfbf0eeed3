"""Event-time window aggregates (AGG1-AGG8, PRJ11).

All of them are hash aggregates with a partial (map-side) step before the
shuffle, so the shuffle carries one row per group and partition, not one per
reading. Group keys always include a window or an asset, never a bare sensor
name, so no single group holds a large share of the data after the partial
step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def window_rows(df: DataFrame, duration: str, keys: Sequence[str] = ("sensor", "phase"),
                features: Sequence[str] = S.EVENT_FEATURES, time_col: str = "event_time",
                agg: str = "max") -> DataFrame:
    """AGG2 + AGG3 + PRJ11: tumbling window by keys; per-feature ``max`` (or
    ``avg``, AGG7), ``max(prediction) AS score``, ``bool_or(is_anomaly)``.

    The output ``timestamp`` is the window start; the window struct is dropped.
    """
    fn = {"max": F.max, "avg": F.avg, "min": F.min}[agg]
    grouped = df.groupBy(F.window(F.col(time_col), duration).alias("window"), *keys)
    out = grouped.agg(
        *[fn(f).alias(f) for f in features],
        F.max("prediction").alias("score"),
        F.bool_or("is_anomaly").alias("is_anomaly"),
    )
    return out.select(F.col("window.start").alias("timestamp"), *keys, *features,
                      "score", "is_anomaly")


def wide_window(df: DataFrame, duration: str, sensors: Sequence[str] = S.EVENT_SENSORS,
                features: Sequence[str] = S.EVENT_FEATURES, time_col: str = "event_time",
                keys: Sequence[str] = ()) -> DataFrame:
    """AGG1: one row per window, one column per (sensor, feature) — a
    sensor-gated pivot ``max(CASE WHEN sensor = s THEN f END)`` — plus
    ``max(prediction)``. The column list is fixed by the sensor table, so no
    distinct-values pass is needed (unlike ``pivot()`` without values).
    """
    cols = [F.max(F.when(F.col("sensor") == s, F.col(f))).alias(f"{s}_{f}")
            for s in sensors for f in features]
    out = (df.groupBy(F.window(F.col(time_col), duration).alias("window"), *keys)
             .agg(*cols, F.max("prediction").alias("prediction")))
    return out.select(F.col("window.start").alias("timestamp"), *keys,
                      *[f"{s}_{f}" for s in sensors for f in features], "prediction")


def health_report(df: DataFrame, unit: Sequence[str] = ("asset_id", "sensor"),
                  max_anomaly_share: float = 0.25) -> DataFrame:
    """AGG5: count of healthy and faulty sensor units and which sensor types
    they are. A unit is faulty when more than ``max_anomaly_share`` of its
    readings were flagged. The type list is bounded by the sensor table.
    """
    per_unit = df.groupBy(*unit).agg(
        F.avg(F.col("is_anomaly").cast("double")).alias("anomaly_share"))
    labelled = per_unit.withColumn("is_faulty", F.col("anomaly_share") > F.lit(max_anomaly_share))
    return labelled.groupBy("is_faulty").agg(
        F.count(F.lit(1)).alias("n_units"),
        F.concat_ws(",", F.array_sort(F.collect_set("sensor"))).alias("sensor_types"),
    )


def completeness(df: DataFrame, duration: str, expected: Sequence[str] = S.EVENT_SENSORS,
                 keys: Sequence[str] = ("asset_id",), time_col: str = "event_time") -> DataFrame:
    """AGG8: readings and distinct sensors per window and key against the
    expected sensor set; the missing sensors as sorted text. The distinct count
    is the size of the collected set, so one shuffle serves both.
    """
    out = (df.groupBy(F.window(F.col(time_col), duration).alias("window"), *keys)
             .agg(F.count(F.lit(1)).alias("n_readings"),
                  F.collect_set("sensor").alias("seen")))
    expected_arr = F.array(*[F.lit(s) for s in sorted(expected)])
    return out.select(
        F.col("window.start").alias("timestamp"), *keys, "n_readings",
        F.size("seen").cast("long").alias("n_sensors"),
        F.lit(len(expected)).alias("n_expected"),
        F.concat_ws(",", F.array_sort(F.array_except(expected_arr, F.col("seen")))).alias("missing"),
    )


def phase_durations(runs: DataFrame, keys: Sequence[str] = ("asset_id", "sensor")) -> DataFrame:
    """AGG6: ticks and duration of every phase run (input from
    :func:`skyvane.operators.ordered.phase_runs`)."""
    return runs.groupBy(*keys, "run_id", "phase").agg(
        F.count(F.lit(1)).alias("n_ticks"),
        F.min("timestamp").alias("start_ts"),
        F.max("timestamp").alias("end_ts"),
        (F.max("timestamp") - F.min("timestamp")).alias("duration_s"),
    )


def weighted_error(df: DataFrame, baseline: DataFrame, weights: dict[str, float] | None = None,
                   features: Sequence[str] = S.EVENT_FEATURES) -> DataFrame:
    """AGG4 + JON2: mean over matched features of
    ``|v - mean| / (|mean| + 1e-6) * weight``, 0 when no feature matches.

    ``baseline`` has one row per (sensor, phase) found in the data and one
    ``mean_<f>`` column per feature; Spark picks the join by its size. The
    average is a row-wise expression, so there is no explode.
    """
    weights = weights if weights is not None else S.all_weights()
    joined = df.join(baseline, ["sensor", "phase"], "left")
    terms: list[Column] = []
    hits: list[Column] = []
    for f in features:
        mean = F.col(f"mean_{f}")
        w = F.lit(weights.get(f, S.DEFAULT_WEIGHT))
        ok = F.col(f).isNotNull() & mean.isNotNull()
        terms.append(F.when(ok, F.abs(F.col(f) - mean) / (F.abs(mean) + F.lit(1e-6)) * w)
                      .otherwise(F.lit(0.0)))
        hits.append(ok.cast("int"))
    total = sum(terms[1:], terms[0])
    n = sum(hits[1:], hits[0])
    return joined.withColumn("n_matched", n).withColumn(
        "weighted_error", F.when(n > 0, total / n).otherwise(F.lit(0.0)))


def phase_baseline(df: DataFrame, features: Sequence[str] = S.EVENT_FEATURES) -> DataFrame:
    """Per (sensor, phase) feature means of whatever sensors the data has: the
    batch-trained baseline for AGG4."""
    return df.groupBy("sensor", "phase").agg(*[F.avg(f).alias(f"mean_{f}") for f in features])
