"""Lookups, joins and filters (JON1-JON6, FIL1-FIL8, PRJ13-PRJ15, PRJ25-PRJ26).

Lookup tables are bounded by sensors x phases x features and are broadcast;
the readings side is never shuffled for them. The range join (JON6) buckets
both sides on a time grain and equi-joins on the bucket, so it never becomes
a nested-loop join; Spark picks the join by the measured sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

def with_threshold(df: DataFrame, thresholds: DataFrame, score: str = "prediction") -> DataFrame:
    """JON1 + FIL2: per-sensor threshold (default 1.0) and the strict ``>`` flag."""
    t = F.broadcast(thresholds.select("sensor", "threshold"))
    out = df.join(t, "sensor", "left")
    thr = F.coalesce(F.col("threshold"), F.lit(S.DEFAULT_THRESHOLD))
    return out.withColumn("threshold", thr).withColumn("flagged", F.col(score) > thr)


def global_alerts(df: DataFrame, cutoff: float = 0.8, score: str = "prediction") -> DataFrame:
    """FIL1: one global cut-off on the score."""
    return df.filter(F.col(score) > F.lit(cutoff))


def alert_messages(flagged: DataFrame, payload: Column) -> DataFrame:
    """PRJ15 + SNK2 shape: alert rows for flagged readings."""
    return flagged.filter(F.col("flagged")).select(
        F.col("event_id"), F.col("asset_id"),
        F.col("timestamp"), F.col("sensor"),
        F.col("prediction").cast("double").alias("prediction"),
        payload.alias("value"),
        F.concat(F.lit("Anomaly detected in "), F.col("sensor")).alias("message"),
    )


def learnable(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """FIL4: learn from normal data only; a missing flag counts as normal."""
    return df.filter(~F.coalesce(F.col(flag), F.lit(False)))


def known_sensors(df: DataFrame, sensors: DataFrame) -> DataFrame:
    """FIL5 + JON5: keep rows whose sensor has a model (left semi join)."""
    return df.join(F.broadcast(sensors.select("sensor")), "sensor", "left_semi")


def update_messages(windows: DataFrame, allowed: DataFrame,
                    features: Sequence[str] = S.EVENT_FEATURES,
                    extra_keys: Sequence[str] = ()) -> DataFrame:
    """PRJ13 + PRJ14 + JON3 + FIL3: model-update messages from window rows.

    ``allowed`` is (sensor, feature); it is collapsed to one array per sensor
    (bounded by the sensor table) and broadcast. Features are kept when allowed
    for the sensor and not NULL; updates without features are dropped.
    """
    per_sensor = allowed.groupBy("sensor").agg(F.collect_set("feature").alias("allowed"))
    j = windows.join(F.broadcast(per_sensor), "sensor", "left")
    all_feats = F.create_map(*[x for f in features for x in (F.lit(f), F.col(f).cast("double"))])
    keep = F.map_filter(all_feats, lambda k, v: F.array_contains(
        F.coalesce(F.col("allowed"), F.array().cast("array<string>")), k) & v.isNotNull())
    msg = j.select(
        *extra_keys,
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("sensor"),
        F.coalesce(F.col("score"), F.lit(0.0)).alias("score"),
        F.coalesce(F.col("is_anomaly"), F.lit(False)).alias("is_anomaly"),
        F.col("phase"),
        keep.alias("features"),
    )
    return msg.filter(F.size("features") > 0)


def update_json(msgs: DataFrame) -> DataFrame:
    """PRJ12: update messages as JSON text (one column ``value``)."""
    return msgs.select(F.to_json(F.struct(*msgs.columns),
                                 {"ignoreNullFields": "false"}).alias("value"))


def limits_wide(limits: DataFrame, features: Sequence[str] = S.EVENT_FEATURES) -> DataFrame:
    """Phase-limit table pivoted to one row per (sensor, phase) with
    ``lo_<f>``/``hi_<f>`` columns; bounded by sensors x phases."""
    aggs = []
    for f in features:
        aggs += [F.max(F.when(F.col("feature") == f, F.col("lo"))).alias(f"lo_{f}"),
                 F.max(F.when(F.col("feature") == f, F.col("hi"))).alias(f"hi_{f}")]
    return limits.groupBy("sensor", "phase").agg(*aggs)


def limits_check(df: DataFrame, limits: DataFrame,
                 features: Sequence[str] = S.EVENT_FEATURES) -> DataFrame:
    """JON4 + DET1 + PRJ25 + PRJ26: readings against healthy ranges by phase.

    Adds ``warnings`` (space-separated, ``✅`` when none), ``faults`` count,
    ``status`` (``DEGRADED``/``NORMAL``) and ``recommendation``.
    """
    j = df.join(F.broadcast(limits_wide(limits, features)), ["sensor", "phase"], "left")
    labels = []
    for f in features:
        v, lo, hi = F.col(f), F.col(f"lo_{f}"), F.col(f"hi_{f}")
        labels.append(F.when(v < lo, F.lit(f"LOW_{f.upper()}")))
        labels.append(F.when(v > hi, F.lit(f"HIGH_{f.upper()}")))
    faults = F.filter(F.array(*labels), lambda x: x.isNotNull())
    n = F.size(faults)
    return j.select(
        *df.columns,
        F.when(n > 0, F.array_join(faults, " ")).otherwise(F.lit("✅")).alias("warnings"),
        n.alias("faults"),
        F.when(n > 0, F.lit("DEGRADED")).otherwise(F.lit("NORMAL")).alias("status"),
        F.when(n > 0, F.lit("Inspect sensor")).otherwise(F.lit("No action")).alias("recommendation"),
    )


def acceptance_box(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> Column:
    """FIL7: true when every listed feature lies within its [lo, hi]."""
    conds = [F.col(f).between(lo, hi) for f, (lo, hi) in bounds.items()]
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return F.coalesce(out, F.lit(False))


def phase_intervals(spark: SparkSession, points: DataFrame, time_col: str = "ts") -> DataFrame:
    """Phase timeline (phase, start, end) covering the days spanned by ``points``.

    Built from a two-value aggregate (min/max day), ``sequence`` over the days
    and an inline array of the phase hours: three rows per day, no join.
    """
    span = points.agg(F.to_date(F.min(time_col)).alias("d0"), F.to_date(F.max(time_col)).alias("d1"))
    days = span.select(F.explode(F.sequence("d0", "d1")).alias("day"))
    hours = F.array(*[F.struct(F.lit(name).alias("phase"), F.lit(lo).alias("h0"),
                               F.lit(hi).alias("h1")) for name, lo, hi in S.PHASE_HOURS])
    day_ts = F.col("day").cast("timestamp_ntz")
    return days.select(day_ts.alias("d"), F.inline(hours)).select(
        "phase",
        (F.col("d") + F.make_dt_interval(F.lit(0), F.col("h0"))).alias("start"),
        (F.col("d") + F.make_dt_interval(F.lit(0), F.col("h1"))).alias("end"),
    )


def range_join(points: DataFrame, intervals: DataFrame, time_col: str = "ts",
               bucket: str = "1 hour", how: str = "left") -> DataFrame:
    """JON6: tag each point with the interval ``start <= t < end``; a point
    outside every interval keeps NULL tags (``how="inner"`` leaves it out).

    Both sides get a time bucket; each interval is exploded into the buckets it
    overlaps, and the join is an equi-join on the bucket plus the range test.
    The exploded side's size decides between broadcast and shuffle at run time.
    """
    seconds = {"1 hour": 3600, "1 day": 86400, "1 minute": 60}[bucket]

    def bucket_of(c: Column) -> Column:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.floor(F.timestamp_diff("SECOND", epoch, c) / F.lit(seconds))

    iv = intervals.select(
        *[F.col(c) for c in intervals.columns],
        F.explode(F.sequence(bucket_of(F.col("start")),
                             bucket_of(F.col("end") - F.expr("INTERVAL 1 MICROSECOND"))))
        .alias("_ib"))
    iv = iv.select(*[F.col(c).alias(f"_iv_{c}") for c in iv.columns])
    p = points.withColumn("_pb", bucket_of(F.col(time_col)))
    cond = ((F.col("_pb") == F.col("_iv__ib")) & (F.col(time_col) >= F.col("_iv_start"))
            & (F.col(time_col) < F.col("_iv_end")))
    joined = p.join(iv, cond, how)
    renamed = [F.col(f"_iv_{c}").alias(c) for c in intervals.columns if c not in points.columns]
    return joined.select(*[F.col(c) for c in points.columns], *renamed)
