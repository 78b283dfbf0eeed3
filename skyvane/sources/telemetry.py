"""Telemetry derived from the ``events`` table.

``event_type`` is the sensor, ``user_id`` the asset, the hour of day the
flight phase, ``value`` and ``props.k`` the two features, and ``value / 100``
the score the edge attached. Two shapes are produced:

* :func:`readings` — typed columns straight from parquet (column pruning and
  filter pushdown reach the scan; no JSON on the hot path);
* :func:`envelope_records` — the same readings serialised as JSON messages,
  the wire format a stream source delivers, for the decode path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(ts: Column) -> Column:
    """Epoch seconds (double) of a TIMESTAMP_NTZ, independent of session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts) / F.lit(1e6)


def phase_of(ts: Column) -> Column:
    h = F.hour(ts)
    expr = None
    for name, lo, hi in S.PHASE_HOURS:
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def threshold_of(sensor: Column) -> Column:
    """Per-sensor anomaly threshold from a literal map (15 entries), default 1.0."""
    return F.coalesce(F.element_at(S.as_map_literal(S.all_thresholds()), sensor),
                      F.lit(S.DEFAULT_THRESHOLD))


def score_prefilter(cutoff: float) -> Column:
    """A scan-level predicate implied by ``prediction > cutoff``.

    The edge score is ``value / scale``, a computed column Catalyst cannot push
    into parquet. ``value > cutoff·scale·(1 − 1e-9)`` is a plain column
    comparison (pushed, row groups skipped by min/max) and is implied by the
    score test despite division rounding, so it never drops a qualifying row;
    the exact test still runs after it.
    """
    if cutoff <= 0:
        return F.lit(True)
    return F.col("value") > F.lit(cutoff * S.PREDICTION_SCALE * (1 - 1e-9))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed reading per event."""
    prepare(spark)
    e = table(spark, sf_dir, "events")
    sensor = F.col("event_type")
    k = F.when(~sensor.isin(*S.SCALAR_SENSORS),
               F.expr("try_cast(get_json_object(props, '$.k') AS DOUBLE)"))
    prediction = F.col("value") / F.lit(S.PREDICTION_SCALE)
    return e.select(
        F.col("event_id"),
        F.col("user_id").alias("asset_id"),
        sensor.alias("sensor"),
        F.col("ts"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        phase_of(F.col("ts")).alias("phase"),
        F.col("value"),
        k.alias("k"),
        prediction.alias("prediction"),
        (prediction > threshold_of(sensor)).alias("is_anomaly"),
    )


def _payload(r: DataFrame, keys: dict[str, str]) -> Column:
    return F.struct(
        F.col("value").alias(keys["value"]),
        F.col("k").alias(keys["k"]),
        F.col("sensor"),
        F.col("phase"),
    )


def envelope_json(r: DataFrame) -> Column:
    """JSON text of the telemetry message for each reading of ``r``."""
    def env(payload: Column) -> Column:
        return F.to_json(F.struct(
            F.col("timestamp"), F.col("sensor"), payload.alias("value"),
            F.col("prediction"), F.col("is_anomaly"), F.col("phase"),
            F.col("asset_id"), F.col("event_id")))

    healthy = {f: keys[0] for f, keys in S.EVENT_RAW_KEYS.items()}
    faulty = {f: keys[1] for f, keys in S.EVENT_RAW_KEYS.items()}
    return (F.when(F.col("sensor").isin(*S.SCALAR_SENSORS), env(F.col("value")))
            .when(F.col("ts") >= F.lit(S.FIRMWARE_SWITCH).cast("timestamp_ntz"),
                  env(_payload(r, faulty)))
            .otherwise(env(_payload(r, healthy))))


def envelope_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as a message bus delivers them: ``value`` is UTF-8 bytes."""
    r = readings(spark, sf_dir)
    return r.select(F.encode(envelope_json(r), "UTF-8").alias("value"))
