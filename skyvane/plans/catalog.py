"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the whole ``events`` table
(or data Spark derives from it) and returns a DataFrame. Computed columns are
aliased identically on both sides; doubles are rounded to 6 places and times
rendered as text so the comparison is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import decode as D
from ..operators import aggregations as A
from ..operators import lookups as L
from ..session import materialize
from ..sources import telemetry as T
from . import oracle as O

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def r6(c):
    """Round to 6 places as ``std::round(x * 1e6) / 1e6`` (half away from zero
    on the scaled binary value), which is what the SQL side's ``round`` does;
    Spark's ``round`` rounds the shortest decimal text instead and differs on
    exact ties."""
    from ..operators.ordered import round_half_away
    return round_half_away(F.col(c) if isinstance(c, str) else c, 6)


def fmt(c):
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


# --------------------------------------------------------------------------
# Decode (PRJ1-PRJ10, FIL6, FIL8)
# --------------------------------------------------------------------------
@register("decode_envelope", O.with_readings("""
SELECT event_id, asset_id, sensor, phase,
       round("timestamp", 6) AS "timestamp", round(prediction, 6) AS prediction,
       is_anomaly, value, k
FROM readings"""))
def decode_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages built from events, decoded back: envelope + payload + typed features."""
    good, _ = D.split_dead_letters(D.decode_stream(T.envelope_records(spark, sf_dir)))
    return good.select("event_id", "asset_id", "sensor", "phase", r6("timestamp").alias("timestamp"),
                       r6("prediction").alias("prediction"), "is_anomaly", "value", "k")


@register("dead_letters", """
SELECT count(*) AS n_dead FROM events
WHERE event_type IS NULL OR ts IS NULL""")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL8: messages without sensor or time (none in well-formed input)."""
    _, dead = D.split_dead_letters(D.decode_stream(T.envelope_records(spark, sf_dir)))
    return dead.agg(F.count(F.lit(1)).alias("n_dead"))


@register("payload_features", O.with_readings("""
SELECT event_id, 'value' AS feature, value AS fvalue FROM readings WHERE value IS NOT NULL
UNION ALL
SELECT event_id, 'k' AS feature, k AS fvalue FROM readings WHERE k IS NOT NULL"""))
def payload_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ4 + PRJ6 + PRJ7 + PRJ8: the edge feature map (renamed, numeric only),
    one row per (reading, feature)."""
    dec = D.decode_stream(T.envelope_records(spark, sf_dir))
    return D.feature_rows(dec, "event_id")


@register("flatten_features", O.with_readings("""
SELECT event_id, sensor, value, k,
       ts >= TIMESTAMP '{switch}' AND sensor NOT IN ({scalar}) AS faulty_keys
FROM readings""".format(switch=S.FIRMWARE_SWITCH,
                        scalar=", ".join(f"'{s}'" for s in S.SCALAR_SENSORS))))
def flatten_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ5 + PRJ9: typed feature columns coalesced over healthy/faulty key names."""
    dec = D.decode_stream(T.envelope_records(spark, sf_dir))
    m = D.payload_map(F.col("payload"))
    faulty = F.coalesce(F.map_contains_key(m, "value (units)"), F.lit(False))
    return dec.select("event_id", "sensor", "value", "k", faulty.alias("faulty_keys"))


# --------------------------------------------------------------------------
# Windows (AGG1-AGG8)
# --------------------------------------------------------------------------
@register("window_by_sensor_phase", O.with_readings(f"""
SELECT {O.fmt_ts("time_bucket(INTERVAL '5 seconds', ts)")} AS "timestamp", sensor, phase,
       max(value) AS value, max(k) AS k, round(max(prediction), 6) AS score,
       bool_or(is_anomaly) AS is_anomaly
FROM readings GROUP BY ALL"""))
def window_by_sensor_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2 + AGG3 + PRJ11: 5-second windows by sensor and phase (the monitoring rows)."""
    w = A.window_rows(T.readings(spark, sf_dir), "5 seconds", time_col="ts")
    return w.select(fmt("timestamp").alias("timestamp"), "sensor", "phase", "value", "k",
                    r6("score").alias("score"), "is_anomaly")


def _wide_sql() -> str:
    cols = ", ".join(f"max(CASE WHEN sensor = '{s}' THEN {f} END) AS {s}_{f}"
                     for s in S.EVENT_SENSORS for f in S.EVENT_FEATURES)
    return O.with_readings(f"""
SELECT {O.fmt_ts("time_bucket(INTERVAL '1 hour', ts)")} AS "timestamp", {cols},
       round(max(prediction), 6) AS prediction
FROM readings GROUP BY 1""")


@register("window_wide_pivot", _wide_sql())
def window_wide_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1: hourly training rows, one column per (sensor, feature)."""
    w = A.wide_window(T.readings(spark, sf_dir), "1 hour", time_col="ts")
    return w.withColumn("timestamp", fmt("timestamp")).withColumn("prediction", r6("prediction"))


@register("window_avg_by_asset", O.with_readings(f"""
SELECT {O.fmt_ts("time_bucket(INTERVAL '1 day', ts)")} AS "timestamp", asset_id, sensor,
       round(avg(value), 6) AS value, round(avg(k), 6) AS k, round(max(prediction), 6) AS score,
       bool_or(is_anomaly) AS is_anomaly
FROM readings GROUP BY ALL"""))
def window_avg_by_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG7: the same window builder with ``avg``, daily, per asset and sensor."""
    w = A.window_rows(T.readings(spark, sf_dir), "1 day", keys=("asset_id", "sensor"),
                      time_col="ts", agg="avg")
    return w.select(fmt("timestamp").alias("timestamp"), "asset_id", "sensor",
                    r6("value").alias("value"), r6("k").alias("k"), r6("score").alias("score"),
                    "is_anomaly")


@register("health_report", O.with_readings("""
SELECT is_faulty, count(*) AS n_units,
       array_to_string(list_sort(list_distinct(list(sensor))), ',') AS sensor_types
FROM units GROUP BY is_faulty""", """units AS (
  SELECT asset_id, sensor, avg(CAST(is_anomaly AS DOUBLE)) > 0.25 AS is_faulty
  FROM readings GROUP BY asset_id, sensor)"""))
def health_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5: healthy vs faulty sensor units, with the sensor types involved."""
    return A.health_report(T.readings(spark, sf_dir))


def _completeness_sql() -> str:
    expected = ", ".join(f"'{s}'" for s in sorted(S.EVENT_SENSORS))
    return O.with_readings(f"""
SELECT {O.fmt_ts("time_bucket(INTERVAL '1 day', ts)")} AS "timestamp", asset_id,
       count(*) AS n_readings, count(DISTINCT sensor) AS n_sensors,
       CAST({len(S.EVENT_SENSORS)} AS BIGINT) AS n_expected,
       array_to_string(list_sort(list_filter([{expected}], lambda x: NOT list_contains(list(sensor), x))), ',') AS missing
FROM readings GROUP BY ALL""")


@register("sensor_completeness", _completeness_sql())
def sensor_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8: per asset and day, readings and distinct sensors against the expected set."""
    c = A.completeness(T.readings(spark, sf_dir), "1 day", time_col="ts")
    return c.withColumn("timestamp", fmt("timestamp")) \
            .withColumn("n_expected", F.col("n_expected").cast("long"))


def _weighted_sql() -> str:
    terms = []
    hits = []
    for f in S.EVENT_FEATURES:
        w = O.weight_of(f)
        ok = f"(r.{f} IS NOT NULL AND b.mean_{f} IS NOT NULL)"
        terms.append(f"CASE WHEN {ok} THEN abs(r.{f} - b.mean_{f}) / (abs(b.mean_{f}) + 1e-6) * {w!r} ELSE 0.0 END")
        hits.append(f"CAST({ok} AS INTEGER)")
    total = " + ".join(terms)
    n = " + ".join(hits)
    means = ", ".join(f"avg({f}) AS mean_{f}" for f in S.EVENT_FEATURES)
    return O.with_readings(f"""
SELECT r.event_id, r.sensor, r.phase, {n} AS n_matched,
       round(CASE WHEN {n} > 0 THEN ({total}) / ({n}) ELSE 0.0 END, 6) AS weighted_error
FROM readings r LEFT JOIN baseline b USING (sensor, phase)""",
        f"baseline AS (SELECT sensor, phase, {means} FROM readings GROUP BY sensor, phase)")


@register("weighted_error", _weighted_sql())
def weighted_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG4 + JON2: mean weighted relative error against the phase baseline."""
    r = T.readings(spark, sf_dir)
    out = A.weighted_error(r, A.phase_baseline(r))
    return out.select("event_id", "sensor", "phase", "n_matched",
                      r6("weighted_error").alias("weighted_error"))


# --------------------------------------------------------------------------
# Lookups, alerts, updates (JON1-JON6, FIL1-FIL5, PRJ12-PRJ15, PRJ25-PRJ26)
# --------------------------------------------------------------------------
@register("threshold_alerts", O.with_readings(f"""
SELECT event_id, sensor, round(prediction, 6) AS prediction, {O.threshold_case()} AS threshold
FROM readings WHERE prediction > {O.threshold_case()}"""))
def threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON1 + FIL2: per-sensor threshold by broadcast join, strict ``>``."""
    r = T.readings(spark, sf_dir).filter(T.score_prefilter(min(S.all_thresholds().values())))
    f = L.with_threshold(r, S.threshold_table(spark))
    return f.filter("flagged").select("event_id", "sensor", r6("prediction").alias("prediction"),
                                      "threshold")


@register("global_alerts", O.with_readings("""
SELECT event_id, sensor, round(prediction, 6) AS prediction FROM readings WHERE prediction > 0.8"""))
def global_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL1: one global cut-off (0.8) on the edge score."""
    g = L.global_alerts(T.readings(spark, sf_dir).filter(T.score_prefilter(0.8)), 0.8)
    return g.select("event_id", "sensor", r6("prediction").alias("prediction"))


@register("alert_messages", O.with_readings(f"""
SELECT event_id, asset_id, round("timestamp", 6) AS "timestamp", sensor,
       round(prediction, 6) AS prediction, 'Anomaly detected in ' || sensor AS message,
       CASE WHEN sensor IN ({", ".join(f"'{s}'" for s in S.SCALAR_SENSORS)}) THEN 0 ELSE 4 END AS n_payload_keys
FROM readings WHERE prediction > {O.threshold_case()}"""))
def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ15: alert rows (message text and the raw payload JSON)."""
    dec = D.decode_stream(T.envelope_records(spark, sf_dir))
    flagged = L.with_threshold(dec, S.threshold_table(spark))
    alerts = L.alert_messages(flagged, F.col("payload"))
    m = D.payload_map(F.col("value"))
    n_keys = F.when(m.isNull(), F.lit(0)).otherwise(F.size(m))
    return alerts.select("event_id", "asset_id", r6("timestamp").alias("timestamp"), "sensor",
                         r6("prediction").alias("prediction"), "message",
                         n_keys.alias("n_payload_keys"))


# --------------------------------------------------------------------------
# Ordered operators (WIN1-WIN13, AGG6, STA9)
# --------------------------------------------------------------------------
from ..operators import ordered as W  # noqa: E402


# Time grain that splits the sequence of a hot (asset, sensor) into
# independent partitions; results do not depend on it, only parallelism does.
SEQ_GRAIN = "hour"


def _seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.with_bucket(T.readings(spark, sf_dir), SEQ_GRAIN)


@register("moving_avg", O.with_readings(f"""
SELECT event_id,
       round(avg(value) OVER (PARTITION BY asset_id, sensor ORDER BY ts, event_id
                              ROWS BETWEEN 1 PRECEDING AND CURRENT ROW), 6) AS ma2,
       round(avg(value) OVER (PARTITION BY asset_id, sensor ORDER BY ts, event_id
                              ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS ma3
FROM readings"""))
def moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN5: 2- and 3-reading simple moving averages."""
    out = W.bounded(_seq(spark, sf_dir), 2, lambda w: {
        "ma2": W.moving_average("value", w, 2), "ma3": W.moving_average("value", w, 3)})
    return out.select("event_id", r6("ma2").alias("ma2"), r6("ma3").alias("ma3"))


def _smoothing_sql() -> str:
    lag = lambda i: f"lag(value, {i}) OVER (PARTITION BY asset_id, sensor ORDER BY ts, event_id)"
    d = O.dbl
    ws = [0.4, 0.3, 0.2, 0.1]
    num = " + ".join(f"coalesce(l{i} * {d(w)}, 0.0)" for i, w in enumerate(ws, 1))
    den = " + ".join(f"coalesce(CASE WHEN l{i} IS NOT NULL THEN {d(w)} END, 0.0)"
                     for i, w in enumerate(ws, 1))
    inertia = (f"CASE WHEN l1 IS NULL THEN value ELSE "
               f"{O.rha(f'value * {d(1 - 0.85)} + (({num}) / ({den})) * {d(0.85)}', 2)} END")
    grow = ["CASE WHEN least(rn, 6) = 1 THEN value"]
    for L, wts in sorted(W.GROWING_WEIGHTS.items()):
        terms = " + ".join(f"{'value' if L - 1 - j == 0 else f'l{L - 1 - j}'} * {d(wt)}"
                           for j, wt in enumerate(wts))
        top = "(CASE phase WHEN 'takeoff' THEN 150.0 WHEN 'cruise' THEN 120.0 ELSE 180.0 END)"
        grow.append(f"WHEN least(rn, 6) = {L} THEN {O.rha(f'least(({terms}) / {d(sum(wts))}, {top})', 3)}")
    grow = " ".join(grow) + " END"

    def three(two, thr):
        return (f"CASE WHEN l1 IS NULL THEN value "
                f"WHEN l2 IS NULL THEN {O.rha(f'l1 * {d(two[0])} + value * {d(two[1])}', 2)} "
                f"ELSE {O.rha(f'l2 * {d(thr[0])} + l1 * {d(thr[1])} + value * {d(thr[2])}', 2)} END")
    pressure = (f"CASE WHEN l1 IS NULL THEN value WHEN phase = 'takeoff' THEN "
                f"(CASE WHEN value < l1 THEN {O.rha(f'l1 * {d(0.7)} + value * {d(0.3)}', 2)} "
                f"ELSE {O.rha(f'l1 * {d(0.4)} + value * {d(0.6)}', 2)} END) "
                f"ELSE {three((0.3, 0.7), (0.2, 0.3, 0.5))} END")
    gradient = three((0.4, 0.6), (0.2, 0.3, 0.5))
    lags = ", ".join(f"{lag(i)} AS l{i}" for i in range(1, 6))
    return O.with_readings(f"""
SELECT event_id, round({inertia}, 6) AS inertia, round({grow}, 6) AS asym_smooth,
       round({pressure}, 6) AS pressure_smooth, round({gradient}, 6) AS gradient_smooth
FROM seq""", f"""seq AS (
  SELECT *, {lags},
         row_number() OVER (PARTITION BY asset_id, sensor ORDER BY ts, event_id) AS rn
  FROM readings)""")


@register("moving_avg_weighted", _smoothing_sql())
def moving_avg_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN1-WIN4: thermal inertia, growing-window smoothing, phase-aware
    pressure smoothing and gradient smoothing."""
    out = W.bounded(_seq(spark, sf_dir), 5, lambda w: {
        "inertia": W.thermal_inertia("value", w),
        "asym_smooth": W.growing_smooth("value", w, ceiling=F.element_at(
            S.as_map_literal({p: v["value"][1] for p, v in S.EVENT_PHASE_LIMITS.items()}), F.col("phase"))),
        "pressure_smooth": W.smooth_pressure("value", w),
        "gradient_smooth": W.smooth_gradient("value", w)})
    return out.select("event_id", *[r6(c).alias(c) for c in
                                    ("inertia", "asym_smooth", "pressure_smooth", "gradient_smooth")])


def _gradient_sql() -> str:
    lim = "CAST(CASE phase " + " ".join(f"WHEN '{p}' THEN {v!r}" for p, v in
                                       S.FUEL_GRADIENT_LIMITS.items()) + " END AS DOUBLE)"
    g = "((value - l1) / dmin)"
    clipped = f"greatest(least({g}, {lim}), -{lim})"
    return O.with_readings(f"""
SELECT event_id,
       round(CASE WHEN l1 IS NULL THEN NULL WHEN dmin <= 0 THEN 0.0
                  WHEN abs({clipped}) > 0.01 THEN {O.rha(clipped, 2)} ELSE 0.0 END, 6) AS gradient,
       coalesce(abs(value - l1) > 0.02 * dt, false) AS moving,
       round(abs(value - l1) / (abs(l1) + 1e-6), 6) AS trend_error
FROM (SELECT *, dt / 60.0 AS dmin FROM seq)""", f"""seq AS (
  SELECT *, lag(value) OVER ({O.SEQ}) AS l1,
         "timestamp" - lag("timestamp") OVER ({O.SEQ}) AS dt
  FROM readings)""")


@register("gradient_per_min", _gradient_sql())
def gradient_per_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN6 + WIN11 + WIN13: clipped per-minute gradient, moving flag, trend error."""
    out = W.bounded(_seq(spark, sf_dir), 1, lambda w: {
        "gradient": W.gradient_per_minute("value", w, S.FUEL_GRADIENT_LIMITS),
        "moving": W.moving_flag("value", w),
        "trend_error": W.trend_error("value", w)})
    return out.select("event_id", r6("gradient").alias("gradient"), "moving",
                      r6("trend_error").alias("trend_error"))


_RUNS_CTE = f"""runs AS (
  SELECT *, CAST(sum(CAST(st AS BIGINT)) OVER ({O.SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 AS BIGINT) AS run_id,
         seq - max(CASE WHEN st THEN seq END) OVER ({O.SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1
           AS reading_in_run
  FROM (SELECT *, lag(phase) OVER ({O.SEQ}) AS prev_phase,
               coalesce(lag(phase) OVER ({O.SEQ}) <> phase, true) AS st,
               row_number() OVER ({O.SEQ}) AS seq
        FROM readings))"""


@register("phase_runs", O.with_readings("""
SELECT event_id, prev_phase, coalesce(prev_phase <> phase, false) AS transition,
       coalesce(prev_phase = 'cruise' AND phase = 'landing', false) AS cruise_to_landing,
       run_id, reading_in_run
FROM runs""", _RUNS_CTE))
def phase_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN7 + WIN8: phase transitions and the reading counter within each run."""
    out = W.phase_runs(_seq(spark, sf_dir))
    return out.select("event_id", "prev_phase", "transition", "cruise_to_landing", "run_id",
                      "reading_in_run")


@register("phase_durations", O.with_readings("""
SELECT asset_id, sensor, run_id, phase, count(*) AS n_ticks,
       round(min("timestamp"), 6) AS start_ts, round(max("timestamp"), 6) AS end_ts,
       round(max("timestamp") - min("timestamp"), 6) AS duration_s
FROM runs GROUP BY asset_id, sensor, run_id, phase""", _RUNS_CTE))
def phase_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG6: ticks and duration of each phase run."""
    d = A.phase_durations(W.phase_runs(_seq(spark, sf_dir)))
    return d.select("asset_id", "sensor", "run_id", "phase", "n_ticks",
                    *[r6(c).alias(c) for c in ("start_ts", "end_ts", "duration_s")])


@register("plateau_runs", O.with_readings(f"""
SELECT event_id, seq - brk AS plateau_len, (seq - brk) % 3 AS plateau_count,
       (seq - brk) > 0 AND (seq - brk) % 3 = 0 AS plateau_flag
FROM (SELECT *, max(CASE WHEN NOT pl THEN seq END)
                  OVER ({O.SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS brk
      FROM (SELECT *, coalesce(abs(k - lag(k) OVER ({O.SEQ})) < 0.01, false) AS pl,
                   row_number() OVER ({O.SEQ}) AS seq FROM readings))"""))
def plateau_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN9: plateau counter on ``k`` with a flag at every third plateau step."""
    out = W.plateau_runs(_seq(spark, sf_dir), "k")
    return out.select("event_id", "plateau_len", "plateau_count", "plateau_flag")


@register("change_events", O.with_readings(f"""
SELECT asset_id, sensor, event_id, previous, value, recent_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY asset_id, sensor ORDER BY ts DESC, event_id DESC)
            AS recent_rank
  FROM (SELECT *, lag(value) OVER ({O.SEQ}) AS previous FROM readings)
  WHERE abs(value - previous) > 0.1)
WHERE recent_rank <= 10"""))
def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN10: value changes above 0.1, the latest 10 per sensor (top-k report)."""
    out = W.change_events(_seq(spark, sf_dir))
    return out.select("asset_id", "sensor", "event_id", "previous", "value",
                      F.col("recent_rank").cast("long").alias("recent_rank"))


@register("stall_events", O.with_readings(f"""
SELECT event_id, round(held, 6) AS held_s, coalesce(held > 3600.0, false) AS stalled
FROM (SELECT *, CASE WHEN c THEN "timestamp" - max(CASE WHEN ent THEN "timestamp" END)
                     OVER ({O.SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS held
      FROM (SELECT *, c AND coalesce(NOT lag(c) OVER ({O.SEQ}), true) AS ent
            FROM (SELECT *, coalesce(is_anomaly, false) AS c FROM readings)))"""))
def stall_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN12: how long the anomaly condition has held; stalled beyond one hour."""
    out = W.held_condition(_seq(spark, sf_dir), F.col("is_anomaly"), 3600.0)
    return out.select("event_id", r6("held_s").alias("held_s"), "stalled")


@register("hysteresis_latch", O.with_readings(f"""
SELECT event_id, coalesce(last_value(ev IGNORE NULLS) OVER ({O.SEQ}
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1, false) AS latched
FROM (SELECT *, CASE WHEN prediction > 2.0 THEN 1 WHEN prediction < 0.5 THEN 0 END AS ev
      FROM readings)"""))
def hysteresis_latch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA9: latch on when the score exceeds 2.0, off when it falls below 0.5."""
    out = W.hysteresis(_seq(spark, sf_dir), F.col("prediction") > 2.0, F.col("prediction") < 0.5)
    return out.select("event_id", "latched")


# --------------------------------------------------------------------------
# Sequential folds: model (STA2-STA5) and STA1, STA6-STA8
# --------------------------------------------------------------------------
from ..operators import chunked as CH  # noqa: E402
from ..operators import ewma as EW  # noqa: E402
from ..operators import fold as FD  # noqa: E402
from ..operators import model as M  # noqa: E402

# Sequential folds split keys with more than CH.SPLIT_ABOVE rows into hourly
# chunks, folded in parallel and stitched exactly.
SEQ_KEYS, SEQ_ORDER = ["asset_id", "sensor"], ["ts", "event_id"]


def fold_chunk():
    return F.date_trunc("hour", F.col("ts"))

_MK = list(M.MODEL_KEYS)
_d = O.dbl


def _model_sql(seq_sql: str, extra: list[str] | None = None, feats: list[str] | None = None,
               weight: Callable[[str], str] | None = None, keys: list[str] | None = None,
               carry: dict[str, str] | None = None, out: str | None = None) -> str:
    feats = feats or list(S.EVENT_FEATURES)
    wts = S.all_weights()
    weight = weight or (lambda f: _d(wts.get(f, 1.0)))
    st = {"event_id": "CAST(NULL AS BIGINT)", "kind": "CAST(NULL AS INTEGER)",
          "score": "CAST(NULL AS DOUBLE)", "anomaly": "CAST(NULL AS BOOLEAN)", "hp": "false"}
    for f in feats:
        st[f"m_{f}"] = "CAST(NULL AS DOUBLE)"
        st[f"p_{f}"] = "CAST(NULL AS DOUBLE)"
    matched = {f: f"(s.kind = 1 AND f.hp AND s.x_{f} IS NOT NULL AND f.m_{f} IS NOT NULL)"
               for f in feats}
    err = {}
    for f in feats:
        base = f"(abs(s.x_{f} - f.m_{f}) / (abs(f.m_{f}) + {_d(1e-6)}) * {weight(f)})"
        trend = f"({_d(0.5)} * (abs(s.x_{f} - f.p_{f}) / (abs(f.p_{f}) + {_d(1e-6)})))"
        err[f] = f"(CASE WHEN f.p_{f} IS NULL THEN {base} ELSE {base} + {trend} END)"
    total = " + ".join(f"(CASE WHEN {matched[f]} THEN {err[f]} ELSE 0.0 END)" for f in feats)
    cnt = " + ".join(f"CAST({matched[f]} AS INTEGER)" for f in feats)
    score = f"(CASE WHEN ({cnt}) > 0 THEN least(({total}) / ({cnt}), {_d(10.0)}) ELSE 0.0 END)"
    learn = f"(s.kind = 1 AND NOT ({score} > s.threshold))"
    step = {"event_id": "s.event_id", "kind": "s.kind",
            "score": f"CASE WHEN s.kind = 1 THEN {score} END",
            "anomaly": f"CASE WHEN s.kind = 1 THEN {score} > s.threshold END",
            "hp": f"(f.hp OR {learn} OR s.kind = 0)"}
    for f in feats:
        step[f"m_{f}"] = (
            f"CASE WHEN s.kind = 0 AND s.x_{f} IS NOT NULL THEN "
            f"(CASE WHEN f.m_{f} IS NULL THEN s.x_{f} ELSE {_d(0.8)} * f.m_{f} + {_d(0.2)} * s.x_{f} END) "
            f"WHEN {learn} AND s.x_{f} IS NOT NULL THEN "
            f"(CASE WHEN f.m_{f} IS NULL THEN s.x_{f} ELSE {_d(0.2)} * s.x_{f} + {_d(0.8)} * f.m_{f} END) "
            f"ELSE f.m_{f} END")
        step[f"p_{f}"] = f"CASE WHEN {matched[f]} THEN s.x_{f} ELSE f.p_{f} END"
    for name, kind in (carry or {}).items():
        st[name], step[name] = f"CAST(NULL AS {kind})", f"s.{name}"
    out = out or ("SELECT event_id, round(score, 6) AS score, anomaly AS is_anomaly, "
                  + ", ".join(f"round(m_{f}, 6) AS mean_{f}" for f in feats)
                  + " FROM fold WHERE rn > 0 AND kind = 1")
    return O.recursive_fold(keys or _MK, seq_sql, st, step, out, extra)


_READ_SEQ = ("SELECT asset_id, sensor, phase, ts, 1 AS kind, event_id, "
             f"{O.threshold_case()} AS threshold, value AS x_value, k AS x_k FROM readings")


def _numbered(inner: str) -> str:
    return (f"SELECT *, row_number() OVER (PARTITION BY asset_id, sensor, phase "
            f"ORDER BY ts, kind, event_id) AS rn FROM ({inner})")


def _model_out(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("kind") == M.READING).select(
        "event_id", r6("score").alias("score"), "is_anomaly",
        *[r6(f"mean_{f}").alias(f"mean_{f}") for f in S.EVENT_FEATURES])


@register("gated_scores", _model_sql(_numbered(_READ_SEQ)))
def gated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA2-STA4: predict -> threshold -> learn-if-normal, per (asset, sensor, phase)."""
    return _model_out(M.score(M.model_input(T.readings(spark, sf_dir)), chunk=fold_chunk()))


def daily_updates(readings: DataFrame, spark: SparkSession) -> DataFrame:
    """Model updates fed back from daily windows per (asset, sensor, phase):
    window max of each allowed feature, dropped when the window saw an
    anomaly (FIL4) or the sensor has no model (FIL5); effective at window end."""
    win = A.window_rows(readings, "1 day", keys=("asset_id", "sensor", "phase"), time_col="ts")
    msgs = L.update_messages(win, S.update_feature_table(spark), extra_keys=("asset_id",))
    msgs = L.known_sensors(L.learnable(msgs), S.sensor_table(spark))
    eff = F.col("timestamp").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return msgs.withColumn("effective_ts", eff)


def _update_seq_sql() -> str:
    scalar = ", ".join(f"'{s}'" for s in S.SCALAR_SENSORS)
    known = ", ".join(f"'{s}'" for s in sorted(S.all_thresholds()))
    return f"""
SELECT asset_id, sensor, phase, ts, 0 AS kind, CAST(-1 AS BIGINT) AS event_id,
       CAST(0.0 AS DOUBLE) AS threshold, x_value, x_k
FROM (SELECT asset_id, sensor, phase,
             time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS ts,
             max(value) AS x_value,
             CASE WHEN sensor IN ({scalar}) THEN NULL ELSE max(k) END AS x_k,
             bool_or(is_anomaly) AS an
      FROM readings GROUP BY asset_id, sensor, phase, time_bucket(INTERVAL '1 day', ts))
WHERE NOT coalesce(an, false) AND (x_value IS NOT NULL OR x_k IS NOT NULL)
  AND sensor IN ({known})"""


@register("feedback_scores", _model_sql(_numbered(f"{_READ_SEQ} UNION ALL {_update_seq_sql()}")))
def feedback_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA5: the model with daily window updates blended back in (0.8/0.2)."""
    r = T.readings(spark, sf_dir)
    # the updates feed both the hot-key pass and the fold: written once
    ups = materialize(daily_updates(r, spark), "daily-updates")
    rows = M.model_input(r).unionByName(M.update_input(ups))
    return _model_out(M.score(rows, chunk=fold_chunk()))


_SEQ2 = ("SELECT *, row_number() OVER (PARTITION BY asset_id, sensor ORDER BY ts, event_id) AS rn "
         "FROM readings")


@register("ewma", O.recursive_fold(
    ["asset_id", "sensor"], _SEQ2,
    {"event_id": "CAST(NULL AS BIGINT)", "m": "CAST(NULL AS DOUBLE)"},
    {"event_id": "s.event_id",
     "m": f"CASE WHEN s.value IS NULL THEN f.m WHEN f.m IS NULL THEN s.value "
          f"ELSE {_d(0.2)} * s.value + {_d(1 - 0.2)} * f.m END"},
    "SELECT event_id, round(m, 6) AS ewma FROM fold WHERE rn > 0"))
def ewma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA1: plain EWMA (α = 0.2) of each sensor's value, seeded by the first value."""
    r = T.readings(spark, sf_dir).select("event_id", "asset_id", "sensor", "ts", "value")
    out = EW.ewma(W.with_bucket(r), "value", 0.2)
    return out.select("event_id", r6("ewma").alias("ewma"))


# --------------------------------------------------------------------------
# The same engines on hot keys: the sensor alone is the key, so five keys hold all
# rows and every one of them is split (halo, carry and speculative chunks all run).
# --------------------------------------------------------------------------
HOT = ("sensor",)
HOT_ROWS = 100          # split keys above this many rows
HOT_CHUNK = 250


def _hot_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = T.readings(spark, sf_dir).select("event_id", "sensor", "ts", "value", "prediction")
    return W.with_bucket(r, "day", split_above=HOT_ROWS, keys=HOT)


def _by_sensor(name: str) -> str:
    return REGISTRY[name][1].replace("PARTITION BY asset_id, sensor", "PARTITION BY sensor")


@register("hot_moving_avg", _by_sensor("moving_avg"))
def hot_moving_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN5 over split keys: bucket halos."""
    out = W.bounded(_hot_seq(spark, sf_dir), 2, lambda w: {
        "ma2": W.moving_average("value", w, 2), "ma3": W.moving_average("value", w, 3)}, keys=HOT)
    return out.select("event_id", r6("ma2").alias("ma2"), r6("ma3").alias("ma3"))


@register("hot_latch", _by_sensor("hysteresis_latch"))
def hot_latch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA9 over split keys: two-level scan with carries."""
    out = W.hysteresis(_hot_seq(spark, sf_dir), F.col("prediction") > 2.0, F.col("prediction") < 0.5, keys=HOT)
    return out.select("event_id", "latched")


@register("hot_ewma", O.recursive_fold(
    ["sensor"], "SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY ts, event_id) AS rn FROM readings",
    {"event_id": "CAST(NULL AS BIGINT)", "m": "CAST(NULL AS DOUBLE)"},
    {"event_id": "s.event_id",
     "m": f"CASE WHEN s.value IS NULL THEN f.m WHEN f.m IS NULL THEN s.value "
          f"ELSE {_d(0.2)} * s.value + {_d(1 - 0.2)} * f.m END"},
    "SELECT event_id, round(m, 6) AS ewma FROM fold WHERE rn > 0"))
def hot_ewma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA1 over split keys: blocks of values with the block before as halo."""
    out = EW.ewma(_hot_seq(spark, sf_dir), "value", 0.2, keys=HOT)
    return out.select("event_id", r6("ewma").alias("ewma"))


# A shifted level locks the gate of every sensor: from the shift on, most readings are anomalies.
_SHIFTED = ("CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN value + 5000 ELSE value END")


@register("hot_locked_gate", _model_sql(
    "SELECT *, row_number() OVER (PARTITION BY sensor, phase ORDER BY ts, event_id) AS rn FROM ("
    f"SELECT sensor, phase, ts, 1 AS kind, event_id, {O.threshold_case()} AS threshold, {_SHIFTED} AS x_value, k AS x_k FROM readings)",
    keys=["sensor", "phase"]))
def hot_locked_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA2-STA4 on split keys without asset whose gate locks: rounds of speculation, no one-task refold."""
    r = T.readings(spark, sf_dir).withColumn("asset_id", F.lit(None).cast("long")).withColumn(
        "value", F.when(F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.col("value") + 5000).otherwise(F.col("value")))
    fold = M.model_step(list(S.EVENT_FEATURES), S.all_weights())
    return _model_out(CH.chunked_fold(M.model_input(r), M.MODEL_KEYS, M.MODEL_ORDER, fold,
                                      split_above=HOT_ROWS, chunk_rows=HOT_CHUNK))


def _smooth_step() -> str:
    keep, mc, lo, hi = 0.7, 0.5, 0.0, 3.0
    s0 = f"({_d(1 - keep)} * s.prediction + {_d(keep)} * f.prev)"
    s1 = (f"(CASE WHEN abs({s0} - f.prev) > {_d(mc)} THEN (CASE WHEN {s0} > f.prev "
          f"THEN f.prev + {_d(mc)} ELSE f.prev - {_d(mc)} END) ELSE {s0} END)")
    s2 = f"greatest(least({s1}, {_d(hi)}), {_d(lo)})"
    return f"CASE WHEN s.prediction IS NULL THEN f.prev ELSE {s2} END"


@register("smoothed_slew", O.recursive_fold(
    ["asset_id", "sensor"], _SEQ2,
    {"event_id": "CAST(NULL AS BIGINT)", "prev": "CAST(0.0 AS DOUBLE)"},
    {"event_id": "s.event_id", "prev": _smooth_step()},
    "SELECT event_id, round(prev, 6) AS smoothed FROM fold WHERE rn > 0"))
def smoothed_slew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA6: exponential smoothing of the score (0.3 new / 0.7 previous output),
    slew-limited to ±0.5 and clamped to [0, 3]."""
    fold = FD.smoothing_fold("prediction", keep=0.7, max_change=0.5, lo=0.0, hi=3.0, init=0.0,
                             passthrough=("event_id",))
    out = CH.chunked_fold(T.readings(spark, sf_dir), SEQ_KEYS, SEQ_ORDER, fold, fold_chunk())
    return out.select("event_id", r6("smoothed").alias("smoothed"))


def _slew_step(mc: float) -> str:
    lim = (f"(CASE WHEN abs(s.value - f.prev) > {_d(mc)} THEN (CASE WHEN s.value > f.prev "
           f"THEN f.prev + {_d(mc)} ELSE f.prev - {_d(mc)} END) ELSE s.value END)")
    return f"CASE WHEN s.value IS NULL THEN f.prev WHEN f.prev IS NULL THEN s.value ELSE {lim} END"


@register("slew_limit", O.recursive_fold(
    ["asset_id", "sensor"], _SEQ2,
    {"event_id": "CAST(NULL AS BIGINT)", "prev": "CAST(NULL AS DOUBLE)"},
    {"event_id": "s.event_id", "prev": _slew_step(20.0)},
    "SELECT event_id, round(prev, 6) AS limited FROM fold WHERE rn > 0"))
def slew_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA7: rate-of-change limiter (±20 per reading) against the previous output."""
    fold = FD.slew_fold("value", 20.0, passthrough=("event_id",))
    out = CH.chunked_fold(T.readings(spark, sf_dir), SEQ_KEYS, SEQ_ORDER, fold, fold_chunk())
    return out.select("event_id", r6("limited").alias("limited"))


# Per-minute gradient limits used by the violation counter on derived telemetry.
VIOLATION_LIMITS = {"takeoff": 2.0, "cruise": 1.0, "landing": 1.5}


def _violation_sql() -> str:
    lim = "CAST(CASE s.phase " + " ".join(f"WHEN '{p}' THEN {v!r}" for p, v in
                                         VIOLATION_LIMITS.items()) + " END AS DOUBLE)"
    dmin = f'((s."timestamp" - f.prev_t) / {_d(60.0)})'
    have = f"coalesce(f.prev IS NOT NULL AND {dmin} > 0, false)"
    grad = f"((s.value - f.prev) / {dmin})"
    breach = f"({have} AND abs({grad}) > {lim})"
    limited = f"(CASE WHEN {grad} > 0 THEN {lim} ELSE -{lim} END)"
    top = "(CASE s.phase WHEN 'takeoff' THEN 150.0 WHEN 'cruise' THEN 120.0 ELSE 180.0 END)"
    out = f"(CASE WHEN {breach} THEN greatest(least(f.prev + {limited} * {dmin}, {top}), 0.5) ELSE s.value END)"
    cnt1 = f"(CASE WHEN {breach} THEN f.cnt + 1 WHEN {have} THEN greatest(0.0, f.cnt - 1) ELSE f.cnt END)"
    warn = f"({breach} AND {cnt1} >= 3)"
    return O.recursive_fold(
        ["asset_id", "sensor"], _SEQ2,
        {"event_id": "CAST(NULL AS BIGINT)", "prev": "CAST(NULL AS DOUBLE)",
         "prev_t": "CAST(NULL AS DOUBLE)", "cnt": "CAST(0.0 AS DOUBLE)", "warn": "false", "grad": "CAST(0.0 AS DOUBLE)"},
        {"event_id": "s.event_id", "grad": f"CASE WHEN {breach} THEN {limited} WHEN {have} THEN {grad} ELSE 0.0 END", "prev": out, "prev_t": 's."timestamp"',
         "cnt": f"CASE WHEN {warn} THEN 0.0 ELSE {cnt1} END", "warn": warn},
        "SELECT event_id, round(prev, 6) AS adjusted, round(grad, 6) AS gradient, round(cnt, 6) AS violations, warn AS warning "
        "FROM fold WHERE rn > 0")


@register("gradient_violations", _violation_sql())
def gradient_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA8: gradient-violation counter with values limited to the phase range, the limited gradient and a warning at 3."""
    bound = lambda i: F.element_at(S.as_map_literal({p: v["value"][i] for p, v in S.EVENT_PHASE_LIMITS.items()}), F.col("phase"))
    r = T.readings(spark, sf_dir).withColumn(
        "limit", F.element_at(S.as_map_literal(VIOLATION_LIMITS), F.col("phase"))).withColumns({"lo": bound(0), "hi": bound(1)})
    fold = FD.violation_fold("value", "timestamp", "limit", 3, passthrough=("event_id",), lo="lo", hi="hi")
    out = CH.chunked_fold(r, SEQ_KEYS, SEQ_ORDER, fold, fold_chunk())
    return out.select("event_id", r6("adjusted").alias("adjusted"), r6("gradient").alias("gradient"),
                      r6("violations").alias("violations"), "warning")


# --------------------------------------------------------------------------
# Update messages, range join, limits, scalar features
# --------------------------------------------------------------------------
from ..functions import features as FF  # noqa: E402
from ..operators import augment as AU  # noqa: E402
from ..operators import detect as DT  # noqa: E402


def _allowed_sql(feature: str) -> str:
    feats = {**S.WING_UPDATE_FEATURES, **S.event_update_features()}
    return ", ".join(f"'{s}'" for s, fs in sorted(feats.items()) if feature in fs)


@register("update_messages", O.with_readings(f"""
SELECT * FROM (
  SELECT {O.fmt_ts("t")} AS "timestamp", sensor, phase, round(coalesce(score, 0.0), 6) AS score,
         coalesce(is_anomaly, false) AS is_anomaly,
         CASE WHEN sensor IN ({_allowed_sql("value")}) THEN value END AS f_value,
         CASE WHEN sensor IN ({_allowed_sql("k")}) THEN k END AS f_k,
         CAST(CASE WHEN sensor IN ({_allowed_sql("value")}) AND value IS NOT NULL THEN 1 ELSE 0 END
            + CASE WHEN sensor IN ({_allowed_sql("k")}) AND k IS NOT NULL THEN 1 ELSE 0 END AS INTEGER)
           AS n_features
  FROM w) WHERE n_features > 0""", """w AS (
  SELECT time_bucket(INTERVAL '1 hour', ts) AS t, sensor, phase, max(value) AS value, max(k) AS k,
         max(prediction) AS score, bool_or(is_anomaly) AS is_anomaly
  FROM readings GROUP BY ALL)"""))
def update_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ13 + PRJ14 + JON3 + FIL3: hourly model-update messages per (sensor, phase)."""
    win = A.window_rows(T.readings(spark, sf_dir), "1 hour", time_col="ts")
    msgs = L.update_messages(win, S.update_feature_table(spark))
    return msgs.select("timestamp", "sensor", "phase", r6("score").alias("score"), "is_anomaly",
                       F.col("features").getItem("value").alias("f_value"),
                       F.col("features").getItem("k").alias("f_k"),
                       F.size("features").alias("n_features"))


def _intervals_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{n}' AS phase_tag, d + INTERVAL {lo} HOUR AS s, d + INTERVAL {hi} HOUR AS e FROM days"
        for n, lo, hi in S.PHASE_HOURS)
    return f"""days AS (SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE),
                                             INTERVAL 1 DAY)) AS d FROM readings),
iv AS ({parts})"""


@register("phase_tag_range_join", O.with_readings("""
SELECT r.event_id, iv.phase_tag, iv.phase_tag = r.phase AS matches
FROM readings r LEFT JOIN iv ON r.ts >= iv.s AND r.ts < iv.e""", _intervals_sql()))
def phase_tag_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON6: tag each reading with the phase interval containing its time (range join)."""
    r = T.readings(spark, sf_dir)
    iv = L.phase_intervals(spark, r).withColumnRenamed("phase", "phase_tag")
    j = L.range_join(r.select("event_id", "ts", "phase"), iv)
    return j.select("event_id", "phase_tag", (F.col("phase_tag") == F.col("phase")).alias("matches"))


def _limits_sql() -> str:
    def case(kind: str, feature: str) -> str:
        rows = [x for x in S.event_phase_limits() + S.WING_PHASE_LIMITS if x[2] == feature]
        whens = " ".join(f"WHEN sensor = '{s}' AND phase = '{p}' THEN {O.dbl(lo if kind == 'lo' else hi)}"
                         for s, p, f, lo, hi in rows)
        return f"(CASE {whens} END)"
    labels = []
    for f in S.EVENT_FEATURES:
        labels.append(f"CASE WHEN {f} < {case('lo', f)} THEN 'LOW_{f.upper()}' END")
        labels.append(f"CASE WHEN {f} > {case('hi', f)} THEN 'HIGH_{f.upper()}' END")
    n = " + ".join(f"CASE WHEN ({l}) IS NOT NULL THEN 1 ELSE 0 END" for l in labels)
    return O.with_readings(f"""
SELECT event_id, CASE WHEN n > 0 THEN w ELSE '✅' END AS warnings, n AS faults,
       CASE WHEN n > 0 THEN 'DEGRADED' ELSE 'NORMAL' END AS status
FROM (SELECT event_id, concat_ws(' ', {", ".join(labels)}) AS w, CAST({n} AS INTEGER) AS n
      FROM readings)""")


@register("phase_limits_check", _limits_sql())
def phase_limits_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON4 + DET1 + PRJ25 + PRJ26: healthy-range check per phase with warnings and status."""
    c = L.limits_check(T.readings(spark, sf_dir), S.phase_limit_table(spark))
    return c.select("event_id", "warnings", "faults", "status")


def _features_sql() -> str:
    d = O.dbl
    k0 = "coalesce(k, 0.0)"
    mult = ("CAST(CASE phase " + " ".join(f"WHEN '{p}' THEN {v!r}" for p, v in FF.RMS_MULTIPLIER.items())
            + f" ELSE {FF.RMS_MULTIPLIER_OTHER!r} END AS DOUBLE)")
    return O.with_readings(f"""
SELECT event_id,
       greatest(0.0, least(value, 100.0)) AS clamped,
       {O.rha(f"value / {d(7.0)}", 3)} AS rounded,
       round(sqrt(value * value + {k0} * {k0} + prediction * prediction), 6) AS magnitude,
       round(sqrt(prediction * prediction + (({k0} / {d(100.0)}) * {mult}) * (({k0} / {d(100.0)}) * {mult})), 6)
         AS rms_bias,
       {O.rha(f"value - {k0}", 2)} AS tracking,
       round(greatest({d(-0.5)}, least({k0} / {d(10.0)} - value / {d(10.0)}, {d(0.5)})), 6) AS overshoot,
       CAST(greatest(0, floor((("timestamp" + {k0} / {d(10.0)}) - "timestamp") * {d(1000.0)})) AS BIGINT)
         AS lag_ms,
       CASE WHEN abs((value - {d(50.0)}) / {d(100.0)}) < {d(0.1)} THEN 'STABLE' ELSE 'CHANGING' END
         AS stability,
       CASE WHEN value > 100 THEN 'MOVING' WHEN {k0} < 10 THEN 'LOCKED' ELSE 'HOLDING' END AS motion,
       coalesce(value BETWEEN 1 AND 100 AND k BETWEEN 5 AND 95, false) AS accepted
FROM readings""")


@register("feature_functions", _features_sql())
def feature_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ16-PRJ24 + FIL7: clamp, rounding, magnitude, RMS with bias, tracking
    error, overshoot, remaining lag, stability and motion labels, acceptance box."""
    r = T.readings(spark, sf_dir)
    v, k0, p = F.col("value"), F.coalesce(F.col("k"), F.lit(0.0)), F.col("prediction")
    t = F.col("timestamp")
    return r.select(
        "event_id",
        FF.clamp(v, 0.0, 100.0).alias("clamped"),
        FF.round_to(v / F.lit(7.0), 3).alias("rounded"),
        r6(FF.magnitude(v, k0, p)).alias("magnitude"),
        r6(FF.rms_with_bias(p, k0 / F.lit(100.0), F.col("phase"))).alias("rms_bias"),
        FF.tracking_error(v, k0).alias("tracking"),
        r6(FF.overshoot(k0 / F.lit(10.0), v / F.lit(10.0))).alias("overshoot"),
        FF.remaining_lag_ms(t + k0 / F.lit(10.0), t).alias("lag_ms"),
        FF.stability_label((v - F.lit(50.0)) / F.lit(100.0)).alias("stability"),
        FF.motion_label(v > 100, k0 < 10).alias("motion"),
        L.acceptance_box(r, {"value": (1, 100), "k": (5, 95)}).alias("accepted"),
    )


# --------------------------------------------------------------------------
# Detectors (DET2-DET8)
# --------------------------------------------------------------------------
def _frame(n: int) -> str:
    return f"{O.SEQ} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def _rolling_sql() -> str:
    lag = lambda c, i: f"lag({c}, {i}) OVER ({O.SEQ})"
    rises = []
    for c in ("value", "k"):
        for i in range(3):
            cur = lag(c, i) if i else c
            rises.append(f"({cur} > {lag(c, i + 1)})")
    together = " AND ".join(rises)
    return O.with_readings(f"""
SELECT event_id, round(roll_std, 6) AS roll_std, round(roll_corr, 6) AS roll_corr,
       round(swing, 6) AS swing, rising_together,
       cnt >= 5 AND coalesce(roll_std > 35.0, false) AS noisy,
       cnt >= 5 AND coalesce(roll_corr < 0.2, false) AS decorrelated,
       cnt >= 5 AND coalesce(swing > 150.0, false) AS oscillating
FROM (SELECT event_id,
             stddev_samp(value) OVER ({_frame(5)}) AS roll_std,
             covar_samp(xv, xk) OVER ({_frame(5)})
               / nullif(stddev_samp(xv) OVER ({_frame(5)}) * stddev_samp(xk) OVER ({_frame(5)}), 0.0)
               AS roll_corr,
             max(value) OVER ({_frame(5)}) - min(value) OVER ({_frame(5)}) AS swing,
             coalesce({together}, false) AS rising_together,
             count(value) OVER ({_frame(5)}) AS cnt
      FROM (SELECT *, CASE WHEN k IS NOT NULL THEN value END AS xv,
                      CASE WHEN value IS NOT NULL THEN k END AS xk FROM readings))""")


@register("rolling_detectors", _rolling_sql())
def rolling_detectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DET6-DET8: rolling 5-reading stddev, correlation, swing, co-rising channels."""
    out = DT.rolling(_seq(spark, sf_dir), "value", "k", 5)
    return out.select("event_id", r6("roll_std").alias("roll_std"), r6("roll_corr").alias("roll_corr"),
                      r6("swing").alias("swing"), "rising_together", "noisy", "decorrelated",
                      "oscillating")


def _flip_sql(big: float) -> str:
    lag = lambda i: f"lag(value, {i}) OVER ({O.SEQ})"
    d0, d1, d2 = f"(value - {lag(1)})", f"({lag(1)} - {lag(2)})", f"({lag(2)} - {lag(3)})"
    flip = lambda a, b: (f"coalesce(abs({a}) > {big!r} AND abs({b}) > {big!r} "
                         f"AND sign({a}) = -sign({b}), false)")
    return O.with_readings(f"SELECT event_id, {flip(d0, d1)} OR {flip(d0, d2)} AS sign_flip FROM readings")


@register("sign_flips", _flip_sql(100.0))
def sign_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DET5: large swings from positive to negative (or back) within 2 steps."""
    return DT.sign_flips(_seq(spark, sf_dir), "value", 100.0).select("event_id", "sign_flip")


@register("frozen_runs", O.with_readings(f"""
SELECT event_id, seq - brk AS frozen_len, seq - brk >= 3 AS frozen,
       seq - coalesce(brk2, 0) AS high_len, seq - coalesce(brk2, 0) > 3 AS high
FROM (SELECT *, max(CASE WHEN NOT still THEN seq END)
                  OVER ({O.SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS brk,
                max(CASE WHEN NOT c THEN seq END)
                  OVER ({O.SEQ} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS brk2
      FROM (SELECT *, coalesce(abs(k - lag(k) OVER ({O.SEQ})) < 0.01, false)
                        AND coalesce(value > 5, false) AS still,
                   coalesce(prediction > 1.0, false) AS c,
                   row_number() OVER ({O.SEQ}) AS seq
            FROM readings))"""))
def frozen_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DET2-DET4: frozen channel (|Δk| < 0.01 while value > 5) for 3+ steps, and a
    persistently high score (> 1.0 for more than 3 readings)."""
    out = DT.frozen_runs(_seq(spark, sf_dir), "k", 0.01, F.col("value") > 5, 3,
                         persistent={"high": (F.col("prediction") > 1.0, 3)})
    return out.select("event_id", "frozen_len", "frozen", "high_len", "high")


# --------------------------------------------------------------------------
# Labelled degradation (AUG1-AUG10) and detector evaluation
# --------------------------------------------------------------------------
def _curves() -> dict:
    p = F.col("p")
    k, c = AU.SIGMOID["pressure"]
    return {"click": AU.ramp(p), "error": AU.power(p), "purchase": AU.sigmoid(p, k, c),
            "signup": AU.saturating(p, AU.SATURATING["slat"]),
            "view": AU.root(p) * AU.decay_after(p)}


def _curves_sql() -> str:
    k, c = AU.SIGMOID["pressure"]
    return (f"CASE sensor WHEN 'click' THEN p WHEN 'error' THEN pow(p, {AU.POWER!r}) "
            f"WHEN 'purchase' THEN 1.0 / (1.0 + exp(-{k!r} * (p - {c!r}))) "
            f"WHEN 'signup' THEN 1.0 - exp(-{AU.SATURATING['slat']!r} * p) "
            "WHEN 'view' THEN sqrt(p) * (CASE WHEN p < 0.8 THEN 1.0 ELSE exp(-5.0 * (p - 0.8)) END) "
            "ELSE p END")


def augmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = T.readings(spark, sf_dir)
    return AU.degrade(r, _curves(), AU.fault_spec(r), "value", "k", "prediction")


_AUG_CTES = [
    """spec AS (SELECT asset_id, sensor, min("timestamp") + 864000.0 AS start, 864000.0 AS duration
           FROM readings GROUP BY asset_id, sensor)""",
    """base AS (
  SELECT r.*, s.start, s.duration, ("timestamp" - s.start) AS elapsed,
         coalesce("timestamp" - s.start >= 0, false) AS started,
         CASE WHEN coalesce("timestamp" - s.start >= 0, false)
              THEN least(("timestamp" - s.start) / s.duration, 1.0) ELSE 0.0 END AS p
  FROM readings r LEFT JOIN spec s USING (asset_id, sensor))""",
    """lck AS (SELECT asset_id, sensor, first(k ORDER BY ts, event_id) AS lock_k
          FROM base WHERE started AND p >= 0.7 GROUP BY asset_id, sensor)""",
    f"""aug AS (
  SELECT b.*,
         value * (1.0 + 0.5 * ({_curves_sql()}))
           + CASE WHEN started THEN (CASE WHEN elapsed / 86400.0 >= (duration / 86400.0) * 0.5
                                          THEN 0.5 * (elapsed / 86400.0 - (duration / 86400.0) * 0.5)
                                          ELSE 0.0 END) ELSE 0.0 END AS x_degraded,
         CASE WHEN started AND p >= 0.7 THEN l.lock_k ELSE k END AS frozen_degraded,
         CASE WHEN started THEN prediction * (1.0 - least(greatest((p - 0.7) / 0.1, 0.0), 1.0))
                                + 1.0 * least(greatest((p - 0.7) / 0.1, 0.0), 1.0)
              ELSE prediction END AS score_degraded,
         CASE WHEN NOT started THEN 'healthy' WHEN p < 0.3 THEN 'incipient'
              WHEN p < 0.7 THEN 'developing' ELSE 'critical' END AS stage,
         started AND p > 0 AS is_degraded
  FROM base b LEFT JOIN lck l USING (asset_id, sensor))"""]


@register("augment_degradation", O.with_readings("""
SELECT event_id, round(p, 6) AS p, round(x_degraded, 6) AS x_degraded, frozen_degraded,
       round(score_degraded, 6) AS score_degraded, stage, is_degraded
FROM aug""", *_AUG_CTES))
def augment_degradation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUG1-AUG10: degraded copy of every reading with curve, drift, freeze,
    blend and stage label."""
    a = augmented(spark, sf_dir)
    return a.select("event_id", r6("p").alias("p"), r6("x_degraded").alias("x_degraded"),
                    "frozen_degraded", r6("score_degraded").alias("score_degraded"), "stage",
                    "is_degraded")


def _eval_sql() -> str:
    hi = ("(CASE phase " + " ".join(f"WHEN '{p}' THEN {O.dbl(v['value'][1])}"
                                    for p, v in S.EVENT_PHASE_LIMITS.items()) + " END)")
    return O.with_readings(f"""
SELECT sensor,
       count(*) FILTER (WHERE det AND is_degraded) AS tp,
       count(*) FILTER (WHERE det AND NOT is_degraded) AS fp,
       count(*) FILTER (WHERE NOT det AND is_degraded) AS fn,
       count(*) FILTER (WHERE NOT det AND NOT is_degraded) AS tn,
       round(CAST(count(*) FILTER (WHERE det AND is_degraded) AS DOUBLE)
             / nullif(count(*) FILTER (WHERE det), 0), 6) AS "precision",
       round(CAST(count(*) FILTER (WHERE det AND is_degraded) AS DOUBLE)
             / nullif(count(*) FILTER (WHERE is_degraded), 0), 6) AS recall
FROM (SELECT *, coalesce(x_degraded > {hi}, false)
                 OR coalesce(score_degraded > {O.threshold_case()}, false) AS det FROM aug)
GROUP BY sensor""", *_AUG_CTES)


@register("augment_bias", O.with_readings("""
SELECT event_id, round(greatest(least(0.6 * least(m / 20000.0, 1.0) + 0.00001 * m, 0.5), -0.5), 6) AS bias,
       round(greatest(least(-0.9 * least(m / 20000.0, 1.0) + 0.00001 * m, 0.5), -0.5), 6) AS falling
FROM (SELECT event_id, ("timestamp" - min("timestamp") OVER (PARTITION BY asset_id, sensor)) / 60.0 AS m FROM readings)"""))
def augment_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUG1: bias ramp with drift, clamped to +-0.5; the key's first time is one partial aggregate."""
    r = T.readings(spark, sf_dir).select("event_id", "asset_id", "sensor", "timestamp")
    start = r.groupBy("asset_id", "sensor").agg(F.min("timestamp").alias("t0"))
    m = (F.col("timestamp") - F.col("t0")) / 60.0
    p = F.least(m / 20000.0, F.lit(1.0))
    return r.join(start, ["asset_id", "sensor"]).select(
        "event_id", r6(AU.clamped_bias(p, m, 0.6, 0.00001)).alias("bias"), r6(AU.clamped_bias(p, m, -0.9, 0.00001)).alias("falling"))


@register("detector_eval", _eval_sql())
def detector_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation: range + threshold detectors on degraded data against the
    degradation labels, per sensor (precision / recall)."""
    a = augmented(spark, sf_dir)
    hi = F.element_at(S.as_map_literal({p: v["value"][1] for p, v in S.EVENT_PHASE_LIMITS.items()}),
                      F.col("phase"))
    from ..sources.telemetry import threshold_of
    det = (F.coalesce(F.col("x_degraded") > hi, F.lit(False))
           | F.coalesce(F.col("score_degraded") > threshold_of(F.col("sensor")), F.lit(False)))
    a = a.withColumn("det", det)
    cnt = lambda c: F.count(F.when(c, 1))
    tp, fp = cnt(F.col("det") & F.col("is_degraded")), cnt(F.col("det") & ~F.col("is_degraded"))
    fn, tn = cnt(~F.col("det") & F.col("is_degraded")), cnt(~F.col("det") & ~F.col("is_degraded"))
    out = a.groupBy("sensor").agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    return out.select("sensor", "tp", "fp", "fn", "tn",
                      r6(F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))).alias("precision"),
                      r6(F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))).alias("recall"))


# --------------------------------------------------------------------------
# Streaming (SRC1, SNK1-SNK7, STR1-STR11) — each runs a real stream with
# ``availableNow`` over messages Spark derives from the events table.
# --------------------------------------------------------------------------
from ..sources import files as FS  # noqa: E402
from ..streaming import model_state as MS  # noqa: E402
from ..streaming import pipeline as P  # noqa: E402


def _stream_input(spark: SparkSession, sf_dir: str, kind: str) -> dict[str, str]:
    paths = P.stream_paths(spark, kind)
    r = T.readings(spark, sf_dir)
    r.select(T.envelope_json(r).alias("value")).write.text(paths["input"])
    return paths


@register("stream_window_closed", O.with_readings(f"""
SELECT {O.fmt_ts("time_bucket(INTERVAL '5 seconds', ts)")} AS "timestamp", sensor, phase,
       max(value) AS value, max(k) AS k, round(max(prediction), 6) AS score,
       bool_or(is_anomaly) AS is_anomaly
FROM readings
WHERE time_bucket(INTERVAL '5 seconds', ts) + INTERVAL 5 SECOND
      <= (SELECT max(ts) FROM readings) - INTERVAL 2 SECOND
GROUP BY ALL"""))
def stream_window_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1 + STR1-STR3 + STR5 + STR8 + SNK4: file stream -> decode -> 2 s
    watermark -> 5 s windows -> parquet (append: closed windows only)."""
    paths = _stream_input(spark, sf_dir, "monitoring")
    tel, _ = P.decoded(FS.telemetry_stream(spark, "text", paths["input"]))
    q = P.start_parquet(P.monitoring_rows(tel), paths["out"], f"{paths['ckpt']}/monitoring",
                        "monitoring", trigger={"availableNow": True})
    P.run_available([q])
    out = spark.read.parquet(paths["out"])
    return out.select(fmt("timestamp").alias("timestamp"), "sensor", "phase", "value", "k",
                      r6("score").alias("score"), "is_anomaly")


@register("stream_scored", _model_sql(_numbered(_READ_SEQ)))
def stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR6 + STR11 + SNK1 + SNK2: file stream -> decode -> keyed-state model
    (transformWithStateInPandas) -> foreachBatch fan-out to scored and alert sinks."""
    paths = _stream_input(spark, sf_dir, "scoring")
    tel, _ = P.decoded(FS.telemetry_stream(spark, "text", paths["input"]))
    # state shards sized to the fleet (one partial aggregate over the table)
    fleet = T.table(spark, sf_dir, "events").agg(F.count_distinct("user_id")).first()[0]
    scored = P.scored_stream(tel, shards=MS.fleet_shards(fleet))
    q = (scored.writeStream.queryName("scoring")
               .option("checkpointLocation", f"{paths['ckpt']}/scoring")
               .foreachBatch(P.fan_out_writer(paths["out"]))
               .trigger(availableNow=True).start())
    P.run_available([q])
    return _model_out(spark.read.parquet(f"{paths['out']}/scored"))


@register("json_log_roundtrip", O.with_readings(
    "SELECT event_id, sensor, value, k FROM readings"))
def json_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK7: readings appended as NDJSON per sensor, read back with the sensor
    restored from the folder name."""
    path = P.stream_paths(spark, "logs")["out"]
    r = T.readings(spark, sf_dir)
    FS.append_logs(r.select("event_id", "sensor", "timestamp", "value", "k"), path)
    back = FS.read_appended_logs(spark, path, "event_id long, timestamp double, value double, "
                                              "k double, sensor string")
    return back.select("event_id", "sensor", "value", "k")


@register("udf_scored_alerts", O.with_readings("""
SELECT event_id, sensor, round(value / 100.0, 6) AS udf_score FROM readings
WHERE value / 100.0 > 0.8"""))
def udf_scored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK6 / UDF1 + FIL1: an Arrow-batched user scorer, then the 0.8 cut-off."""
    r = T.readings(spark, sf_dir).select("event_id", "sensor", "value")
    scored = P.udf_scorer(r, lambda pdf: pdf["value"] / 100.0, ["value"])
    return L.global_alerts(scored, 0.8, "udf_score").select(
        "event_id", "sensor", r6("udf_score").alias("udf_score"))


def _wide_stream_sql() -> str:
    cols = ", ".join(f"max(CASE WHEN sensor = '{s}' THEN {f} END) AS {s}_{f}"
                     for s in S.EVENT_SENSORS for f in S.EVENT_FEATURES)
    return O.with_readings(f"""
SELECT {O.fmt_ts("time_bucket(INTERVAL '1 second', ts)")} AS "timestamp", {cols},
       round(max(prediction), 6) AS prediction,
       CAST(CAST(time_bucket(INTERVAL '1 second', ts) AS DATE) AS VARCHAR) AS "date"
FROM readings
WHERE time_bucket(INTERVAL '1 second', ts) + INTERVAL 1 SECOND
      <= (SELECT max(ts) FROM readings) - INTERVAL 2 SECOND
GROUP BY 1, time_bucket(INTERVAL '1 second', ts)""")


@register("stream_training_set", _wide_stream_sql())
def stream_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1 + STR1-STR3 + SNK4: 1-second wide training rows from the stream,
    appended to parquet partitioned by date (closed windows only)."""
    paths = _stream_input(spark, sf_dir, "training")
    tel, _ = P.decoded(FS.telemetry_stream(spark, "text", paths["input"]))
    q = P.start_parquet(P.training_rows(tel), paths["out"], f"{paths['ckpt']}/training",
                        "training", trigger={"availableNow": True}, partition_by=("date",))
    P.run_available([q])
    out = spark.read.parquet(paths["out"])
    return out.select(fmt("timestamp").alias("timestamp"),
                      *[f"{s}_{f}" for s in S.EVENT_SENSORS for f in S.EVENT_FEATURES],
                      r6("prediction").alias("prediction"),
                      F.col("date").cast("string").alias("date"))


@register("stream_monitoring_updates", REGISTRY["window_by_sensor_phase"][1])
def stream_monitoring_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4 + STR5 + STR6: 5-second windows in update mode (open windows are
    emitted too) written per batch; the consumer keeps each window's latest
    version."""
    paths = _stream_input(spark, sf_dir, "monitoring-updates")
    tel, _ = P.decoded(FS.telemetry_stream(spark, "text", paths["input"]))
    q = (P.monitoring_rows(tel).writeStream.outputMode("update")
           .option("checkpointLocation", f"{paths['ckpt']}/updates")
           .foreachBatch(P.upsert_writer(paths["out"])).trigger(availableNow=True).start())
    P.run_available([q])
    out = P.latest_versions(spark, paths["out"], ["timestamp", "sensor", "phase"])
    return out.select(fmt("timestamp").alias("timestamp"), "sensor", "phase", "value", "k",
                      r6("score").alias("score"), "is_anomaly")


# --------------------------------------------------------------------------
# Timelines (JON6 with long intervals, AGG8 silence)
# --------------------------------------------------------------------------
from ..operators import timeline as TL  # noqa: E402

# Campaigns relative to the first day of the data: years before it, ten days, a gap, and one without an end.
_CAMPAIGNS = [("shakedown", -800, 3), ("trial", 3, 13), ("service", 17, 30), ("later", 400, None)]


def _campaign_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS campaign, d0 + INTERVAL ({a}) DAY AS s, " + ("TIMESTAMP '9999-01-01'" if b is None else f"d0 + INTERVAL {b} DAY")
        + " AS e FROM d" for n, a, b in _CAMPAIGNS)
    return f"d AS (SELECT CAST(min(ts) AS DATE) AS d0 FROM readings), c AS ({rows})"


@register("campaign_asof_tag", O.with_readings(
    "SELECT r.event_id, c.campaign FROM readings r LEFT JOIN c ON r.ts >= c.s AND r.ts < c.e", _campaign_sql()))
def campaign_asof_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON6 with intervals of years: one row per interval in the shuffle, by the last start before each reading."""
    r = T.readings(spark, sf_dir).select("event_id", "ts")
    days = r.agg(F.to_date(F.min("ts")).cast("timestamp_ntz").alias("d0"))
    spans = F.array(*[F.struct(F.lit(n).alias("campaign"), F.lit(a).alias("a"), F.lit(b).cast("int").alias("b")) for n, a, b in _CAMPAIGNS])
    iv = days.select("d0", F.inline(spans)).select(
        "campaign", (F.col("d0") + F.make_dt_interval("a")).alias("start"), (F.col("d0") + F.make_dt_interval("b")).alias("end"))
    return TL.asof_tag(r, iv).select("event_id", "campaign")


_TICK = 6 * 3600


def _silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of six-hour ticks in which a known asset's sensor sent nothing."""
    r = T.readings(spark, sf_dir).select("asset_id", "sensor", TL.tick_of(F.col("timestamp"), _TICK).alias("tick"))
    span = r.agg(F.min("tick").alias("a"), F.max("tick").alias("b")).first()
    sensors = F.array(*[F.lit(s) for s in S.EVENT_SENSORS])
    expected = r.select("asset_id").filter("asset_id is not null").distinct().select("asset_id", F.explode(sensors).alias("sensor"))
    if span["a"] is None:
        return TL.silences(r, expected, 0, -1, ("asset_id", "sensor"))
    return TL.silences(r, expected, span["a"], span["b"], ("asset_id", "sensor"))


_SILENCE_CTES = f"""t AS (SELECT DISTINCT asset_id, sensor, CAST(floor("timestamp" / {_TICK}) AS BIGINT) AS tick FROM readings),
b AS (SELECT min(tick) AS a, max(tick) AS z FROM t),
x AS (SELECT asset_id, s.sensor FROM (SELECT DISTINCT asset_id FROM t WHERE asset_id IS NOT NULL),
      (SELECT unnest([{", ".join(f"'{s}'" for s in S.EVENT_SENSORS)}]) AS sensor) s),
g AS (SELECT x.asset_id, x.sensor, u.tick FROM x, (SELECT unnest(range(a, z + 1)) AS tick FROM b) u
      ANTI JOIN t ON t.asset_id = x.asset_id AND t.sensor = x.sensor AND t.tick = u.tick)"""


@register("silent_stretches", O.with_readings("""
SELECT asset_id, sensor, min(tick) AS from_tick, max(tick) AS to_tick, count(*) AS n_missing
FROM (SELECT *, tick - row_number() OVER (PARTITION BY asset_id, sensor ORDER BY tick) AS island FROM g) GROUP BY asset_id, sensor, island""",
                                              _SILENCE_CTES))
def silent_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8: silence of every expected sensor of every asset, also of those that never reported."""
    return _silence(spark, sf_dir)


@register("silent_ticks", O.with_readings("""
SELECT tick, asset_id, count(*) AS n_missing, array_to_string(list_sort(list(sensor)), ',') AS missing FROM g GROUP BY tick, asset_id""",
                                          _SILENCE_CTES))
def silent_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG8 per tick: the sensors of an asset that are missing, with ticks in which it sent nothing at all."""
    return TL.missing_per_tick(_silence(spark, sf_dir), ("asset_id", "sensor"), ("asset_id",))
