"""Registered queries of the ten-sensor wing feed.

The messages are derived from ``events`` in the wing feed's own envelope: no
asset, no event id, healthy key names before the firmware switch and faulty
ones after it, one sensor under two names, an unknown sensor (``gyro``) and
truncated lines. The SQL side states what every message means by its own
tables below (sensor, position of the key in the payload), independent of the
library's schema.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import feeds as FE
from .. import schema as S
from ..operators import aggregations as A
from ..operators import lookups as L
from ..operators import model as M
from ..session import small_methods
from ..sources import files as FS
from ..sources import telemetry as T
from ..streaming import pipeline as P
from . import oracle as O
from .catalog import _model_sql, fmt, r6, register

# Payload keys in message order, healthy firmware and, where it differs, faulty.
PAYLOADS = [
    ("accelerometer", ["accel_x (g)", "accel_y (g)", "accel_z (g)", "dominant_freq (Hz)", "rms (g)"], None),
    ("flutter", ["frequency_Hz", "amplitude_mm", "damping_ratio"], ["frequency (Hz)", "amplitude (mm)", "damping_ratio"]),
    ("fueltemp", ["temperature_C", "gradient_C_per_min", "jitter_C"],
     ["temperature (Degree C)", "gradient (Degree C/min)", "jitter (Degree C)"]),
    ("pressure", ["dynamic_pressure_Pa", "pressure_gradient_Pa_per_cm", "asymmetry_index_percent"],
     ["dynamic_pressure (Pa)", "pressure_gradient (Pa/cm)", "asymmetry_index (%)"]),
    ("flap", ["flap_angle", "motor_current", "hydraulic_pressure"], None),
    ("slat", ["commanded_angle_deg", "actual_angle_deg", "tracking_error_deg", "motor_current_A"], None),
    ("spoiler", ["commanded_angle_deg", "actual_angle_deg", "tracking_error_deg", "motor_current_A", "lag_ms"], None),
    ("spar", ["bending_moment_Nm", "shear_force_N", "axial_load_N"], None),
    ("wingtip_node", ["acceleration_g", "deflection_cm", "strain_microstrain"], None),
    ("wingtip_strain", ["strain_microstrain", "temperature_C", "snr_dB"], None),
]
NAMES = [s for s, _, _ in PAYLOADS]

# What the SQL side expects: feature -> (sensor, position of its key in the payload).
EXPECTED = {
    "accel_x": ("accelerometer", 0), "accel_y": ("accelerometer", 1), "accel_z": ("accelerometer", 2),
    "accel_freq": ("accelerometer", 3), "accel_rms": ("accelerometer", 4),
    "strain": ("wingtip_strain", 0), "strain_temp": ("wingtip_strain", 1), "snr": ("wingtip_strain", 2),
    "pressure": ("pressure", 0), "pressure_gradient": ("pressure", 1), "asymmetry": ("pressure", 2),
    "fuel_temp": ("fueltemp", 0), "fuel_gradient": ("fueltemp", 1), "fuel_jitter": ("fueltemp", 2),
    "flutter_freq": ("flutter", 0), "flutter_amp": ("flutter", 1), "flutter_damping": ("flutter", 2),
    "flap_angle": ("flap", 0), "flap_motor": ("flap", 1), "flap_pressure": ("flap", 2),
    "slat_cmd": ("slat", 0), "slat_actual": ("slat", 1), "slat_error": ("slat", 2), "slat_motor": ("slat", 3),
    "spoiler_lag": ("spoiler", 4),
    "spar_bending": ("spar", 0), "spar_shear": ("spar", 1), "spar_axial": ("spar", 2),
    "node_accel": ("wingtip_node", 0), "node_deflection": ("wingtip_node", 1), "node_strain": ("wingtip_node", 2),
}
MONITORED = ["accel_x", "accel_y", "accel_z", "strain", "pressure", "fuel_temp", "flutter_freq", "flap_angle",
             "slat_actual", "spoiler_lag", "spar_bending", "node_deflection"]
# Model: payload positions in scoring order, and the weights that are not 1.
MODEL_ORDER = {s: list(range(len(keys))) for s, keys, _ in PAYLOADS} | {"spoiler": [4, 0, 1, 2, 3]}
MODEL_WEIGHTS = {("flutter", 2): 3.0, ("wingtip_strain", 2): 2.5, ("pressure", 1): 2.0, ("slat", 2): 2.0,
                 ("spoiler", 2): 2.0, ("spoiler", 4): 2.5}
THRESHOLDS = {"accelerometer": 0.8, "flap": 5.0, "fueltemp": 1.2, "spar": 1.2, "slat": 1.5, "spoiler": 3.0,
              "flutter": 0.2, "wingtip_node": 1.5, "wingtip_strain": 0.3, "pressure": 0.5}
UPDATED = {"accelerometer": ["accel_x", "accel_y", "accel_z"], "flutter": ["flutter_freq"], "fueltemp": ["fuel_temp"],
           "wingtip_strain": ["strain"], "wingtip_node": ["node_deflection", "strain"], "pressure": ["pressure"],
           "flap": ["flap_angle"], "slat": ["slat_actual"], "spoiler": ["spoiler_lag"], "spar": ["spar_bending"]}


def messages(spark: SparkSession, sf_dir: str, value_of: Callable[[str, int], Column] | None = None,
             more: dict[str, Column] | None = None, keep: Sequence[str] = (), spread: bool = False) -> DataFrame:
    """One wing message (JSON text ``value``, and the columns ``keep``) per event. ``value_of`` gives a sensor's payload values by
    position, as expressions over the event's ``ts`` and ``value`` and the columns ``more`` derives from these. ``spread``
    shares out the events before their messages are built, however few row groups the table has."""
    e = T.table(small_methods(T.prepare(spark)), sf_dir, "events")
    if spread:
        e = e.select("event_id", "ts", "value", "props").repartition("event_id", "ts", "value")
    r = e.select("event_id", "ts", "value", T.epoch_seconds(F.col("ts")).alias("timestamp"), T.phase_of(F.col("ts")).alias("phase"),
                 F.coalesce(F.expr("try_cast(get_json_object(props, '$.k') AS DOUBLE)"), F.lit(0.0)).alias("wk"), *[c.alias(name) for name, c in (more or {}).items()])
    base = F.floor(F.col("value") * 8) / F.lit(8.0)
    faulty = F.col("ts") >= F.lit(S.FIRMWARE_SWITCH).cast("timestamp_ntz")

    def envelope(name, payload):
        return F.to_json(F.struct(F.col("timestamp"), name.alias("sensor"), payload.alias("value"),
                                  (F.floor("value") / F.lit(128.0)).alias("prediction"),
                                  (F.floor("value") / F.lit(128.0) > 1.0).alias("is_anomaly"), F.col("phase")))

    def payload(sensor, keys):
        extra = [F.lit("OK").alias("status"), F.col("phase")]
        value = value_of or (lambda _, j: base * (j + 1) + F.col("wk"))
        return F.struct(*[value(sensor, j).alias(key) for j, key in enumerate(keys)], *extra)

    text = None
    for i, (sensor, healthy, broken) in enumerate(PAYLOADS):
        name = F.lit(sensor)
        if sensor == "pressure":
            name = F.when(F.col("event_id") % 20 == i, F.lit("wing_surface_pressure")).otherwise(name)
        one = envelope(name, payload(sensor, healthy))
        if broken:
            one = F.when(faulty, envelope(name, payload(sensor, broken))).otherwise(one)
        cond = F.col("event_id") % 10 == i
        text = F.when(cond, one) if text is None else text.when(cond, one)
    gyro = envelope(F.lit("gyro"), F.struct(base.alias("rate_dps")))
    whole = F.when(F.col("event_id") % 50 == 48, gyro).otherwise(text)
    line = F.when(F.col("event_id") % 50 == 49, F.substring(whole, 1, 40)).otherwise(whole)
    return r.select(line.alias("value"), *keep)


_SENSOR = ("CASE WHEN event_id % 50 = 48 THEN 'gyro' "
           + " ".join(f"WHEN event_id % 10 = {i} THEN '{s}'" for i, s in enumerate(NAMES)) + " END")
WING_CTE = f"""w AS (
  SELECT event_id, ts, value, epoch_us(ts) / 1e6 AS "timestamp", {_SENSOR} AS sensor, {O.phase_sql()} AS phase,
         floor(value * 8) / 8.0 AS b, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0) AS k,
         floor(value) / 128.0 AS prediction, floor(value) / 128.0 > 1.0 AS is_anomaly
  FROM events WHERE event_id % 50 <> 49)"""


def _value(sensor: str, j: int) -> str:
    return f"CASE WHEN sensor = '{sensor}' THEN b * {j + 1} + k END"


def _monitored(f: str) -> str:
    if f == "strain":            # both strain sensors report it
        return "CASE WHEN sensor = 'wingtip_strain' THEN b + k WHEN sensor = 'wingtip_node' THEN b * 3 + k END"
    return _value(*EXPECTED[f])


def _tel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.telemetry(messages(spark, sf_dir), FE.WING)[0]


@register("wing_decode", f"""WITH {WING_CTE}
SELECT round("timestamp", 6) AS "timestamp", sensor, phase, prediction, is_anomaly,
       {", ".join(f"{_value(*at)} AS {f}" for f, at in EXPECTED.items())} FROM w""")
def wing_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ1-PRJ10 on the wing feed: 31 features, each filled by its own sensor only."""
    return _tel(spark, sf_dir).select(r6("timestamp").alias("timestamp"), "sensor", "phase", "prediction", "is_anomaly",
                                      *EXPECTED)


@register("wing_dead_letters", """
SELECT event_id % 50 = 49 AS dead, count(*) AS n FROM events GROUP BY 1""")
def wing_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIL8: truncated lines are kept as dead letters, all others decode."""
    good, dead = FE.telemetry(messages(spark, sf_dir), FE.WING)
    rows = good.select(F.lit(False).alias("dead")).unionByName(dead.select(F.lit(True).alias("dead")))
    return rows.groupBy("dead").agg(F.count(F.lit(1)).alias("n"))


_MONITOR_SQL = f"""SELECT {O.fmt_ts("time_bucket(INTERVAL '5 seconds', ts)")} AS "timestamp", sensor, phase,
       {", ".join(f"max({_monitored(f)}) AS {f}" for f in MONITORED)}, max(prediction) AS score, bool_or(is_anomaly) AS is_anomaly
FROM w GROUP BY 1, 2, 3, time_bucket(INTERVAL '5 seconds', ts)"""


def _monitoring(tel: DataFrame) -> DataFrame:
    return A.window_rows(FE.monitoring_input(tel, FE.WING), "5 seconds", features=MONITORED)


@register("wing_monitoring", f"WITH {WING_CTE} {_MONITOR_SQL}")
def wing_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2 + AGG3 on the wing feed: the 12-feature monitoring row."""
    return _monitoring(_tel(spark, sf_dir)).withColumn("timestamp", fmt("timestamp"))


_TRAINING = ", ".join(f"max({_value(*at)}) AS {f}" for f, at in EXPECTED.items())


@register("wing_training_set", f"""WITH {WING_CTE}
SELECT {O.fmt_ts("time_bucket(INTERVAL '1 second', ts)")} AS "timestamp", {_TRAINING}, max(prediction) AS prediction
FROM w GROUP BY 1, time_bucket(INTERVAL '1 second', ts)""")
def wing_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1: the 31-feature training row per second."""
    return FE.training_row(_tel(spark, sf_dir), FE.WING).withColumn("timestamp", fmt("timestamp"))


_RUNS: dict[tuple[str, str], str] = {}


def _run_feed(spark: SparkSession, sf_dir: str) -> str:
    """The sink folder of the whole job over the messages as a stream. The job runs once per application
    and input; the queries below read its different sinks."""
    run = (spark.sparkContext.applicationId, sf_dir)
    if run not in _RUNS:
        T.prepare(spark)
        paths = P.stream_paths(spark, "wing")
        messages(spark, sf_dir).write.text(paths["input"])
        P.run_available(P.start_feed(spark, FS.telemetry_stream(spark, "text", paths["input"]), paths["out"], FE.WING,
                                     trigger={"availableNow": True}))
        _RUNS[run] = paths["out"]
    T.prepare(spark)
    return _RUNS[run]


@register("wing_stream_training_set", f"""WITH {WING_CTE}
SELECT {O.fmt_ts("time_bucket(INTERVAL '1 second', ts)")} AS "timestamp", {_TRAINING}, max(prediction) AS prediction
FROM w WHERE time_bucket(INTERVAL '1 second', ts) + INTERVAL 1 SECOND <= (SELECT max(ts) FROM w) - INTERVAL 2 SECOND
GROUP BY 1, time_bucket(INTERVAL '1 second', ts)""")
def wing_stream_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK4 on the wing feed: closed one-second windows of the running job."""
    return spark.read.parquet(f"{_run_feed(spark, sf_dir)}/training").select(
        fmt("timestamp").alias("timestamp"), *EXPECTED, "prediction")


def _case(values: dict[str, str], default: str) -> str:
    if not values:
        return default
    return "CASE sensor " + " ".join(f"WHEN '{s}' THEN {v}" for s, v in values.items()) + f" ELSE {default} END"


_SLOTS = [f"f{i}" for i in range(5)]
_SEQ = "SELECT *, row_number() OVER (PARTITION BY sensor, phase ORDER BY ts, kind, event_id) AS rn FROM ({rows})"
_READING_ROWS = 'SELECT event_id, ts, "timestamp", sensor, phase, 1 AS kind, ' + _case({s: O.dbl(v) for s, v in THRESHOLDS.items()}, "CAST(1.0 AS DOUBLE)") + " AS threshold, " + ", ".join(
        _case({s: f"b * {o[i] + 1} + k" for s, o in MODEL_ORDER.items() if i < len(o)}, "CAST(NULL AS DOUBLE)") + f" AS x_f{i}, "
        + _case({s: O.dbl(MODEL_WEIGHTS[s, o[i]]) for s, o in MODEL_ORDER.items() if i < len(o) and (s, o[i]) in MODEL_WEIGHTS},
                "CAST(1.0 AS DOUBLE)") + f" AS w_f{i}" for i in range(5)) + " FROM w"


def _scored_sql(select: str, rows: str = _READING_ROWS) -> str:
    return _model_sql(_SEQ.format(rows=rows), [WING_CTE], _SLOTS, lambda f: f"s.w_{f}", ["sensor", "phase"], {"timestamp": "DOUBLE"}, select)


@register("wing_scored", _scored_sql(
    'SELECT round("timestamp", 6) AS "timestamp", sensor, phase, round(score, 6) AS score, anomaly AS is_anomaly FROM fold WHERE rn > 0'))
def wing_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA2-STA4 + SNK1: scored messages of the running job, read back from the JSON sink."""
    text = spark.read.text(f"{_run_feed(spark, sf_dir)}/scored/scored_messages")
    m = text.select(F.from_json("value", "timestamp double, sensor string, value string, prediction double, "
                                "is_anomaly boolean, phase string").alias("m")).select("m.*")
    return m.select(r6("timestamp").alias("timestamp"), "sensor", "phase", r6("prediction").alias("score"), "is_anomaly")


@register("wing_alerts", _scored_sql(
    """SELECT round(f."timestamp", 6) AS "timestamp", f.sensor, round(f.score, 6) AS prediction,
       'Anomaly detected in ' || f.sensor AS message, s.x_f0 AS first_value
FROM fold f JOIN seq s ON s.sensor = f.sensor AND s.phase = f.phase AND s.rn = f.rn WHERE f.rn > 0 AND f.anomaly"""))
def wing_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2 + PRJ15: alert messages of the running job with the payload they quote."""
    text = spark.read.text(f"{_run_feed(spark, sf_dir)}/scored/alert_messages")
    m = text.select(F.from_json("value", "timestamp double, sensor string, prediction double, value string, message string")
                    .alias("m")).select("m.*").withColumn("p", F.from_json("value", "map<string,string>"))
    first = None
    for s, keys, broken in PAYLOADS:
        at = MODEL_ORDER[s][0]
        v = F.coalesce(*[F.try_element_at("p", F.lit(k)) for k in ([keys[at]] + ([broken[at]] if broken else []))]).try_cast("double")
        cond = F.col("sensor") == s
        first = F.when(cond, v) if first is None else first.when(cond, v)
    return m.select(r6("timestamp").alias("timestamp"), "sensor", r6("prediction").alias("prediction"), "message",
                    first.alias("first_value"))


@register("wing_updates", f"""WITH {WING_CTE}, m AS ({_MONITOR_SQL})
{" UNION ALL ".join(f"SELECT timestamp, sensor, phase, score, is_anomaly, '{f}' AS feature, {f} AS fvalue FROM m WHERE sensor = '{s}' AND {f} IS NOT NULL" for s, fs in UPDATED.items() for f in fs)}""")
def wing_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3 + PRJ12-PRJ14 + FIL3 + FIL5 + SRC2: model-update messages of the running job, the latest version of
    each window, read back as the update source reads them; the unknown sensor has none."""
    out = _run_feed(spark, sf_dir)
    text = spark.read.text(f"{out}/updates")
    u = text.select(F.from_json("value", S.UPDATE_MESSAGE).alias("u"), "batch").select("u.*", "batch")
    cols = ["timestamp", "sensor", "phase", "score", "is_anomaly", "features"]
    last = u.groupBy("timestamp", "sensor", "phase").agg(F.max_by(F.struct(*cols), "batch").alias("r")).select("r.*")
    return last.select("timestamp", "sensor", "phase", "score", "is_anomaly", F.explode("features").alias("feature", "fvalue"))
