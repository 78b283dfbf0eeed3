"""Schemas and constant lookup tables.

Two families of sensors share every table:

* the ten wing sensors of the aircraft telemetry feed (their values below are
  fixed values that results must agree with), and
* the five sensors of the telemetry derived from the ``events`` table
  (``event_type`` plays the sensor); their values are this library's own.

Lookup tables are tiny and bounded by the number of sensors x phases x
features, never by the data, so they are safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Envelope: one telemetry message. All fields nullable; a malformed line
# decodes to all NULLs.
# --------------------------------------------------------------------------
ENVELOPE = T.StructType([
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("sensor", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("phase", T.StringType()),
    # Not in the aircraft envelope; derived telemetry names the asset and the
    # source event so that ordering ties can be broken deterministically.
    T.StructField("asset_id", T.LongType()),
    T.StructField("event_id", T.LongType()),
])

PAYLOAD_MAP = T.MapType(T.StringType(), T.StringType())

UPDATE_MESSAGE = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("sensor", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("phase", T.StringType()),
    T.StructField("features", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("asset_id", T.LongType()),
    T.StructField("version", T.LongType()),
])

PHASES = ("takeoff", "cruise", "landing")

# --------------------------------------------------------------------------
# Wing-sensor anomaly thresholds (score > threshold is an
# anomaly; sensors not listed use DEFAULT_THRESHOLD).
# --------------------------------------------------------------------------
WING_THRESHOLDS = {
    "accelerometer": 0.8,
    "flap": 5.0,
    "fueltemp": 1.2,
    "spar": 1.2,
    "slat": 1.5,
    "spoiler": 3.0,
    "flutter": 0.2,
    "wingtip_node": 1.5,
    "wingtip_strain": 0.3,
    "pressure": 0.5,
}
DEFAULT_THRESHOLD = 1.0

# Feature weights in the score (features not listed: 1.0). They
# belong to the quantity, so they are kept under its clean name, which every raw key leads to.
WING_WEIGHTS = {
    "flutter_damping": 3.0,
    "snr": 2.5,
    "pressure_gradient": 2.0,
    "slat_error": 2.0,
    "spoiler_error": 2.0,
    "spoiler_lag": 2.5,
    "accel_x": 1.0,
    "accel_y": 1.0,
    "accel_z": 1.0,
}
DEFAULT_WEIGHT = 1.0

# Edge rename map, raw payload key -> clean feature name.
# Keys not listed keep their raw name.
WING_KEY_MAP = {
    "accel_x (g)": "accel_x",
    "accel_y (g)": "accel_y",
    "accel_z (g)": "accel_z",
    "strain_microstrain": "strain",
    "dynamic_pressure_Pa": "pressure",
    "temperature_C": "fuel_temp",
    "frequency (Hz)": "flutter_freq",
    "flap_angle": "flap_angle",
    "actual_angle_deg": "slat_actual",
    "lag_ms": "spoiler_lag",
    "bending_moment_Nm": "spar_bending",
    "deflection_cm": "node_deflection",
}

# Features each wing sensor reports in a model update.
WING_UPDATE_FEATURES = {
    "accelerometer": ["accel_x", "accel_y", "accel_z"],
    "flutter": ["flutter_freq"],
    "fueltemp": ["fuel_temp"],
    "wingtip_strain": ["strain"],
    "wingtip_node": ["node_deflection", "strain"],
    "pressure": ["pressure"],
    "flap": ["flap_angle"],
    "slat": ["slat_actual"],
    "spoiler": ["spoiler_lag"],
    "spar": ["spar_bending"],
}

# The training row of the wing feed, as
# (sensor, feature, raw keys in priority order). Healthy and faulty firmware
# publish different raw keys for the same quantity; the first non-null wins.
WING_ALIASES = [
    ("accelerometer", "accel_x", ["accel_x (g)"]),
    ("accelerometer", "accel_y", ["accel_y (g)"]),
    ("accelerometer", "accel_z", ["accel_z (g)"]),
    ("accelerometer", "accel_freq", ["dominant_freq (Hz)"]),
    ("accelerometer", "accel_rms", ["rms (g)"]),
    ("wingtip_strain", "strain", ["strain_microstrain"]),
    ("wingtip_strain", "strain_temp", ["temperature_C"]),
    ("wingtip_strain", "snr", ["snr_dB"]),
    ("pressure", "pressure", ["dynamic_pressure_Pa", "dynamic_pressure (Pa)"]),
    ("pressure", "pressure_gradient", ["pressure_gradient_Pa_per_cm", "pressure_gradient (Pa/cm)"]),
    ("pressure", "asymmetry", ["asymmetry_index_percent", "asymmetry_index (%)"]),
    ("fueltemp", "fuel_temp", ["temperature_C", "temperature (Degree C)"]),
    ("fueltemp", "fuel_gradient", ["gradient_C_per_min", "gradient (Degree C/min)"]),
    ("fueltemp", "fuel_jitter", ["jitter_C", "jitter (Degree C)"]),
    ("flutter", "flutter_freq", ["frequency_Hz", "frequency (Hz)"]),
    ("flutter", "flutter_amp", ["amplitude_mm", "amplitude (mm)"]),
    ("flutter", "flutter_damping", ["damping_ratio"]),
    ("flap", "flap_angle", ["flap_angle"]),
    ("flap", "flap_motor", ["motor_current"]),
    ("flap", "flap_pressure", ["hydraulic_pressure"]),
    ("slat", "slat_cmd", ["commanded_angle_deg"]),
    ("slat", "slat_actual", ["actual_angle_deg"]),
    ("slat", "slat_error", ["tracking_error_deg"]),
    ("slat", "slat_motor", ["motor_current_A"]),
    ("spoiler", "spoiler_lag", ["lag_ms"]),
    ("spar", "spar_bending", ["bending_moment_Nm"]),
    ("spar", "spar_shear", ["shear_force_N"]),
    ("spar", "spar_axial", ["axial_load_N"]),
    ("wingtip_node", "node_accel", ["acceleration_g"]),
    ("wingtip_node", "node_deflection", ["deflection_cm"]),
    ("wingtip_node", "node_strain", ["strain_microstrain"]),
]
# Readings that only the model uses, beside those of the training row.
WING_MODEL_ONLY = [
    ("spoiler", "spoiler_cmd", ["commanded_angle_deg"]),
    ("spoiler", "spoiler_actual", ["actual_angle_deg"]),
    ("spoiler", "spoiler_error", ["tracking_error_deg"]),
    ("spoiler", "spoiler_motor", ["motor_current_A"]),
]
# Features of the monitoring row. Both strain sensors share "strain".
WING_MONITORING = [
    "accel_x", "accel_y", "accel_z", "strain", "pressure", "fuel_temp",
    "flutter_freq", "flap_angle", "slat_actual", "spoiler_lag", "spar_bending", "node_deflection",
]
WING_SENSOR_NAMES = {
    "wing_surface_pressure": "pressure",
    "surface_pressure": "pressure",
}

# Healthy ranges per (sensor, phase, feature) -> (lo, hi). A single
# documented value is a range of that value; "about" values of the spar in cruise take the sixth part that
# its bending range states.
WING_PHASE_LIMITS = [
    ("flap", "takeoff", "flap_angle", 15.0, 15.0),
    ("flap", "takeoff", "flap_pressure", 2700.0, 3450.0),
    ("flap", "takeoff", "flap_motor", 1.5, 2.5),
    ("flap", "cruise", "flap_angle", 0.0, 0.0),
    ("flap", "cruise", "flap_pressure", 0.0, 0.0),
    ("flap", "cruise", "flap_motor", 0.0, 0.0),
    ("flap", "landing", "flap_angle", 30.0, 30.0),
    ("flap", "landing", "flap_pressure", 3000.0, 3450.0),
    ("flap", "landing", "flap_motor", 2.0, 3.0),
    ("slat", "takeoff", "slat_cmd", 12.5, 12.5),
    ("slat", "takeoff", "slat_motor", 0.2, 4.5),
    ("slat", "cruise", "slat_cmd", 0.0, 0.0),
    ("slat", "cruise", "slat_motor", 0.0, 0.0),
    ("slat", "landing", "slat_cmd", 6.0, 10.0),
    ("slat", "landing", "slat_motor", 0.3, 4.5),
    ("spoiler", "takeoff", "spoiler_cmd", 0.0, 0.0),
    ("spoiler", "takeoff", "spoiler_actual", 0.0, 0.0),
    ("spoiler", "takeoff", "spoiler_motor", 0.0, 0.0),
    ("spoiler", "takeoff", "spoiler_lag", 0.0, 0.0),
    ("spoiler", "cruise", "spoiler_cmd", 0.0, 3.0),
    ("spoiler", "cruise", "spoiler_motor", 0.0, 0.8),
    ("spoiler", "cruise", "spoiler_lag", 15.0, 45.0),
    ("spoiler", "landing", "spoiler_cmd", 30.0, 60.0),
    ("spoiler", "landing", "spoiler_motor", 1.5, 4.5),
    ("spoiler", "landing", "spoiler_lag", 20.0, 150.0),
    ("pressure", "takeoff", "pressure", 160.0, 1100.0),
    ("pressure", "takeoff", "pressure_gradient", 1.4, 2.6),
    ("pressure", "takeoff", "asymmetry", 0.0, 0.20),
    ("pressure", "cruise", "pressure", 1050.0, 1150.0),
    ("pressure", "cruise", "pressure_gradient", 3.3, 3.9),
    ("pressure", "cruise", "asymmetry", 0.0, 0.08),
    ("pressure", "landing", "pressure", 970.0, 1200.0),
    ("pressure", "landing", "pressure_gradient", 3.9, 4.2),
    ("pressure", "landing", "asymmetry", 0.0, 0.12),
    ("fueltemp", "takeoff", "fuel_temp", 9.0, 12.0),
    ("fueltemp", "cruise", "fuel_temp", -20.0, -5.0),
    ("fueltemp", "landing", "fuel_temp", -4.0, 2.0),
    ("spar", "takeoff", "spar_bending", 8000.0, 53000.0),
    ("spar", "takeoff", "spar_shear", 4000.0, 24000.0),
    ("spar", "takeoff", "spar_axial", 6000.0, 41000.0),
    ("spar", "cruise", "spar_bending", 10000.0, 14000.0),
    ("spar", "cruise", "spar_shear", 5000.0, 7000.0),
    ("spar", "cruise", "spar_axial", 6667.0, 9333.0),
    ("spar", "landing", "spar_bending", 35000.0, 62000.0),
    ("spar", "landing", "spar_shear", 18000.0, 28000.0),
    ("spar", "landing", "spar_axial", -25000.0, 50000.0),
    ("wingtip_strain", "takeoff", "strain", 350.0, 450.0),
    ("wingtip_strain", "takeoff", "strain_temp", 15.0, 35.0),
    ("wingtip_strain", "takeoff", "snr", 22.0, 28.0),
    ("wingtip_strain", "cruise", "strain", 80.0, 120.0),
    ("wingtip_strain", "cruise", "strain_temp", -30.0, -10.0),
    ("wingtip_strain", "cruise", "snr", 28.0, 35.0),
    ("wingtip_strain", "landing", "strain", 310.0, 390.0),
    ("wingtip_strain", "landing", "strain_temp", -10.0, 25.0),
    ("wingtip_strain", "landing", "snr", 20.0, 27.0),
    ("wingtip_node", "takeoff", "node_accel", 0.6, 2.5),
    ("wingtip_node", "takeoff", "node_deflection", 15.0, 55.0),
    ("wingtip_node", "takeoff", "node_strain", 0.0, 400.0),
    ("wingtip_node", "cruise", "node_accel", 0.18, 0.85),
    ("wingtip_node", "cruise", "node_deflection", 38.0, 90.0),
    ("wingtip_node", "cruise", "node_strain", 125.0, 325.0),
    ("wingtip_node", "landing", "node_accel", 0.6, 2.0),
    ("wingtip_node", "landing", "node_deflection", 15.0, 78.0),
    ("wingtip_node", "landing", "node_strain", 0.0, 380.0),
]

# Failure rules of the wing feed, one per row: (rule, sensor, condition, consecutive readings it must hold).
# The condition is a SQL expression over the sensor's channels; ``prev_x`` and ``prev2_x`` are the
# channel's one and two readings before, ``std5_x`` and ``swing5_x`` its sample deviation and its
# max - min over the latest five readings. Numbers are fixed values, except
# tolerances of "near" (a tenth, or a half of the 0.04 A), the 0.1 degree of a changing command and the three
# readings that stand for "multiple".
WING_RULES = [
    ("flap_frozen", "flap", "abs(flap_angle - prev_flap_angle) < 0.01", 3),
    ("flap_pressure_flat", "flap", "abs(flap_pressure - 80) <= 8", 3),
    ("flap_current_collapsed", "flap", "abs(flap_motor - 0.04) <= 0.02", 3),
    ("slat_current_low", "slat", "slat_motor < 0.15 AND slat_cmd > 1", 1),
    ("slat_frozen", "slat", "abs(slat_actual - prev_slat_actual) < 0.05 AND abs(slat_cmd - prev_slat_cmd) > 0.1", 3),
    ("spoiler_frozen", "spoiler", "abs(spoiler_actual - prev_spoiler_actual) < 0.05 AND spoiler_cmd > 5", 3),
    ("spoiler_constant_error", "spoiler", "abs(spoiler_error) > 0.5 AND abs((spoiler_cmd - spoiler_error) "
     "- (prev_spoiler_cmd - prev_spoiler_error)) < 0.05", 3),
    ("spoiler_no_current", "spoiler", "spoiler_motor = 0 AND spoiler_cmd > 5", 1),
    ("spoiler_lag_high", "spoiler", "spoiler_lag > 800", 3),
    ("pressure_pinned", "pressure", "pressure >= 0.99 * CASE phase WHEN 'takeoff' THEN 1100 WHEN 'cruise' THEN 1150 "
     "WHEN 'landing' THEN 1200 END", 3),
    ("pressure_asymmetry", "pressure", "asymmetry >= CASE phase WHEN 'takeoff' THEN 0.2D WHEN 'cruise' THEN 0.08D "
     "WHEN 'landing' THEN 0.12D END", 3),
    ("pressure_gradient_swing", "pressure", "pressure_gradient < -4.2 AND (prev_pressure_gradient > 4.2 OR "
     "prev2_pressure_gradient > 4.2)", 1),
    ("spar_overload", "spar", "phase = 'cruise' AND spar_bending > 65000", 1),
    ("spar_ratio", "spar", "spar_bending <> 0 AND abs(spar_shear - 0.5D * spar_bending) > 0.2D * abs(spar_bending)", 1),
    ("spar_axial_swing", "spar", "swing5_spar_axial > 15000", 1),
    ("strain_snr_low", "wingtip_strain", "snr < 19", 4),
    ("strain_noisy", "wingtip_strain", "std5_strain > 35", 1),
    ("strain_implausible", "wingtip_strain", "(phase = 'landing' AND strain <= 0) OR (phase = 'cruise' AND strain >= 480)", 1),
    ("node_impossible", "wingtip_node", "node_deflection >= 87 AND node_accel < 0.5", 1),
    ("node_strain_high", "wingtip_node", "phase = 'cruise' AND node_strain > 370", 1),
    ("node_jump", "wingtip_node", "abs(node_deflection - prev_node_deflection) > 4.5", 1),
]

# Accepted command lag of the spoiler by phase (ms), the stall time and the limits of its test.
SPOILER_LAG_LIMITS = {"cruise": 100.0, "landing": 200.0}
SPOILER_LAG_DEFAULT = 100.0
SPOILER_STALL_SECONDS = 2.0

# Fuel-temperature gradient limit per phase (deg C / min).
FUEL_GRADIENT_LIMITS = {"takeoff": 0.8, "cruise": 0.3, "landing": 0.6}

# --------------------------------------------------------------------------
# Derived telemetry (this library's own values). ``event_type`` is the
# sensor, ``user_id`` the asset; each reading has two features.
# --------------------------------------------------------------------------
EVENT_SENSORS = ("click", "error", "purchase", "signup", "view")
EVENT_FEATURES = ("value", "k")

EVENT_THRESHOLDS = {
    "click": 0.8,
    "error": 1.2,
    "purchase": 1.5,
    "signup": 3.0,
    "view": 5.0,
}
EVENT_WEIGHTS = {"value": 1.0, "k": 2.0}

# Healthy firmware publishes ``value``/``k``; from FIRMWARE_SWITCH on, the
# payload keys carry units (the faulty-path naming). ``error`` sends a bare
# scalar payload (just the reading), exercising the scalar path.
FIRMWARE_SWITCH = "2024-01-21 00:00:00"
EVENT_RAW_KEYS = {"value": ["value", "value (units)"], "k": ["k", "k (count)"]}
EVENT_KEY_MAP = {"value (units)": "value", "k (count)": "k"}
SCALAR_SENSORS = ("error",)

# Phase of a reading from its hour of day (UTC): [0,8) takeoff,
# [8,16) cruise, [16,24) landing.
PHASE_HOURS = (("takeoff", 0, 8), ("cruise", 8, 16), ("landing", 16, 24))

# Healthy ranges for derived telemetry, per phase: feature -> (lo, hi).
EVENT_PHASE_LIMITS = {
    "takeoff": {"value": (0.5, 150.0), "k": (1.0, 98.0)},
    "cruise": {"value": (0.5, 120.0), "k": (1.0, 98.0)},
    "landing": {"value": (0.5, 180.0), "k": (1.0, 98.0)},
}

# Edge score carried in the envelope of derived telemetry.
PREDICTION_SCALE = 100.0


def all_thresholds() -> dict[str, float]:
    return {**WING_THRESHOLDS, **EVENT_THRESHOLDS}


def all_weights() -> dict[str, float]:
    """Weights under the clean names and under every raw key of the same quantity."""
    raw = {key: WING_WEIGHTS[f] for _, f, keys in WING_ALIASES + WING_MODEL_ONLY for key in keys if f in WING_WEIGHTS}
    return {**raw, **WING_WEIGHTS, **EVENT_WEIGHTS}


def event_aliases() -> list[tuple[str, str, list[str]]]:
    return [(s, f, EVENT_RAW_KEYS[f]) for s in EVENT_SENSORS for f in EVENT_FEATURES]


def event_update_features() -> dict[str, list[str]]:
    return {s: (["value"] if s in SCALAR_SENSORS else list(EVENT_FEATURES))
            for s in EVENT_SENSORS}


def event_phase_limits() -> list[tuple[str, str, str, float, float]]:
    return [(s, p, f, lo, hi)
            for s in EVENT_SENSORS
            for p, feats in EVENT_PHASE_LIMITS.items()
            for f, (lo, hi) in feats.items()]


# --------------------------------------------------------------------------
# Lookup tables as DataFrames (small, bounded, broadcast on use).
# --------------------------------------------------------------------------
def threshold_table(spark: SparkSession) -> DataFrame:
    rows = sorted(all_thresholds().items())
    return spark.createDataFrame(rows, "sensor string, threshold double")


def sensor_table(spark: SparkSession) -> DataFrame:
    """Sensors that have a model (one row per sensor)."""
    return spark.createDataFrame([(s,) for s in sorted(all_thresholds())], "sensor string")


def update_feature_table(spark: SparkSession) -> DataFrame:
    feats = {**WING_UPDATE_FEATURES, **event_update_features()}
    rows = [(s, f) for s, fs in sorted(feats.items()) for f in fs]
    return spark.createDataFrame(rows, "sensor string, feature string")


def phase_limit_table(spark: SparkSession) -> DataFrame:
    rows = WING_PHASE_LIMITS + event_phase_limits()
    return spark.createDataFrame(rows, "sensor string, phase string, feature string, lo double, hi double")


def as_map_literal(d: dict) -> F.Column:
    """A literal MAP column from a small python dict."""
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)
