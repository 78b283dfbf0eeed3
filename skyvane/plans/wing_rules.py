"""Registered queries of the failure rules on the wing feed (WIN12, DET1-DET8).

The readings are those of :func:`skyvane.plans.wing.messages` with every channel moved into its own
range. Days take turns: steady, stuck (channels hold one value until noon and another
after), drifting through the day, and scattered, so each rule has days on which it fires and days on which
it must not. The SQL side states channels, ranges and rules by its own tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import feeds as FE
from .. import schema as S
from ..operators import moments as MO
from ..operators import ordered as W
from ..operators import rules as R
from . import oracle as O
from .catalog import r6, register
from .wing import EXPECTED, NAMES, WING_CTE, messages

# Value = base + span * level, by sensor and position in the payload.
FLIGHT = {
    "accelerometer": [(0.0, 1.0)] * 5,
    "flutter": [(0.0, 8.0), (0.0, 8.0), (0.0, 0.25)],
    "fueltemp": [(-16.0, 32.0), (-0.5, 1.0), (0.0, 0.25)],
    "pressure": [(960.0, 256.0), (-8.0, 16.0), (0.0, 0.25)],
    "flap": [(0.0, 32.0), (0.04, 3.0), (80.0, 3456.0)],
    "slat": [(0.0, 16.0), (0.0, 12.0), (0.0, 4.0), (1.0, -2.0)],
    "spoiler": [(0.0, 64.0), (0.0, 48.0), (0.0, 16.0), (2.0, -4.0), (1024.0, -2048.0)],
    "spar": [(0.0, 64000.0), (0.0, 32000.0), (0.0, 32768.0)],
    "wingtip_node": [(0.0, 2.0), (30.0, 64.0), (0.0, 400.0)],
    "wingtip_strain": [(0.0, 512.0), (-32.0, 64.0), (16.0, 16.0)],
}
# The one channel that keeps moving on stuck days.
MOVING = ("slat", 0)


def levels() -> dict[str, Column]:
    """Where channels stand in their range: 0 to 1 is inside. Multiples of 1/32, so both engines agree."""
    day, hour, u = F.dayofmonth("ts") % 4, F.hour("ts"), F.floor("value")

    def by_day(stuck: Column, j: int) -> Column:
        return (F.when(day == 0, F.lit(0.25) + (u % 8) / F.lit(16.0)).when(day == 1, stuck)
                .when(day == 2, hour * F.lit(0.09375)).otherwise(F.lit(-0.5) + (u + 3 * j) % 8 / F.lit(4.0)))

    still = F.when(hour < 12, F.lit(0.5)).otherwise(F.lit(0.0))
    return {f"level{j}": by_day(still, j) for j in range(5)} | {"level_moving": by_day(u % 8 / F.lit(8.0), MOVING[1])}


def flight_value(sensor: str, j: int) -> Column:
    base, span = FLIGHT[sensor][j]
    return F.lit(base) + F.lit(span) * F.col("level_moving" if (sensor, j) == MOVING else f"level{j}")


def _flight(spark: SparkSession, sf_dir: str, *sensors: str) -> DataFrame:
    tel = FE.telemetry(messages(spark, sf_dir, flight_value, levels()), FE.WING)[0]
    return tel.filter(F.col("sensor").isin(*sensors)) if sensors else tel


def _level_sql(sensor: str, j: int) -> str:
    u = "CAST(floor(value) AS BIGINT)"
    stuck = f"({u} % 8) / 8.0" if (sensor, j) == MOVING else "CASE WHEN hour(ts) < 12 THEN 0.5 ELSE 0.0 END"
    return (f"CAST(CASE day(ts) % 4 WHEN 0 THEN 0.25 + ({u} % 8) / 16.0 WHEN 1 THEN {stuck} WHEN 2 THEN hour(ts) * 0.09375 "
            f"ELSE -0.5 + (({u} + {3 * j}) % 8) / 4.0 END AS DOUBLE)")


def _channel_sql(sensor: str, j: int) -> str:
    base, span = FLIGHT[sensor][j]
    return f"CASE WHEN sensor = '{sensor}' THEN {O.dbl(base)} + {O.dbl(span)} * {_level_sql(sensor, j)} END"


CHANNELS = dict(EXPECTED) | {"spoiler_cmd": ("spoiler", 0), "spoiler_actual": ("spoiler", 1),
                             "spoiler_error": ("spoiler", 2), "spoiler_motor": ("spoiler", 3)}
FLIGHT_CTE = f"""{WING_CTE},
f AS (SELECT event_id, ts, "timestamp", sensor, phase, {", ".join(f"{_channel_sql(*at)} AS {c}" for c, at in CHANNELS.items())} FROM w)"""

# Expected ranges: channel -> sensor, then (lo, hi) in takeoff, cruise and landing.
_RANGES = {
    "flap_angle": ("flap", (15, 15), (0, 0), (30, 30)), "flap_pressure": ("flap", (2700, 3450), (0, 0), (3000, 3450)),
    "flap_motor": ("flap", (1.5, 2.5), (0, 0), (2, 3)), "slat_cmd": ("slat", (12.5, 12.5), (0, 0), (6, 10)),
    "slat_motor": ("slat", (0.2, 4.5), (0, 0), (0.3, 4.5)), "spoiler_cmd": ("spoiler", (0, 0), (0, 3), (30, 60)),
    "spoiler_actual": ("spoiler", (0, 0), None, None), "spoiler_motor": ("spoiler", (0, 0), (0, 0.8), (1.5, 4.5)),
    "spoiler_lag": ("spoiler", (0, 0), (15, 45), (20, 150)), "pressure": ("pressure", (160, 1100), (1050, 1150), (970, 1200)),
    "pressure_gradient": ("pressure", (1.4, 2.6), (3.3, 3.9), (3.9, 4.2)), "asymmetry": ("pressure", (0, 0.2), (0, 0.08), (0, 0.12)),
    "fuel_temp": ("fueltemp", (9, 12), (-20, -5), (-4, 2)), "spar_bending": ("spar", (8000, 53000), (10000, 14000), (35000, 62000)),
    "spar_shear": ("spar", (4000, 24000), (5000, 7000), (18000, 28000)),
    "spar_axial": ("spar", (6000, 41000), (6667, 9333), (-25000, 50000)),
    "strain": ("wingtip_strain", (350, 450), (80, 120), (310, 390)),
    "strain_temp": ("wingtip_strain", (15, 35), (-30, -10), (-10, 25)), "snr": ("wingtip_strain", (22, 28), (28, 35), (20, 27)),
    "node_accel": ("wingtip_node", (0.6, 2.5), (0.18, 0.85), (0.6, 2)), "node_deflection": ("wingtip_node", (15, 55), (38, 90), (15, 78)),
    "node_strain": ("wingtip_node", (0, 400), (125, 325), (0, 380)),
}
# Expected rules: name -> (sensor, condition, readings). The SQL side gets run lengths by gaps and islands.
_EXPECTED_RULES = {
    "flap_frozen": ("flap", "abs(flap_angle - lag(flap_angle) OVER q) < 0.01", 3),
    "flap_pressure_flat": ("flap", "flap_pressure BETWEEN 72 AND 88", 3),
    "flap_current_collapsed": ("flap", "abs(flap_motor - 0.04) <= 0.02", 3),
    "slat_current_low": ("slat", "slat_motor < 0.15 AND slat_cmd > 1", 1),
    "slat_frozen": ("slat", "abs(slat_actual - lag(slat_actual) OVER q) < 0.05 AND abs(slat_cmd - lag(slat_cmd) OVER q) > 0.1", 3),
    "spoiler_frozen": ("spoiler", "abs(spoiler_actual - lag(spoiler_actual) OVER q) < 0.05 AND spoiler_cmd > 5", 3),
    "spoiler_constant_error": ("spoiler", "abs(spoiler_error) > 0.5 AND abs((spoiler_cmd - spoiler_error) - "
                               "lag(spoiler_cmd - spoiler_error) OVER q) < 0.05", 3),
    "spoiler_no_current": ("spoiler", "spoiler_motor = 0 AND spoiler_cmd > 5", 1),
    "spoiler_lag_high": ("spoiler", "spoiler_lag > 800", 3),
    "pressure_pinned": ("pressure", "pressure / CASE phase WHEN 'takeoff' THEN 1100 WHEN 'cruise' THEN 1150 ELSE 1200 END >= 0.99", 3),
    "pressure_asymmetry": ("pressure", "asymmetry >= CAST(CASE phase WHEN 'takeoff' THEN 0.2 WHEN 'cruise' THEN 0.08 ELSE 0.12 END AS DOUBLE)", 3),
    "pressure_gradient_swing": ("pressure", "pressure_gradient < -4.2 AND greatest(lag(pressure_gradient) OVER q, "
                                "lag(pressure_gradient, 2) OVER q) > 4.2", 1),
    "spar_overload": ("spar", "phase = 'cruise' AND spar_bending > 65000", 1),
    "spar_ratio": ("spar", "spar_bending <> 0 AND abs(spar_shear / nullif(spar_bending, 0) - 0.5) > 0.2", 1),
    "spar_axial_swing": ("spar", "count(spar_axial) OVER q5 = 5 AND max(spar_axial) OVER q5 - min(spar_axial) OVER q5 > 15000", 1),
    "strain_snr_low": ("wingtip_strain", "snr < 19", 4),
    "strain_noisy": ("wingtip_strain", "count(strain) OVER q5 = 5 AND stddev_samp(strain) OVER q5 > 35", 1),
    "strain_implausible": ("wingtip_strain", "(phase = 'landing' AND strain <= 0) OR (phase = 'cruise' AND strain >= 480)", 1),
    "node_impossible": ("wingtip_node", "node_deflection >= 87 AND node_accel < 0.5", 1),
    "node_strain_high": ("wingtip_node", "phase = 'cruise' AND node_strain > 370", 1),
    "node_jump": ("wingtip_node", "abs(node_deflection - lag(node_deflection) OVER q) > 4.5", 1),
}


def _rules_sql() -> str:
    order = "PARTITION BY sensor ORDER BY ts, event_id"
    conds = ", ".join(f"coalesce(sensor = '{s}' AND ({c}), false) AS {n}" for n, (s, c, _) in _EXPECTED_RULES.items())
    ctes = [FLIGHT_CTE, f"""c AS (SELECT *, row_number() OVER q AS rn, {conds} FROM f
  WINDOW q AS ({order}), q5 AS ({order} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))"""]
    runs = ", ".join(f"rn - coalesce(max(CASE WHEN NOT {n} THEN rn END) OVER ({order}), 0) AS r_{n}"
                     for n, (_, _, k) in _EXPECTED_RULES.items() if k > 1)
    ctes.append(f"d AS (SELECT *, {runs} FROM c)")
    rows = []
    for n, (s, _, k) in _EXPECTED_RULES.items():
        rows.append(f"SELECT \"timestamp\", sensor, phase, '{n}' AS rule, " + (
            f"CAST(r_{n} AS BIGINT) AS held FROM d WHERE sensor = '{s}' AND r_{n} >= {k}" if k > 1
            else f"CAST(1 AS BIGINT) AS held FROM d WHERE {n}"))
    for c, (s, *by_phase) in _RANGES.items():
        for phase, r in zip(("takeoff", "cruise", "landing"), by_phase):
            if r:
                for name, test in (("low", f"{c} < {O.dbl(r[0])}"), ("high", f"{c} > {O.dbl(r[1])}")):
                    rows.append(f"SELECT \"timestamp\", sensor, phase, '{name}_{c}' AS rule, CAST(1 AS BIGINT) AS held FROM f "
                                f"WHERE sensor = '{s}' AND phase = '{phase}' AND {test}")
    return f"""WITH {", ".join(ctes)}, x AS ({" UNION ALL ".join(rows)})
SELECT round("timestamp", 6) AS "timestamp", sensor, phase, rule, held FROM x"""


@register("wing_rules", _rules_sql())
def wing_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DET1-DET8: every fired rule and every channel outside its healthy range, per reading of the wing feed."""
    d = W.with_bucket(_flight(spark, sf_dir), "hour", "event_time", keys=("sensor",))
    out = R.fired(d, S.WING_RULES, S.WING_PHASE_LIMITS)
    return out.select(r6("timestamp").alias("timestamp"), "sensor", "phase", F.inline("fired"))


_FAULT_SQL = f"""WITH {FLIGHT_CTE},
p AS (SELECT *, row_number() OVER q AS rn, coalesce(lag(spoiler_cmd) OVER q, 0) AS pc, lag(phase) OVER q AS pp FROM f
      WHERE sensor = 'spoiler' WINDOW q AS (ORDER BY ts, event_id)),
a AS (SELECT *, pp IS NULL OR pp <> phase AS begins, phase <> 'takeoff' AND spoiler_cmd > 0.1 AND spoiler_lag = 0 AS given,
       phase <> 'takeoff' AND spoiler_cmd > 0.1 AND spoiler_lag = 0 AND abs(spoiler_cmd - spoiler_actual) > 2 AND spoiler_motor = 0 AS jam,
       CASE WHEN phase <> 'takeoff' AND abs(spoiler_cmd - pc) > 0.1 THEN CASE WHEN spoiler_cmd > 0 THEN spoiler_lag ELSE 0 END
            WHEN pp IS NULL OR pp <> phase THEN 0 END AS given_lag FROM p),
l AS (SELECT *, last_value(given_lag IGNORE NULLS) OVER r AS lag_now, sum(CAST(begins AS INT)) OVER r AS run,
       sum(CASE WHEN phase <> 'takeoff' AND NOT jam THEN 1 ELSE 0 END) OVER r AS island FROM a
      WINDOW r AS (ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (SELECT *, CASE WHEN jam THEN "timestamp" - min(CASE WHEN jam THEN "timestamp" END) OVER (PARTITION BY island) END AS held,
       bool_or(given AND lag_now = 0) OVER r AS miss,
       bool_or(phase <> 'takeoff' AND lag_now > CASE phase WHEN 'landing' THEN 200 ELSE 100 END) OVER r AS late FROM l
      WINDOW r AS (PARTITION BY run ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, coalesce(held > 2, false) AS stall FROM s)
SELECT round("timestamp", 6) AS "timestamp", phase, lag_now AS command_lag, stall AS actuator_stall, late AS excessive_lag,
       miss AS signal_miss, concat_ws(',', CASE WHEN stall THEN 'actuator_stall' END, CASE WHEN late THEN 'excessive_lag' END,
       CASE WHEN miss THEN 'signal_miss' END) AS faults, CASE WHEN stall OR late OR miss THEN 'degraded' ELSE 'normal' END AS status,
       CASE WHEN stall OR late OR miss THEN 'Schedule maintenance check' ELSE 'Continue normal operation' END AS recommendation FROM g"""


def _faults(d: DataFrame) -> DataFrame:
    out = R.actuator_faults(d, S.SPOILER_LAG_LIMITS, S.SPOILER_LAG_DEFAULT, S.SPOILER_STALL_SECONDS)
    return out.select(r6("timestamp").alias("timestamp"), "phase", "command_lag", "actuator_stall", "excessive_lag", "signal_miss",
                      F.concat_ws(",", "faults").alias("faults"), "status", "recommendation")


@register("actuator_faults", _FAULT_SQL)
def actuator_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN12 + PRJ26: stall, signal miss and excess lag of the spoiler by phase, with the health text."""
    return _faults(W.with_bucket(_flight(spark, sf_dir, "spoiler"), "hour", "event_time", keys=("sensor",)))


@register("hot_actuator_faults", _FAULT_SQL)
def hot_actuator_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the one sensor's sequence split by the hour, as a hot key is."""
    return _faults(W.with_bucket(_flight(spark, sf_dir, "spoiler"), "hour", "event_time", split_above=None, keys=("sensor",)))


# Spans of six hours that move by the hour.
BIN, BINS = 3600, 6


def _span_sql(sensor: str, stats: str, cols: str) -> str:
    """Statistics over the raw readings of each span that ends with a reading."""
    return f"""WITH {FLIGHT_CTE},
g AS (SELECT *, CAST(floor("timestamp" / {BIN}) AS BIGINT) AS bin FROM f WHERE sensor = '{sensor}'),
z AS (SELECT e.bin, count(*) AS n_readings, {stats}
      FROM (SELECT DISTINCT bin FROM g) e JOIN g ON g.bin BETWEEN e.bin - {BINS - 1} AND e.bin GROUP BY e.bin)
SELECT '{sensor}' AS sensor, bin, n_readings, {cols} FROM z"""


def _corr_sql(x: str, y: str) -> str:
    """Correlation, NULL without spread."""
    return f"CASE WHEN min({x}) < max({x}) AND min({y}) < max({y}) THEN corr({y}, {x}) END"


_T = f'("timestamp" - e.bin * {BIN})'


@register("wing_error_growth", _span_sql(
    "slat", f"regr_slope(abs(slat_error), {_T}) AS s, {_corr_sql(_T, 'abs(slat_error)')} AS c, min(abs(slat_error)) AS lo",
    "CASE WHEN isfinite(s) THEN round(s, 6) END AS slope, lo AS least_error, coalesce(c >= 0.7, false) AND n_readings >= 4 AND lo >= 0.5 AS fired"))
def wing_error_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DET3: tracking error of the slat that keeps growing and does not revert."""
    out = MO.growing_error(_flight(spark, sf_dir, "slat"), "slat_error", BINS, BIN)
    return out.withColumn("slope", r6("slope"))


_SPAR = ["spar_bending", "spar_shear", "spar_axial"]


@register("wing_loads_rising", _span_sql(
    "spar", ", ".join(f"{_corr_sql(_T, c)} AS {c}" for c in _SPAR),
    ", ".join(f"round({c}, 6) AS rise_{c}" for c in _SPAR)
    + ", n_readings >= 4 AND " + " AND ".join(f"coalesce({c} >= 0.7, false)" for c in _SPAR) + " AS fired"))
def wing_loads_rising(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DET6: all three load channels of the spar rise together."""
    out = MO.rising_together(_flight(spark, sf_dir, "spar"), _SPAR, BINS, BIN)
    for c in _SPAR:
        out = out.withColumn(f"rise_{c}", r6(f"rise_{c}"))
    return out


def _pair(sensor: str, x: str, y: str):
    return _span_sql(sensor, f"{_corr_sql(x, y)} AS c", "round(c, 6) AS correlation, coalesce(c < 0.2, false) AND n_readings >= 4 AS fired")


@register("wing_strain_unrelated", _pair("wingtip_strain", "strain_temp", "strain"))
def wing_strain_unrelated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DET7: strain that no longer follows the temperature."""
    out = MO.decorrelated(_flight(spark, sf_dir, "wingtip_strain"), "strain_temp", "strain", BINS, BIN)
    return out.withColumn("correlation", r6("correlation"))


@register("wing_node_unrelated", _pair("wingtip_node", "node_accel", "node_deflection"))
def wing_node_unrelated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DET8: deflection that no longer follows the acceleration."""
    out = MO.decorrelated(_flight(spark, sf_dir, "wingtip_node"), "node_accel", "node_deflection", BINS, BIN)
    return out.withColumn("correlation", r6("correlation"))
