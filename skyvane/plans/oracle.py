"""DuckDB SQL building blocks for the oracle side of each registered query.

The readings CTE is the SQL twin of :func:`skyvane.sources.telemetry.readings`;
it is generated from the same constant tables so both sides share one
definition of thresholds, phases and feature keys.
"""

from __future__ import annotations

from .. import schema as S


def _case(col: str, mapping: dict[str, float], default: float) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in sorted(mapping.items()))
    return f"CAST(CASE {col} {whens} ELSE {default!r} END AS DOUBLE)"


def phase_sql(ts: str = "ts") -> str:
    parts = " ".join(f"WHEN hour({ts}) < {hi} THEN '{name}'" for name, lo, hi in S.PHASE_HOURS)
    return f"CASE {parts} END"


def readings_cte() -> str:
    scalar = ", ".join(f"'{s}'" for s in S.SCALAR_SENSORS)
    thr = _case("event_type", S.all_thresholds(), S.DEFAULT_THRESHOLD)
    return f"""readings AS (
  SELECT event_id, user_id AS asset_id, event_type AS sensor, ts,
         epoch_us(ts) / 1e6 AS "timestamp",
         {phase_sql()} AS phase,
         value,
         CASE WHEN event_type NOT IN ({scalar})
              THEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
         value / {S.PREDICTION_SCALE!r} AS prediction,
         value / {S.PREDICTION_SCALE!r} > {thr} AS is_anomaly
  FROM events)"""


def with_readings(body: str, *more_ctes: str) -> str:
    ctes = ",\n".join([readings_cte(), *more_ctes])
    return f"WITH {ctes}\n{body}"


def fmt_ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def threshold_case(col: str = "sensor") -> str:
    return _case(col, S.all_thresholds(), S.DEFAULT_THRESHOLD)


def weight_of(feature: str) -> float:
    return S.all_weights().get(feature, S.DEFAULT_WEIGHT)


def rha(expr: str, digits: int) -> str:
    """SQL twin of :func:`skyvane.operators.ordered.round_half_away`."""
    p = float(10 ** digits)
    return f"(sign({expr}) * floor(abs({expr}) * {p!r} + 0.5) / {p!r})"


SEQ = "PARTITION BY asset_id, sensor ORDER BY ts, event_id"


def dbl(v: float) -> str:
    """A double literal with the exact bits of the Python float."""
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def recursive_fold(keys: list[str], seq_sql: str, state: dict[str, str],
                   step: dict[str, str], out: str, extra_ctes: list[str] | None = None) -> str:
    """A recursive-CTE fold over ``seq`` rows numbered ``rn`` per key.

    ``state`` gives each state column's initial SQL (typed); ``step`` its new
    value, written over ``f`` (previous state) and ``s`` (current row).
    Output: ``out`` selects from ``fold`` (rows with rn > 0 joined to seq as s).
    """
    k = ", ".join(keys)
    init = ", ".join(f"{v} AS {n}" for n, v in state.items())
    on = " AND ".join(f"s.{c} = f.{c}" for c in keys)
    nxt = ", ".join(f"{step[n]} AS {n}" for n in state)
    ctes = [readings_cte(), *(extra_ctes or []), f"seq AS ({seq_sql})"]
    return f"""WITH RECURSIVE {", ".join(ctes)},
fold AS (
  SELECT DISTINCT {k}, CAST(0 AS BIGINT) AS rn, {init} FROM seq
  UNION ALL
  SELECT {", ".join("s." + c for c in keys)}, s.rn, {nxt}
  FROM fold f JOIN seq s ON {on} AND s.rn = f.rn + 1)
{out}"""
