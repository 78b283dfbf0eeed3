"""Labelled degradation (AUG1-AUG10): deterministic degraded copies of healthy
telemetry for evaluating detectors and the model.

A fault spec per (asset, sensor) gives ``start``, ``duration`` and the curve;
``p = clamp((t − start) / duration, 0, 1)``. All steps are column
expressions; the only aggregate is one row per key (its first time, and the
value at the freeze onset), joined back on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Curve parameters.
SIGMOID = {"pressure": (8.0, 0.4), "spar": (8.0, 0.35), "wingtip_node": (7.0, 0.3)}
SATURATING = {"slat": 4.0, "wingtip_strain": 3.5, "fueltemp": 3.0}
POWER = 1.4


def ramp(p: Column) -> Column:
    """AUG1: linear ramp then plateau."""
    return p


def clamped_bias(p: Column, elapsed_min: Column, target: float, drift: float, bound: float = 0.5) -> Column:
    """AUG1 with its drift and clamp: ``target·p`` plus a linear drift with flight time, kept in ±bound."""
    return F.greatest(F.least(F.lit(target) * p + F.lit(drift) * elapsed_min, F.lit(bound)), F.lit(-bound))


def power(p: Column, exponent: float = POWER) -> Column:
    """AUG2: p^1.4."""
    return F.pow(p, F.lit(exponent))


def sigmoid(p: Column, k: float, c: float) -> Column:
    """AUG3: 1 / (1 + exp(−k (p − c)))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.lit(k) * (p - F.lit(c))))


def saturating(p: Column, k: float) -> Column:
    """AUG4: 1 − exp(−k p)."""
    return F.lit(1.0) - F.exp(-F.lit(k) * p)


def root(p: Column) -> Column:
    """AUG5: √p."""
    return F.sqrt(p)


def decay_after(p: Column, plateau: float = 0.8, rate: float = 5.0) -> Column:
    """AUG6: full effect until the plateau fraction, then exponential decay."""
    return F.when(p < plateau, F.lit(1.0)).otherwise(F.exp(-F.lit(rate) * (p - F.lit(plateau))))


def extra_rate(elapsed: Column, duration: Column, onset: float, rate: float) -> Column:
    """AUG7: additional linear rate once ``onset`` of the duration has passed."""
    return F.when(elapsed >= duration * onset, F.lit(rate) * (elapsed - duration * onset)) \
            .otherwise(F.lit(0.0))


def blend(v: Column, target: Column, b: Column) -> Column:
    """AUG9: v·(1−b) + target·b."""
    return v * (F.lit(1.0) - b) + target * b


def stage(p: Column, started: Column, onsets: Sequence[float] = (0.3, 0.7)) -> Column:
    """AUG10: ``healthy`` before the start, then three stages by p."""
    lo, hi = onsets
    return (F.when(~started, F.lit("healthy"))
             .when(p < lo, F.lit("incipient"))
             .when(p < hi, F.lit("developing"))
             .otherwise(F.lit("critical")))


def degrade(df: DataFrame, curves: dict[str, Column], spec: DataFrame, x: str, frozen: str,
            score: str, keys: Sequence[str] = ("asset_id", "sensor"),
            time_col: str = "timestamp", severity: float = 0.5, freeze_onset: float = 0.7,
            blend_span: float = 0.1, drift_per_day: float = 0.5,
            order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Degraded copy of ``df`` with labels.

    ``spec`` has ``keys``, ``start`` (epoch s) and ``duration`` (s). ``curves``
    maps sensor -> curve expression over the column ``p``.

    * ``x_degraded = x · (1 + severity · curve(p)) + drift`` (AUG1-AUG7),
    * ``frozen_degraded``: ``frozen`` held at its value at the first reading
      with p ≥ ``freeze_onset`` (AUG8),
    * ``score_degraded``: blended towards 1.0 over ``blend_span`` of the
      duration after the freeze onset (AUG9),
    * ``stage`` (AUG10) and ``is_degraded``.
    """
    j = df.join(spec, list(keys), "left")
    elapsed = F.col(time_col) - F.col("start")
    started = F.coalesce(elapsed >= 0, F.lit(False))
    j = j.withColumn("p", F.when(started, F.least(elapsed / F.col("duration"), F.lit(1.0)))
                       .otherwise(F.lit(0.0)))
    curve = None
    for s, c in curves.items():
        cond = F.col("sensor") == s
        curve = F.when(cond, c) if curve is None else curve.when(cond, c)
    curve = curve.otherwise(ramp(F.col("p"))) if curve is not None else ramp(F.col("p"))
    drift = F.when(started, extra_rate(elapsed / 86400.0, F.col("duration") / 86400.0,
                                       0.5, drift_per_day)).otherwise(F.lit(0.0))
    j = j.withColumn("x_degraded", F.col(x) * (F.lit(1.0) + F.lit(severity) * curve) + drift)
    # AUG8: value at the freeze onset, one row per key.
    ordkey = F.struct(*[F.col(c) for c in order])
    onset_rows = j.filter(started & (F.col("p") >= freeze_onset))
    lock = onset_rows.groupBy(*keys).agg(F.min_by(F.col(frozen), ordkey).alias("_lock"))
    j = j.join(lock, list(keys), "left")
    frozen_now = started & (F.col("p") >= freeze_onset)
    j = j.withColumn("frozen_degraded", F.when(frozen_now, F.col("_lock")).otherwise(F.col(frozen)))
    b = F.least(F.greatest((F.col("p") - F.lit(freeze_onset)) / F.lit(blend_span), F.lit(0.0)),
                F.lit(1.0))
    j = j.withColumn("score_degraded",
                     F.when(started, blend(F.col(score), F.lit(1.0), b)).otherwise(F.col(score)))
    return (j.withColumn("stage", stage(F.col("p"), started))
             .withColumn("is_degraded", started & (F.col("p") > 0))
             .drop("_lock"))


def fault_spec(df: DataFrame, keys: Sequence[str] = ("asset_id", "sensor"),
               delay_days: float = 10.0, duration_days: float = 10.0,
               time_col: str = "timestamp") -> DataFrame:
    """Deterministic spec: the fault starts ``delay_days`` after a key's first
    reading and develops over ``duration_days``."""
    return df.groupBy(*keys).agg(
        (F.min(time_col) + F.lit(delay_days * 86400.0)).alias("start"),
        F.lit(duration_days * 86400.0).alias("duration"))
