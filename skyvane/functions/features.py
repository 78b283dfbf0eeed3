"""Scalar feature functions (PRJ16-PRJ24): column expressions, codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.ordered import round_half_away

# RMS bias multiplier by phase (any other phase: OTHER).
RMS_MULTIPLIER = {"takeoff": 0.5, "cruise": 0.8, "landing": 0.6}
RMS_MULTIPLIER_OTHER = 0.4


def clamp(c: Column, lo: float, hi: float) -> Column:
    """PRJ16: ``max(lo, min(c, hi))``."""
    return F.greatest(F.lit(lo), F.least(c, F.lit(hi)))


def round_to(c: Column, digits: int) -> Column:
    """PRJ17: round to the sensor's precision (half away from zero)."""
    return round_half_away(c, digits)


def magnitude(*cs: Column) -> Column:
    """PRJ18: Euclidean norm √(x²+y²+…)."""
    sq = [c * c for c in cs]
    return F.sqrt(sum(sq[1:], sq[0]))


def rms_with_bias(rms: Column, bias: Column, phase: Column) -> Column:
    """PRJ19: √(rms² + (k·bias)²) with k chosen by phase."""
    k = F.coalesce(F.element_at(S.as_map_literal(RMS_MULTIPLIER), phase),
                   F.lit(RMS_MULTIPLIER_OTHER))
    contrib = bias * k
    return F.sqrt(rms * rms + contrib * contrib)


def tracking_error(commanded: Column, actual: Column) -> Column:
    """PRJ20: commanded − actual, rounded to 2."""
    return round_half_away(commanded - actual, 2)


def overshoot(actual: Column, commanded: Column, limit: float = 0.5) -> Column:
    """PRJ21: actual − commanded, held within ±limit."""
    return clamp(actual - commanded, -limit, limit)


def remaining_lag_ms(applied_at: Column, now: Column) -> Column:
    """PRJ22: milliseconds until a command applies; 0 once due."""
    return F.greatest(F.lit(0), F.floor((applied_at - now) * F.lit(1000.0))).cast("long")


def stability_label(gradient: Column, band: float = 0.1) -> Column:
    """PRJ23: ``STABLE`` if |gradient| < band else ``CHANGING``."""
    return F.when(F.abs(gradient) < band, F.lit("STABLE")).otherwise(F.lit("CHANGING"))


def motion_label(moving: Column, locked: Column) -> Column:
    """PRJ24: ``MOVING`` / ``LOCKED`` / ``HOLDING``."""
    return (F.when(moving, F.lit("MOVING"))
             .when(locked, F.lit("LOCKED"))
             .otherwise(F.lit("HOLDING")))
