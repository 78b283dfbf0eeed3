"""Failure-criteria detectors (DET1-DET8) on telemetry.

Rolling-frame detectors look back a bounded number of rows and run on the
halo frame; run-length detectors use the two-level scan (see
:mod:`skyvane.operators.ordered`), so a hot sensor is split by time bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordered as W


def pair_corr(x: str, y: str, frame: Window) -> Column:
    """Pearson correlation over the frame's complete pairs; NULL when either
    side has zero variance (``corr`` would divide by zero under ANSI mode)."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xs, ys = F.when(both, F.col(x)), F.when(both, F.col(y))
    den = F.stddev_samp(xs).over(frame) * F.stddev_samp(ys).over(frame)
    return F.try_divide(F.covar_samp(xs, ys).over(frame), F.nullif(den, F.lit(0.0)))


def rolling(df: DataFrame, x: str, y: str, n: int = 5, std_limit: float = 35.0,
            corr_floor: float = 0.2, swing_limit: float = 150.0,
            keys: Sequence[str] = W.KEYS, order: Sequence[str] = W.ORDER) -> DataFrame:
    """DET6-DET8 rolling rules over the last ``n`` readings:

    * ``roll_std``: sample stddev of x; ``noisy`` when above ``std_limit`` (DET7);
    * ``roll_corr``: corr(x, y); ``decorrelated`` when below ``corr_floor`` (DET7/DET8);
    * ``swing``: max − min of x; ``oscillating`` above ``swing_limit`` (DET6);
    * ``rising_together``: x and y both rose over each of the last 3 steps (DET6).
    """
    def build(w: Window) -> dict[str, Column]:
        frame = w.rowsBetween(-(n - 1), Window.currentRow)
        rises = []
        for c in (x, y):
            for i in range(3):
                cur = F.lag(c, i).over(w) if i else F.col(c)
                rises.append(cur > F.lag(c, i + 1).over(w))
        together = rises[0]
        for r in rises[1:]:
            together = together & r
        return {
            "roll_std": F.stddev_samp(x).over(frame),
            "roll_corr": pair_corr(x, y, frame),
            "swing": F.max(x).over(frame) - F.min(x).over(frame),
            "rising_together": F.coalesce(together, F.lit(False)),
            "_cnt": F.count(x).over(frame),
        }
    out = W.bounded(df, n - 1 if n > 3 else 3, build, keys, order)
    full = F.col("_cnt") >= n
    return (out.withColumn("noisy", full & F.coalesce(F.col("roll_std") > std_limit, F.lit(False)))
               .withColumn("decorrelated", full & F.coalesce(F.col("roll_corr") < corr_floor, F.lit(False)))
               .withColumn("oscillating", full & F.coalesce(F.col("swing") > swing_limit, F.lit(False)))
               .drop("_cnt"))


def sign_flips(df: DataFrame, x: str, big: float, keys: Sequence[str] = W.KEYS,
               order: Sequence[str] = W.ORDER) -> DataFrame:
    """DET5: a large step whose sign is opposite to a large step within the
    previous 2 steps."""
    def build(w: Window) -> dict[str, Column]:
        d0 = F.col(x) - F.lag(x, 1).over(w)
        d1 = F.lag(x, 1).over(w) - F.lag(x, 2).over(w)
        d2 = F.lag(x, 2).over(w) - F.lag(x, 3).over(w)

        def flip(a: Column, b: Column) -> Column:
            return (F.abs(a) > big) & (F.abs(b) > big) & (F.signum(a) == -F.signum(b))
        return {"sign_flip": F.coalesce(flip(d0, d1), F.lit(False))
                             | F.coalesce(flip(d0, d2), F.lit(False))}
    return W.bounded(df, 3, build, keys, order)


def frozen_runs(df: DataFrame, x: str, eps: float, while_cond: Column | None = None,
                min_ticks: int = 3, persistent: dict[str, tuple[Column, int]] | None = None,
                keys: Sequence[str] = W.KEYS, order: Sequence[str] = W.ORDER) -> DataFrame:
    """DET2-DET5: |Δx| < eps (while ``while_cond`` holds) for ``min_ticks``
    consecutive steps: ``frozen_len`` and ``frozen``. ``persistent`` adds, in
    the same scan, ``<name>_len`` and ``<name>`` for conditions that must hold
    for more than the given number of readings (see :func:`persistent`)."""
    persistent = persistent or {}
    cond = F.lit(True) if while_cond is None else F.coalesce(while_cond, F.lit(False))
    b = df.withColumn("_cond", cond)
    for name, (c, _) in persistent.items():
        b = b.withColumn(f"_pc_{name}", F.coalesce(c, F.lit(False)))
    b = W.bounded(b, 1, lambda w: {
        "_still": F.coalesce(F.abs(F.col(x) - F.lag(x, 1).over(w)) < eps, F.lit(False))
                  & F.col("_cond")}, keys, order)
    breaks = {"_brk": ~F.col("_still"),
              **{f"_pb_{n}": ~F.col(f"_pc_{n}") for n in persistent}}
    b = W.scan(b, last_pos=breaks, keys=keys, order=order)
    run = F.col("seq") - F.col("_brk")
    b = b.withColumn("frozen_len", run).withColumn("frozen", run >= min_ticks)
    for name, (_, ticks) in persistent.items():
        plen = F.col("seq") - F.coalesce(F.col(f"_pb_{name}"), F.lit(0))
        b = b.withColumn(f"{name}_len", plen).withColumn(name, plen > ticks)
    drop = ["_cond", "_still", "_brk", "seq", *[f"_pc_{n}" for n in persistent],
            *[f"_pb_{n}" for n in persistent]]
    return b.drop(*drop)


def persistent(df: DataFrame, cond: Column, min_ticks: int, name: str,
               keys: Sequence[str] = W.KEYS, order: Sequence[str] = W.ORDER) -> DataFrame:
    """DET4/DET5/DET7: ``cond`` true for more than ``min_ticks`` consecutive
    readings (e.g. SNR < 19 for > 3 ticks, lag > 800 ms persistently)."""
    b = df.withColumn("_c", F.coalesce(cond, F.lit(False)))
    b = W.scan(b, last_pos={"_brk": ~F.col("_c")}, keys=keys, order=order)
    run = F.col("seq") - F.coalesce(F.col("_brk"), F.lit(0))
    return (b.withColumn(f"{name}_len", run)
             .withColumn(name, run > min_ticks)
             .drop("_c", "_brk", "seq"))
