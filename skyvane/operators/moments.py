"""Trend and correlation over time spans from mergeable moment states (DET3, DET6, DET7, DET8).

One hash aggregate turns the readings of every (key, time bin) into a state per
pair of channels: (n, mean x, mean y, Sxx, Syy, Sxy). States of the same pair merge without loss, so a
trailing span of several bins is the merge of its bins' states and the readings are read
once whatever the spans overlap. What is shuffled is one row per key, bin and input
task, never a reading, so a hot key needs no splitting. A trend is the pair (time, channel), with time
counted in seconds from the bin's start and shifted when states of different bins meet.

Only readings where both channels of a pair have a value count for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME = None
Pair = tuple[str, Column | None, Column]


def bin_states(df: DataFrame, pairs: Sequence[Pair], bin_seconds: int, keys: Sequence[str] = ("sensor",),
               time: str = "timestamp") -> DataFrame:
    """keys, ``bin`` and one state per pair (name, x or :data:`TIME`, y)."""
    at = F.floor(F.col(time) / bin_seconds)
    d = df.withColumn("bin", at)
    since = F.col(time) - F.col("bin") * bin_seconds
    aggs = []
    for name, x, y in pairs:
        x = since if x is TIME else x.cast("double")
        y = y.cast("double")
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        n = F.count(y)
        aggs.append(F.when(n > 0, F.struct(
            n.cast("double").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), (F.var_pop(x) * n).alias("sxx"),
            (F.var_pop(y) * n).alias("syy"), (F.covar_pop(x, y) * n).alias("sxy"), F.min(y).alias("lo"))).alias(name))
    return d.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n_readings"), *aggs)


def _merge(a: Column, b: Column) -> Column:
    """The state of both sets of readings."""
    n = a.n + b.n
    dx, dy, w = b.mx - a.mx, b.my - a.my, a.n * b.n / n
    both = F.struct(
        n.alias("n"), (a.mx + dx * b.n / n).alias("mx"), (a.my + dy * b.n / n).alias("my"),
        (a.sxx + b.sxx + dx * dx * w).alias("sxx"), (a.syy + b.syy + dy * dy * w).alias("syy"),
        (a.sxy + b.sxy + dx * dy * w).alias("sxy"), F.least(a.lo, b.lo).alias("lo"))
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)


def spans(states: DataFrame, pairs: Sequence[Pair], bins: int, bin_seconds: int,
          keys: Sequence[str] = ("sensor",)) -> DataFrame:
    """States over the ``bins`` bins that end with each bin that has a reading, in its key's time. A group
    collects at most ``bins`` states."""
    copies = states.select(
        *keys, F.col("bin").alias("_from"), F.explode(F.sequence(F.col("bin"), F.col("bin") + bins - 1)).alias("bin"),
        "n_readings", *[p[0] for p in pairs])
    shift = (F.col("_from") - F.col("bin")) * F.lit(float(bin_seconds))
    for name, x, _ in pairs:
        if x is TIME:
            copies = copies.withColumn(name, F.when(F.col(name).isNotNull(), F.col(name).withField("mx", F.col(name)["mx"] + shift)))
    group = copies.groupBy(*keys, "bin").agg(
        F.max("_from").alias("_last"), F.sum("n_readings").alias("n_readings"),
        *[F.sort_array(F.collect_list(F.struct("_from", F.col(p[0]).alias("s")))).alias(p[0]) for p in pairs])
    group = group.filter(F.col("_last") == F.col("bin")).drop("_last")
    empty = F.lit(None).cast(states.schema[pairs[0][0]].dataType)
    return group.select(*keys, "bin", "n_readings", *[
        F.aggregate(F.col(p[0]), empty, lambda a, b: _merge(a, b["s"])).alias(p[0]) for p in pairs])


def slope(state: str) -> Column:
    """Least-squares slope of y against x; NULL without spread in x."""
    return F.try_divide(F.col(state)["sxy"], F.nullif(F.col(state)["sxx"], F.lit(0.0)))


def corr(state: str) -> Column:
    """Correlation of x and y; NULL without spread in either."""
    s = F.col(state)
    return F.try_divide(s["sxy"], F.nullif(F.sqrt(s["sxx"]) * F.sqrt(s["syy"]), F.lit(0.0)))


def rising(state: str, least: float = 0.7, readings: int = 4) -> Column:
    """Whether y rises with time: correlated by at least ``least`` over enough readings."""
    return F.coalesce((corr(state) >= least) & (F.col(state)["n"] >= readings), F.lit(False))


def unrelated(state: str, below: float = 0.2, readings: int = 4) -> Column:
    """Whether x and y have spread but a correlation below ``below``."""
    return F.coalesce((corr(state) < below) & (F.col(state)["n"] >= readings), F.lit(False))


def growing_error(df: DataFrame, error: str, bins: int, bin_seconds: int, floor: float = 0.5, **kw) -> DataFrame:
    """DET3: spans over which the absolute error rises and never reverts below ``floor``."""
    pairs = [("trend", TIME, F.abs(F.col(error)))]
    out = spans(bin_states(df, pairs, bin_seconds, **kw), pairs, bins, bin_seconds)
    return out.select("sensor", "bin", "n_readings", slope("trend").alias("slope"), F.col("trend.lo").alias("least_error"),
                      (rising("trend") & (F.col("trend.lo") >= floor)).alias("fired"))


def rising_together(df: DataFrame, channels: Sequence[str], bins: int, bin_seconds: int, **kw) -> DataFrame:
    """DET6: spans over which all channels rise with time."""
    pairs = [(f"t_{c}", TIME, F.col(c)) for c in channels]
    out = spans(bin_states(df, pairs, bin_seconds, **kw), pairs, bins, bin_seconds)
    all_rise = F.lit(True)
    for c in channels:
        all_rise = all_rise & rising(f"t_{c}")
    return out.select("sensor", "bin", "n_readings", *[corr(f"t_{c}").alias(f"rise_{c}") for c in channels], all_rise.alias("fired"))


def decorrelated(df: DataFrame, x: str, y: str, bins: int, bin_seconds: int, **kw) -> DataFrame:
    """DET7, DET8: spans over which two channels vary but no longer together."""
    pairs = [("pair", F.col(x), F.col(y))]
    out = spans(bin_states(df, pairs, bin_seconds, **kw), pairs, bins, bin_seconds)
    return out.select("sensor", "bin", "n_readings", corr("pair").alias("correlation"), unrelated("pair").alias("fired"))
