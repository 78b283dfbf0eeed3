"""Failure rules of many sensors, compiled into one shared pass (DET1-DET8).

Rules are rows (rule, sensor, SQL condition, readings it must hold; see
:data:`skyvane.schema.WING_RULES`) and healthy ranges are rows (sensor, phase, channel, lo, hi). All rules run
together: one bounded look-back adds the earlier readings that any condition names, every
persistent rule of a sensor takes one *slot*, and one two-level scan keeps each slot's run length. The
scan is as wide as the sensor with most persistent rules, not as the table of rules, and
split keys are stitched as in :mod:`skyvane.operators.ordered`.

A condition that is NULL (a missing channel, no earlier reading) does not hold.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordered as W

Rule = tuple[str, str, str, int]
Limit = tuple[str, str, str, float, float]

FRAME = 5
_NAMED = re.compile(r"\b(prev|prev2|std5|swing5)_(\w+)")


def lookback(conditions: Sequence[str], w: Window) -> dict[str, Column]:
    """The earlier readings and rolling figures that the conditions name."""
    last = w.rowsBetween(-(FRAME - 1), Window.currentRow)
    full = lambda x: F.count(x).over(last) >= FRAME
    make = {
        "prev": lambda x: F.lag(x, 1).over(w),
        "prev2": lambda x: F.lag(x, 2).over(w),
        "std5": lambda x: F.when(full(x), F.stddev_samp(x).over(last)),
        "swing5": lambda x: F.when(full(x), F.max(x).over(last) - F.min(x).over(last)),
    }
    named = sorted({m for c in conditions for m in _NAMED.findall(c)})
    return {f"{kind}_{x}": make[kind](x) for kind, x in named}


def _by_sensor(values: dict[str, Column], default: Column) -> Column:
    expr = None
    for s, v in values.items():
        cond = F.col("sensor") == s
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return default if expr is None else expr.otherwise(default)


def range_faults(limits: Sequence[Limit]) -> Column:
    """DET1: an array of (rule, held) of the channels outside their healthy range in the row's phase. The ranges
    are one literal map from sensor and phase, so the expression does not grow with their number."""
    channels: dict[str, list[str]] = {}
    table: dict[tuple[str, str], list[tuple[int, str, float, float]]] = {}
    for s, phase, x, lo, hi in limits:
        known = channels.setdefault(s, [])
        if x not in known:
            known.append(x)
        table.setdefault((s, phase), []).append((known.index(x), x, lo, hi))
    entries = []
    for (s, phase), rows in table.items():
        entries += [F.lit(f"{s} {phase}"), F.array(*[F.struct(
            F.lit(i).alias("i"), F.lit(x).alias("x"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"))
            for i, x, lo, hi in rows])]
    ranges = F.try_element_at(F.create_map(*entries), F.concat("sensor", F.lit(" "), "phase"))
    values = _by_sensor({s: F.array(*[F.col(x) for x in xs]) for s, xs in channels.items()}, F.array().cast("array<double>"))

    def side(r: Column) -> Column:
        v = values[r["i"]]
        return F.when(v < r["lo"], F.concat(F.lit("low_"), r["x"])).when(v > r["hi"], F.concat(F.lit("high_"), r["x"]))

    one = F.lit(1).cast("long").alias("held")
    found = F.transform(F.filter(F.transform(ranges, side), lambda n: n.isNotNull()), lambda n: F.struct(n.alias("rule"), one))
    return F.coalesce(found, F.array().cast("array<struct<rule:string,held:bigint>>"))


def fired(df: DataFrame, rules: Sequence[Rule], limits: Sequence[Limit] = (), keys: Sequence[str] = ("sensor",),
          order: Sequence[str] = ("event_time", "event_id")) -> DataFrame:
    """``df`` with ``fired``: an array of (rule, held) sorted by rule, ``held`` being the number of consecutive
    readings so far for which the rule's condition is true. Sensors without rules or ranges are left out.

    ``keys`` must name the sensor's sequence. ``df`` may carry a bucket (:func:`ordered.with_bucket`).
    """
    sensors = sorted({r[1] for r in rules} | {x[0] for x in limits})
    d = df.filter(F.col("sensor").isin(sensors))
    d = W.bounded(d, FRAME - 1, lambda w: lookback([r[2] for r in rules], w), keys, order)
    now = [r for r in rules if r[3] <= 1]
    slots: dict[str, list[Rule]] = {}
    for r in rules:
        if r[3] > 1:
            slots.setdefault(r[1], []).append(r)
    width = max((len(v) for v in slots.values()), default=0)

    def holds(r: Rule) -> Column:
        return F.coalesce(F.expr(r[2]), F.lit(False))

    for i in range(width):
        d = d.withColumn(f"_hold{i}", _by_sensor({s: holds(v[i]) for s, v in slots.items() if i < len(v)}, F.lit(False)))
    if width:
        d = W.scan(d, last_pos={f"_break{i}": ~F.col(f"_hold{i}") for i in range(width)}, keys=keys, order=order)
    found = []
    one = F.lit(1).cast("long")
    for r in now:
        found.append(F.when((F.col("sensor") == r[1]) & holds(r), F.struct(F.lit(r[0]).alias("rule"), one.alias("held"))))
    for s, v in slots.items():
        for i, (name, _, _, ticks) in enumerate(v):
            held = F.col("seq") - F.coalesce(F.col(f"_break{i}"), F.lit(0))
            found.append(F.when((F.col("sensor") == s) & (held >= ticks),
                                F.struct(F.lit(name).alias("rule"), held.cast("long").alias("held"))))
    out = F.filter(F.array(*found), lambda r: r.isNotNull()) if found else F.array().cast("array<struct<rule:string,held:bigint>>")
    if limits:
        out = F.concat(out, range_faults(limits))
    d = d.withColumn("fired", F.array_sort(out))
    return d.select(*df.columns, "fired")


def actuator_faults(df: DataFrame, lag_limits: dict[str, float], lag_default: float, stall_seconds: float,
                    command: str = "spoiler_cmd", actual: str = "spoiler_actual", current: str = "spoiler_motor",
                    lag: str = "spoiler_lag", time: str = "timestamp", idle: str = "takeoff",
                    keys: Sequence[str] = ("sensor",), order: Sequence[str] = ("event_time", "event_id")) -> DataFrame:
    """WIN12 + PRJ26: stall, signal miss and excess lag of an actuator, and its health.

    * The lag reported is what remains until the command applies; the *command lag* is the one reported when the
      command last changed by more than 0.1 (0 for a return to zero), and a change of phase clears it.
    * ``actuator_stall``: a command above 0.1 that applies, an error above 2 and no current, true for more than
      ``stall_seconds``; it ends with the condition.
    * ``signal_miss``: a command above 0.1 that applies without any command lag.
    * ``excessive_lag``: a command lag above the phase's limit. Both stay until the phase changes.

    Nothing is tested in the ``idle`` phase. Three passes over split keys: earlier command and phase, then command lag
    and the start of the stall, then what is kept since the phase began.
    """
    d = W.bounded(df, 1, lambda w: {
        "_pc": F.coalesce(F.lag(command, 1).over(w), F.lit(0.0)), "_pp": F.lag("phase", 1).over(w),
        "_first": F.lag(F.lit(True), 1).over(w).isNull()}, keys, order)
    begins = F.col("_first") | ~F.col("phase").eqNullSafe(F.col("_pp"))
    active = ~F.col("phase").eqNullSafe(F.lit(idle))
    changed = active & (F.abs(F.col(command) - F.col("_pc")) > 0.1)
    given = F.coalesce((F.col(command) > 0.1) & (F.col(lag) == 0) & active, F.lit(False))
    jammed = given & F.coalesce((F.abs(F.col(command) - F.col(actual)) > 2.0) & (F.col(current) == 0.0), F.lit(False))
    d = d.withColumn("_given", given).withColumn("_jam", jammed).withColumn("_begins", begins).withColumn(
        "_set", F.when(F.coalesce(changed, F.lit(False)), F.when(F.col(command) > 0, F.coalesce(F.col(lag), F.lit(0.0))).otherwise(0.0))
        .when(begins, F.lit(0.0)))
    # a stall is timed over the tested readings only: an idle one neither starts nor ends it
    d = W.scan(d, lasts={"_lag": F.col("_set"), "_tested": F.when(active, F.col("_jam"))},
               last_pos={"_begin": F.col("_begins")}, keys=keys, order=order).drop("seq")
    miss = F.col("_given") & (F.col("_lag") == 0)
    limit = F.lit(lag_default)
    for phase, v in lag_limits.items():
        limit = F.when(F.col("phase") == phase, F.lit(v)).otherwise(limit)
    late = active & (F.col("_lag") > limit)
    d = d.withColumn("_miss", F.coalesce(miss, F.lit(False))).withColumn("_late", F.coalesce(late, F.lit(False)))
    d = W.bounded(d, 1, lambda w: {"_enter": F.col("_jam") & ~F.coalesce(F.lag("_tested", 1).over(w), F.lit(False))}, keys, order)
    d = W.scan(d, lasts={"_since": F.when(F.col("_enter"), F.col(time))},
               last_pos={"_miss_at": F.col("_miss"), "_late_at": F.col("_late")}, keys=keys, order=order)
    flags = {
        "actuator_stall": F.col("_jam") & (F.col(time) - F.col("_since") > stall_seconds),
        "excessive_lag": F.coalesce(F.col("_late_at") >= F.col("_begin"), F.lit(False)),
        "signal_miss": F.coalesce(F.col("_miss_at") >= F.col("_begin"), F.lit(False)),
    }
    faults = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]), lambda x: x.isNotNull())
    bad = F.size(faults) > 0
    return d.select(
        *df.columns, F.col("_lag").alias("command_lag"), *[c.alias(n) for n, c in flags.items()], faults.alias("faults"),
        F.when(bad, "degraded").otherwise("normal").alias("status"),
        F.when(bad, "Schedule maintenance check").otherwise("Continue normal operation").alias("recommendation"))
