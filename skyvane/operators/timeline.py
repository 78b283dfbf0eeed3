"""Timelines: the interval current at a time (JON6) and the silence between ticks (AGG8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ordered as W


def asof_tag(points: DataFrame, intervals: DataFrame, keys: Sequence[str] = (), time_col: str = "ts",
             split_above: int | None = W.SPLIT_ABOVE, grain: str = "hour") -> DataFrame:
    """Tag each point with the interval ``start <= t < end`` of its key that began last (NULL tags outside all).

    Points and interval starts are merged into one sequence, and the last start seen so far is each point's
    candidate. So the shuffle holds the points once and one row per interval, however long the intervals
    are. They may not overlap within a key: of overlapping ones the later start wins, and where that has ended there is
    no tag (:func:`skyvane.operators.lookups.range_join` gives all matches). An interval without an end stays
    open. Without ``keys`` all rows are one sequence, split by time like any hot key; points without a time have no tag.
    """
    tags = [c for c in intervals.columns if c not in (*keys, "start", "end") and c not in points.columns]
    kind = points.schema[time_col].dataType
    begin = intervals.filter(F.col("start").isNotNull() & (F.col("end").isNull() | (F.col("end") > F.col("start"))))
    begin = begin.select(
        *[F.col(k).cast(points.schema[k].dataType).alias(k) for k in keys], F.col("start").cast(kind).alias("_t"), F.lit(0).alias("_kind"),
        F.struct(F.col("end").cast(kind).alias("end"), *tags).alias("_span"))
    # same start twice: the one that ends last, then the greatest tag
    best = Window.partitionBy(*keys, "_t").orderBy(F.col("_span").getField("end").desc_nulls_first(), F.col("_span").desc())
    begin = begin.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n")
    rows = points.select(*[F.col(k) for k in keys], F.col(time_col).alias("_t"), F.lit(1).alias("_kind"), F.struct(*points.columns).alias("_point"))
    both = rows.unionByName(begin, allowMissingColumns=True)
    seq = list(keys)
    if not keys:
        both, seq = both.withColumn("_all", F.lit(0)), ["_all"]
    both = W.with_bucket(both, grain, "_t", split_above, seq)
    out = W.scan(both, lasts={"_open": F.col("_span")}, keys=seq, order=("_t", "_kind"))
    out = out.filter(F.col("_kind") == 1)
    span = F.col("_open")
    inside = span["end"].isNull() | (F.col("_t") < span["end"])
    return out.select("_point.*", *[F.when(inside, span[c]).alias(c) for c in tags])


def tick_of(time: Column, seconds: int) -> Column:
    """The number of the tick that an epoch time falls in."""
    return F.floor(time / seconds)


def silences(ticks: DataFrame, expected: DataFrame, first: Column | int, last: Column | int, keys: Sequence[str],
             split_above: int | None = W.SPLIT_ABOVE) -> DataFrame:
    """AGG8: every stretch of ticks in [first, last] in which an expected sequence sent nothing.

    ``ticks``: keys and ``tick`` of each reading (repeats are dropped by a partial aggregate); ``expected``: the
    sequences that must report, among them those that never did. One row per stretch (``from_tick``,
    ``to_tick``, ``n_missing``), so a year of silence is one row and not a row per tick. A sequence is split by its
    ticks (as seconds) if it is hot.
    """
    seen = ticks.join(expected.select(*keys).distinct(), list(keys), "left_semi").select(*keys, "tick").distinct()
    seen = seen.filter((F.col("tick") >= first) & (F.col("tick") <= last))
    border = expected.select(*keys).distinct().select(*keys, F.explode(F.array(
        (F.lit(first) if isinstance(first, int) else first) - 1, (F.lit(last) if isinstance(last, int) else last) + 1)).alias("tick"))
    return between(seen.unionByName(border).withColumn("tick", F.col("tick").cast("long")), keys, split_above)


def between(rows: DataFrame, keys: Sequence[str], split_above: int | None = W.SPLIT_ABOVE) -> DataFrame:
    """The stretches of ticks missing between each sequence's rows (keys, ``tick``)."""
    rows = W.with_bucket(rows.withColumn("_at", F.timestamp_seconds("tick")), "day", "_at", split_above, keys)
    out = W.bounded(rows, 1, lambda w: {"_before": F.lag("tick", 1).over(w)}, keys, ("tick",))
    return out.filter(F.col("tick") - F.col("_before") > 1).select(
        *keys, (F.col("_before") + 1).alias("from_tick"), (F.col("tick") - 1).alias("to_tick"),
        (F.col("tick") - F.col("_before") - 1).alias("n_missing"))


def missing_per_tick(silent: DataFrame, keys: Sequence[str], by: Sequence[str], name: str = "sensor") -> DataFrame:
    """The stretches of :func:`silences` as one row per tick and ``by`` with the sorted silent names: what a
    tick's completeness report lists, also for ticks in which nothing at all was sent."""
    each = silent.select(*keys, F.explode(F.sequence("from_tick", "to_tick")).alias("tick"))
    return each.groupBy("tick", *by).agg(F.count(F.lit(1)).alias("n_missing"),
                                         F.concat_ws(",", F.array_sort(F.collect_set(name))).alias("missing"))
