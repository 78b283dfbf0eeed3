"""Ordered per-sensor operators on native window functions (WIN1-WIN13, STA9).

Every sequence is keyed by (asset, sensor) and ordered by (ts, event_id).
One key may hold a large share of all rows, so no operator partitions by the
key alone. Rows are split into (key, time bucket) partitions and stitched:

* bounded look-back (lags, rolling frames of n rows): each bucket receives a
  *halo*, the last n rows of each of its n preceding non-empty buckets, so its
  first rows see the same n predecessors as in one long sequence; halo rows
  are dropped after the window pass;
* unbounded look-back (running sums, "last non-null", islands): a two-level
  :func:`scan`. One window pass gives in-bucket running values; the values at
  each bucket's last row (one row per key and bucket) get a prefix over the
  key's buckets, joined back once and combined with the in-bucket value.

Both give exactly the single-sequence result; parallelism is the number of
(key, bucket) pairs instead of the number of keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..session import materialize, scratch_path

KEYS = ("asset_id", "sensor")
ORDER = ("ts", "event_id")
BUCKET = "_bucket"


# Keys with more rows than this are split into time buckets; others stay whole.
SPLIT_ABOVE = 1_000_000


def whole_bucket(dtype) -> Column:
    """The single bucket of an unsplit key (1970-01-01 00:00, in the bucket type)."""
    return F.date_trunc("year", F.lit("1970-01-01 00:00:00").cast(dtype))


def with_bucket(df: DataFrame, grain: str = "hour", time_col: str = "ts",
                split_above: int | None = SPLIT_ABOVE, keys: Sequence[str] = KEYS) -> DataFrame:
    """Add the time bucket that splits a key's sequence.

    Only keys with more than ``split_above`` rows are split (by ``grain``);
    the others get one constant bucket. When no key is split there is no bucket
    column at all, and the operators below are plain windows over the key.
    ``split_above=None`` splits every key (used by tests). The hot-key list
    comes from one partial aggregate, written as a small table.
    """
    whole = whole_bucket(df.schema[time_col].dataType)
    # rows without a time sort first, so they stand in the first bucket
    fine = F.coalesce(F.date_trunc(grain, F.col(time_col)), whole)
    if split_above is None:
        return df.withColumn(BUCKET, fine)
    spark = df.sparkSession
    path = scratch_path(spark, "hot-keys")
    (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
       .filter(F.col("_rows") > split_above).select(*keys, F.lit(True).alias("_hot"))
       .write.parquet(path))
    hot = spark.read.parquet(path)
    if hot.limit(1).count() == 0:
        return df
    return (df.join(hot, list(keys), "left")
              .withColumn(BUCKET, F.when(F.col("_hot"), fine).otherwise(whole))
              .drop("_hot"))


def _w(keys: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, BUCKET).orderBy(*order)


def halo_frame(df: DataFrame, n: int, keys: Sequence[str] = KEYS,
               order: Sequence[str] = ORDER) -> DataFrame:
    """Rows of ``df`` (``_halo`` false) plus, for each (key, bucket), the last
    ``n`` rows of each of the ``n`` preceding non-empty buckets relabelled to
    it (``_halo`` true). ``df`` must carry :data:`BUCKET`."""
    # Top-n per (key, bucket): Spark applies the limit per partition before
    # the shuffle, so only <= n rows per bucket and input split move.
    desc = Window.partitionBy(*keys, BUCKET).orderBy(*[F.col(c).desc() for c in order])
    tail = df.withColumn("_rn", F.row_number().over(desc)).filter(F.col("_rn") <= n).drop("_rn")
    # Each tail row is copied to the next n non-empty buckets of its key. A
    # bucket has at most n tail rows, so those buckets all appear within the
    # next n*n + n tail rows: one bounded window over the (small) tails, no
    # self-join and no second pass over the data.
    ahead = (Window.partitionBy(*keys).orderBy(BUCKET, *order)
                   .rowsBetween(1, n * n + n))
    later = F.filter(F.collect_list(BUCKET).over(ahead), lambda b: b > F.col(BUCKET))
    targets = F.slice(F.array_sort(F.array_distinct(later)), 1, n)
    tails = (tail.withColumn("_targets", targets)
                 .select(*[c for c in tail.columns if c != BUCKET],
                         F.explode("_targets").alias(BUCKET))
                 .withColumn("_halo", F.lit(True)))
    return df.withColumn("_halo", F.lit(False)).unionByName(tails)


def bounded(df: DataFrame, n: int, build: Callable[[Window], dict[str, Column]],
            keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """Add the columns ``build(w)`` returns, where ``w`` orders each key's
    rows and every expression looks back at most ``n`` rows."""
    if BUCKET not in df.columns:
        plain = build(Window.partitionBy(*keys).orderBy(*order))
        return df.select("*", *[c.alias(name) for name, c in plain.items()])
    h = halo_frame(df, n, keys, order)
    w = _w(keys, order)
    cols = build(w)
    return h.select("*", *[c.alias(name) for name, c in cols.items()]) \
            .filter(~F.col("_halo")).drop("_halo")


def scan(df: DataFrame, sums: dict[str, Column] | None = None,
         lasts: dict[str, Column] | None = None, last_pos: dict[str, Column] | None = None,
         keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """Two-level scan over each key's whole sequence, in one window pass.

    Adds ``seq`` (global 1-based position) and, per entry:

    * ``sums[name]``: running sum of the expression (NULL counts as 0);
    * ``lasts[name]``: last non-null value of the expression up to the row;
    * ``last_pos[name]``: ``seq`` of the latest row up to this one where the
      condition holds (NULL if none).

    In-bucket running values come from one window pass over (key, bucket).
    The values at each bucket's last row summarise it (one row per key and
    bucket); a prefix over the key's buckets gives each bucket's carry-in,
    joined back once on (key, bucket).
    """
    sums, lasts, last_pos = sums or {}, lasts or {}, last_pos or {}
    if BUCKET not in df.columns:
        w = Window.partitionBy(*keys).orderBy(*order)
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        d = df.withColumn("seq", F.row_number().over(w).cast("long"))
        return d.select(
            "*", *[F.coalesce(F.sum(e).over(run), F.lit(0)).alias(n) for n, e in sums.items()],
            *[F.last(e, ignorenulls=True).over(run).alias(n) for n, e in lasts.items()],
            *[F.max(F.when(c, F.col("seq"))).over(run).alias(n) for n, c in last_pos.items()])
    w = _w(keys, order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = df.withColumn("_lrn", F.row_number().over(w))
    local = ([F.sum(e).over(run).alias(f"_s_{n}") for n, e in sums.items()]
             + [F.last(e, ignorenulls=True).over(run).alias(f"_l_{n}") for n, e in lasts.items()]
             + [F.max(F.when(c, F.col("_lrn"))).over(run).alias(f"_p_{n}")
                for n, c in last_pos.items()])
    d = d.select("*", *local)
    carried = ([f"_s_{n}" for n in sums] + [f"_l_{n}" for n in lasts] + [f"_p_{n}" for n in last_pos])
    # ``d`` feeds both the bucket summary and the join back. A written table
    # (under spark.checkpoint.dir) runs the shuffle and the window once and
    # survives executor loss; its readers prune columns. Below, only rows of
    # split keys are joined, against a table with one row per hot bucket.
    d = materialize(d, "scan")
    summary = d.groupBy(*keys, BUCKET).agg(
        F.max("_lrn").alias("_cnt"), *[F.max_by(c, "_lrn").alias(c) for c in carried])
    prev = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_off", F.coalesce(F.sum("_cnt").over(prev), F.lit(0)))
    carry = summary.select(
        *keys, BUCKET, "_off",
        *[F.coalesce(F.sum(f"_s_{n}").over(prev), F.lit(0)).alias(f"_cs_{n}") for n in sums],
        *[F.last(f"_l_{n}", ignorenulls=True).over(prev).alias(f"_cl_{n}") for n in lasts],
        *[F.last(F.col("_off") + F.col(f"_p_{n}"), ignorenulls=True).over(prev).alias(f"_cp_{n}")
          for n in last_pos])
    # Rows of unsplit keys (the whole-key bucket) have no earlier bucket: their
    # carry is zero/NULL, no join. Only rows of split (hot) keys join the carry
    # table, which has one row per hot bucket, so AQE can broadcast it by its
    # measured size. NULL keys join null-safely.
    extra = [c for c in carry.columns if c not in (*keys, BUCKET)]
    types = {f.name: f.dataType for f in carry.schema.fields}
    single = F.col(BUCKET) == whole_bucket(d.schema[BUCKET].dataType)
    zero = {"_off": F.lit(0)} | {f"_cs_{n}": F.lit(0) for n in sums}
    ja = d.filter(single).select(
        *d.columns, *[(zero[c] if c in zero else F.lit(None)).cast(types[c]).alias(c)
                      for c in extra])
    ok = ~single
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    j1 = d.filter(ok).join(carry, [*keys, BUCKET], "left")
    c2 = carry.select(*[F.col(k).alias(f"_ck_{k}") for k in (*keys, BUCKET)], *extra)
    dn = d.filter(~single & ~ok)
    cond = None
    for k in (*keys, BUCKET):
        e = dn[k].eqNullSafe(c2[f"_ck_{k}"])
        cond = e if cond is None else cond & e
    j2 = dn.join(c2, cond, "left").drop(*[f"_ck_{k}" for k in (*keys, BUCKET)])
    j = ja.unionByName(j1.select(*ja.columns)).unionByName(j2.select(*ja.columns))
    out = [(F.col("_off") + F.col("_lrn")).alias("seq")]
    out += [(F.col(f"_cs_{n}") + F.coalesce(F.col(f"_s_{n}"), F.lit(0))).alias(n) for n in sums]
    out += [F.coalesce(F.col(f"_l_{n}"), F.col(f"_cl_{n}")).alias(n) for n in lasts]
    out += [F.coalesce(F.col("_off") + F.col(f"_p_{n}"), F.col(f"_cp_{n}")).alias(n)
            for n in last_pos]
    return j.select(*df.columns, *out)


# --------------------------------------------------------------------------
# Bounded look-back operators
# --------------------------------------------------------------------------
def _lag(x: str, i: int, w: Window) -> Column:
    return F.lag(F.col(x), i).over(w)


def round_half_away(c: Column, digits: int) -> Column:
    """Round half away from zero with plain IEEE arithmetic, so every engine
    gives the same bits (Python's ``round`` is half-even; only exact ties differ)."""
    p = F.lit(float(10 ** digits))
    return F.signum(c) * F.floor(F.abs(c) * p + F.lit(0.5)) / p


def weighted_lags(x: str, weights: Sequence[float], w: Window) -> Column:
    """Σ wᵢ·lag(x, i) / Σ wᵢ over the lags that exist (i = 1..len(weights))."""
    num = None
    den = None
    for i, wt in enumerate(weights, start=1):
        lg = _lag(x, i, w)
        t = F.when(lg.isNotNull(), lg * F.lit(wt))
        d = F.when(lg.isNotNull(), F.lit(wt))
        num = t if num is None else F.coalesce(num, F.lit(0.0)) + F.coalesce(t, F.lit(0.0))
        den = d if den is None else F.coalesce(den, F.lit(0.0)) + F.coalesce(d, F.lit(0.0))
    return num / den


def thermal_inertia(x: str, w: Window, factor: float = 0.85) -> Column:
    """WIN1: 0.15·x + 0.85·(weighted mean of up to 4 previous values,
    weights .4/.3/.2/.1 renormalised), rounded to 2; x itself when no history."""
    avg = weighted_lags(x, [0.4, 0.3, 0.2, 0.1], w)
    return F.when(_lag(x, 1, w).isNull(), F.col(x)).otherwise(
        round_half_away(F.col(x) * F.lit(1 - factor) + avg * F.lit(factor), 2))


# Smoothing weights by history length (oldest first).
GROWING_WEIGHTS = {
    2: [0.2, 0.8],
    3: [0.1, 0.3, 0.6],
    4: [0.05, 0.15, 0.35, 0.45],
    5: [0.03, 0.07, 0.2, 0.3, 0.4],
    6: [0.02, 0.05, 0.13, 0.2, 0.3, 0.3],
}


def growing_smooth(x: str, w: Window, weights: dict[int, list[float]] = GROWING_WEIGHTS,
                   digits: int = 3, ceiling: Column | None = None) -> Column:
    """WIN2: weighted average over a window that grows from 2 to 6 values
    (current included), the weight vector chosen by its length, kept at or below
    ``ceiling`` (the phase maximum) before rounding."""
    longest = max(weights)
    length = F.least(F.row_number().over(w), F.lit(longest))
    expr = F.when(length == 1, F.col(x))
    for L, ws in sorted(weights.items()):
        # ws is oldest-first; the newest value is lag 0
        terms = [(_lag(x, L - 1 - j, w) if L - 1 - j > 0 else F.col(x)) * F.lit(wt)
                 for j, wt in enumerate(ws)]
        smoothed = sum(terms[1:], terms[0]) / F.lit(sum(ws))
        expr = expr.when(length == L, round_half_away(
            smoothed if ceiling is None else F.least(smoothed, ceiling), digits))
    return expr


def three_point(x: str, w: Window, two: tuple[float, float], three: tuple[float, float, float],
                digits: int = 2) -> Column:
    """WIN3: 2- and 3-point weighted average of the latest values (oldest first)."""
    l1, l2 = _lag(x, 1, w), _lag(x, 2, w)
    return (F.when(l1.isNull(), F.col(x))
             .when(l2.isNull(), round_half_away(l1 * F.lit(two[0]) + F.col(x) * F.lit(two[1]), digits))
             .otherwise(round_half_away(l2 * F.lit(three[0]) + l1 * F.lit(three[1])
                                + F.col(x) * F.lit(three[2]), digits)))


def smooth_pressure(x: str, w: Window, phase: str = "phase") -> Column:
    """WIN3 + WIN4: takeoff blends with the previous raw value asymmetrically
    (0.7/0.3 when falling, 0.4/0.6 otherwise); other phases use 0.3/0.7 and
    0.2/0.3/0.5."""
    prev = _lag(x, 1, w)
    takeoff = (F.when(F.col(x) < prev, round_half_away(prev * 0.7 + F.col(x) * 0.3, 2))
                .otherwise(round_half_away(prev * 0.4 + F.col(x) * 0.6, 2)))
    other = three_point(x, w, (0.3, 0.7), (0.2, 0.3, 0.5))
    return (F.when(prev.isNull(), F.col(x))
             .when(F.col(phase) == "takeoff", takeoff)
             .otherwise(other))


def smooth_gradient(x: str, w: Window) -> Column:
    """WIN3: 0.4/0.6 then 0.2/0.3/0.5 weighted average."""
    return three_point(x, w, (0.4, 0.6), (0.2, 0.3, 0.5))


def moving_average(x: str, w: Window, n: int) -> Column:
    """WIN5: simple average of the last n values (fewer at the start)."""
    return F.avg(F.col(x)).over(w.rowsBetween(-(n - 1), Window.currentRow))


def elapsed_seconds(w: Window, time_col: str = "timestamp") -> Column:
    return F.col(time_col) - F.lag(F.col(time_col), 1).over(w)


def gradient_per_minute(x: str, w: Window, limits: dict[str, float],
                        phase: str = "phase", time_col: str = "timestamp") -> Column:
    """WIN6: (x − prev) per minute, clipped to ±limit(phase), rounded to 2,
    0 inside the 0.01 dead band or when no time elapsed; NULL without prev."""
    prev = _lag(x, 1, w)
    dmin = elapsed_seconds(w, time_col) / F.lit(60.0)
    lim = F.element_at(S.as_map_literal(limits), F.col(phase))
    g = (F.col(x) - prev) / dmin
    clipped = F.greatest(F.least(g, lim), -lim)
    return (F.when(prev.isNull(), F.lit(None).cast("double"))
             .when(dmin <= 0, F.lit(0.0))
             .when(F.abs(clipped) > 0.01, round_half_away(clipped, 2))
             .otherwise(F.lit(0.0)))


def moving_flag(x: str, w: Window, rate: float = 0.02, time_col: str = "timestamp") -> Column:
    """WIN11: |Δx| > rate·dt."""
    return F.coalesce(F.abs(F.col(x) - _lag(x, 1, w)) > F.lit(rate) * elapsed_seconds(w, time_col),
                      F.lit(False))


def trend_error(x: str, w: Window) -> Column:
    """WIN13: |v − prev| / (|prev| + 1e-6)."""
    prev = _lag(x, 1, w)
    return F.abs(F.col(x) - prev) / (F.abs(prev) + F.lit(1e-6))


def phase_transition(w: Window, phase: str = "phase") -> dict[str, Column]:
    """WIN7: previous phase, transition flag, cruise→landing flag."""
    prev = F.lag(F.col(phase), 1).over(w)
    return {
        "prev_phase": prev,
        "transition": F.coalesce(prev != F.col(phase), F.lit(False)),
        "cruise_to_landing": F.coalesce((prev == "cruise") & (F.col(phase) == "landing"),
                                        F.lit(False)),
    }


# --------------------------------------------------------------------------
# Unbounded look-back operators (islands)
# --------------------------------------------------------------------------
def phase_runs(df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """WIN7 + WIN8: transitions, run id and the reading number within the
    current phase run (resets to 1 at every phase change)."""
    b = bounded(df, 1, lambda w: {
        **phase_transition(w),
        "_start": F.coalesce(F.lag("phase", 1).over(w) != F.col("phase"), F.lit(True))},
        keys, order)
    b = scan(b, sums={"run_id": F.col("_start").cast("long")},
             last_pos={"_run_seq": F.col("_start")}, keys=keys, order=order)
    return b.withColumn("reading_in_run", F.col("seq") - F.col("_run_seq") + 1) \
            .drop("_start", "_run_seq")


def plateau_runs(df: DataFrame, x: str = "value", eps: float = 0.01, every: int = 3,
                 keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """WIN9: consecutive |Δx| < eps steps; the counter resets after reaching
    ``every``, so a flag is raised at every ``every``-th plateau step."""
    b = bounded(df, 1, lambda w: {
        "_plateau": F.coalesce(F.abs(F.col(x) - F.lag(x, 1).over(w)) < eps, F.lit(False))},
        keys, order)
    b = scan(b, last_pos={"_brk": ~F.col("_plateau")}, keys=keys, order=order)
    run = F.col("seq") - F.col("_brk")
    return (b.withColumn("plateau_len", run)
             .withColumn("plateau_count", run % every)
             .withColumn("plateau_flag", (run > 0) & (run % every == 0))
             .drop("_plateau", "_brk"))


def held_condition(df: DataFrame, cond: Column, min_seconds: float,
                   keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
                   time_col: str = "timestamp") -> DataFrame:
    """WIN12: rows where ``cond`` has held continuously for more than
    ``min_seconds`` (since the first row of the current true-island)."""
    d = df.withColumn("_c", F.coalesce(cond, F.lit(False)))
    b = bounded(d, 1, lambda w: {
        "_enter": F.col("_c") & F.coalesce(~F.lag("_c", 1).over(w), F.lit(True))},
        keys, order)
    b = scan(b, lasts={"_since": F.when(F.col("_enter"), F.col(time_col))}, keys=keys, order=order)
    held = F.when(F.col("_c"), F.col(time_col) - F.col("_since"))
    return (b.withColumn("held_s", held)
             .withColumn("stalled", F.coalesce(held > F.lit(min_seconds), F.lit(False)))
             .drop("_c", "_enter", "_since", "seq"))


def hysteresis(df: DataFrame, set_cond: Column, reset_cond: Column, name: str = "latched",
               keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """STA9: latch switched on by ``set_cond`` and off by ``reset_cond``
    (tested only when the set condition is false); off before any event."""
    ev = F.when(F.coalesce(set_cond, F.lit(False)), F.lit(1)) \
          .when(F.coalesce(reset_cond, F.lit(False)), F.lit(0))
    b = scan(df, lasts={"_latch": ev}, keys=keys, order=order)
    return b.withColumn(name, F.coalesce(F.col("_latch") == 1, F.lit(False))) \
            .drop("_latch", "seq")


def change_events(df: DataFrame, x: str = "value", min_delta: float = 0.1, keep: int = 10,
                  keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """WIN10: changes |Δx| > min_delta, and the latest ``keep`` of them per key
    (a top-k report; Spark applies the limit per partition before the shuffle)."""
    b = bounded(df, 1, lambda w: {"previous": F.lag(x, 1).over(w)}, keys, order)
    ev = b.filter(F.abs(F.col(x) - F.col("previous")) > min_delta)
    desc = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return ev.withColumn("recent_rank", F.row_number().over(desc)) \
             .filter(F.col("recent_rank") <= keep)
