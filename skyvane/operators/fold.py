"""Sequential per-key folds on sorted partitions (STA1-STA8 engine).

For recurrences that have no associative merge (the gated EWMA, slew
limiters, counters with reset), each key's rows must be visited in order.
The plan is:

    repartition(keys) -> sortWithinPartitions(keys, order) -> mapInPandas

The sort is Spark's external sort (spills), and ``mapInPandas`` streams Arrow
batches, so no key's rows are ever materialised at once: the only state kept
across batches is the small state of the key that straddles the batch end.
Inside a batch the step is vectorised across keys with numpy: iteration
``p`` advances every key that has a p-th row in the batch. Numpy's cost per call
is the same for one key as for fifty, so where fewer than ``FEW_KEYS`` keys still
have rows, a fold that gives its step in plain floats too (``Fold.rows``) goes on
key by key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..session import prepare

StepFn = Callable[[dict, dict], tuple[dict, dict]]
RowsFn = Callable[[dict, dict], tuple[dict, dict]]

# With fewer keys than this per iteration, plain floats are faster than numpy arrays.
FEW_KEYS = 40
# Rows that a key's walk in plain floats holds as Python objects at a time.
WALK_ROWS = 10_000


@dataclass
class Fold:
    """A vectorised fold step.

    ``state`` maps each state field to its initial value (float; NaN means
    absent). ``step(state, x)`` receives arrays for the keys advancing this
    iteration (state fields and input columns) and returns the new state and
    the per-row outputs.
    """
    inputs: Sequence[str]
    state: dict[str, float]
    outputs: dict[str, str]           # name -> Spark SQL type
    step: StepFn
    passthrough: Sequence[str] = field(default_factory=tuple)
    rows: RowsFn | None = None


def key_groups(pdf: pd.DataFrame, keys: Sequence[str]):
    """Group structure of a key-sorted frame: (group id per row, first row of
    each group, position of each row within its group)."""
    n = len(pdf)
    change = np.zeros(n, dtype=bool)
    change[0] = True
    for k in keys:
        kc, null = pdf[k].to_numpy(), pdf[k].isna().to_numpy()
        # NULL keys equal each other: a NULL arrives as NaN or None
        change[1:] |= ~((kc[1:] == kc[:-1]) | (null[1:] & null[:-1])).astype(bool)
    gid = np.cumsum(change) - 1
    starts = np.flatnonzero(change)
    return gid, starts, np.arange(n) - starts[gid]


def _key_at(pdf: pd.DataFrame, keys: Sequence[str], row: int) -> tuple:
    return tuple(None if pd.isna(v) else v for v in (pdf[k].iloc[row] for k in keys))


def fold_frame(pdf: pd.DataFrame, keys: Sequence[str], fold: Fold,
               init: dict[str, np.ndarray] | None = None):
    """Fold every key group of a key-sorted frame, vectorised across groups.

    ``init`` gives each group's initial state (arrays of length #groups);
    by default the fold's initial values. Returns (per-row outputs, final
    state per group, group start rows).
    """
    n = len(pdf)
    gid, starts, pos = key_groups(pdf, keys)
    n_groups = len(starts)
    state = ({f: np.array(init[f], dtype=float, copy=True) for f in fold.state} if init is not None
             else {f: np.full(n_groups, v, dtype=float) for f, v in fold.state.items()})
    xs = {c: pdf[c].to_numpy(dtype=float, na_value=np.nan) for c in fold.inputs}
    outs = {o: np.full(n, np.nan) for o in fold.outputs}
    by_pos = np.argsort(pos, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(pos))])
    for p in range(len(bounds) - 1):
        rows = by_pos[bounds[p]:bounds[p + 1]]
        if fold.rows is not None and len(rows) < FEW_KEYS:
            _walk(fold, state, xs, outs, gid[rows], rows, np.append(starts[1:], n))
            break
        g = gid[rows]
        new, out = fold.step({f: a[g] for f, a in state.items()},
                             {c: xs[c][rows] for c in fold.inputs})
        for f, a in new.items():
            state[f][g] = a
        for o, a in out.items():
            outs[o][rows] = a
    return outs, state, starts


def _walk(fold: Fold, state: dict, xs: dict, outs: dict, groups: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
    """Fold the rows that are left of ``groups``, from ``begins`` on, one group after the other."""
    for g, a in zip(groups.tolist(), begins.tolist()):
        st = {f: float(v[g]) for f, v in state.items()}
        for i in range(a, int(ends[g]), WALK_ROWS):
            part = slice(i, min(i + WALK_ROWS, int(ends[g])))
            out, after = fold.rows(st, {c: x[part] for c, x in xs.items()})
            for o, v in out.items():
                outs[o][part] = v
            st = {f: float(after[f][-1]) for f in state}
        for f in state:
            state[f][g] = st[f]


def output_frame(pdf: pd.DataFrame, cols: Sequence[str], fold: Fold, outs: dict) -> pd.DataFrame:
    res = pdf[list(cols)].copy()
    for o, t in fold.outputs.items():
        vals = outs[o]
        if t == "boolean":
            res[o] = pd.array(np.where(np.isnan(vals), None, vals == 1.0), dtype="boolean")
        else:
            res[o] = vals
    return res


def _run(batches: Iterator[pd.DataFrame], keys: Sequence[str], fold: Fold,
         init_cols: dict[str, str] | None = None) -> Iterator[pd.DataFrame]:
    """Stream key-sorted batches through ``fold``. A key continuing from the
    previous batch resumes its carried state; a new key starts from the fold's
    initial state, or from its row's ``init_cols`` (state field -> column)."""
    carry_key = None
    carry: dict[str, float] | None = None
    for pdf in batches:
        if len(pdf) == 0:
            continue
        first_key = _key_at(pdf, keys, 0)
        init = None
        if init_cols or (carry is not None and first_key == carry_key):
            starts = key_groups(pdf, keys)[1]
            init = {f: np.full(len(starts), v, dtype=float) for f, v in fold.state.items()}
            for f, c in (init_cols or {}).items():
                init[f] = pdf[c].to_numpy(dtype=float, na_value=np.nan)[starts]
            if carry is not None and first_key == carry_key:
                for f in init:
                    init[f][0] = carry[f]
        outs, state, _ = fold_frame(pdf, keys, fold, init)
        carry_key = _key_at(pdf, keys, -1)
        carry = {f: float(a[-1]) for f, a in state.items()}
        yield output_frame(pdf, [*keys, *fold.passthrough], fold, outs)


def sorted_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], fold: Fold,
                num_partitions: int | None = None,
                init_cols: dict[str, str] | None = None) -> DataFrame:
    """Apply ``fold`` to each key's rows in ``order``; one output row per input row.

    Output columns: keys, ``fold.passthrough``, then ``fold.outputs``.
    """
    prepare(df.sparkSession)
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out_schema = ", ".join([f"`{c}` {fields[c]}" for c in [*keys, *fold.passthrough]]
                           + [f"`{o}` {t}" for o, t in fold.outputs.items()])
    cols = list(dict.fromkeys([*keys, *order, *fold.inputs, *fold.passthrough,
                               *(init_cols or {}).values()]))
    # without a fixed count AQE may adapt the partitions to the measured size
    spread = [num_partitions] if num_partitions else []
    arranged = (df.select(*cols)
                  .repartition(*spread, *keys)
                  .sortWithinPartitions(*keys, *order))
    k = list(keys)
    return arranged.mapInPandas(lambda it: _run(it, k, fold, init_cols), out_schema)


# --------------------------------------------------------------------------
# Simple folds (STA1, STA6, STA7, STA8)
# --------------------------------------------------------------------------
def ewma_fold(x: str, alpha: float = 0.2, passthrough: Sequence[str] = ()) -> Fold:
    """STA1: ``mean = α·v + (1−α)·mean``, seeded by the first value; NULL
    values leave the mean unchanged."""
    def step(st, xs):
        v, m = xs[x], st["mean"]
        new = np.where(np.isnan(v), m, np.where(np.isnan(m), v, alpha * v + (1 - alpha) * m))
        return {"mean": new}, {"ewma": new}
    return Fold([x], {"mean": np.nan}, {"ewma": "double"}, step, passthrough)


def smoothing_fold(x: str, keep: float = 0.7, max_change: float = 0.04, lo: float = -0.06,
                   hi: float = 0.06, init: float = 0.0, passthrough: Sequence[str] = ()) -> Fold:
    """STA6: ``s = (1−keep)·x + keep·prev``, slew-limited to ±max_change
    against the previous output, clamped to [lo, hi]; prev starts at ``init``."""
    def step(st, xs):
        v, prev = xs[x], st["prev"]
        s = (1 - keep) * v + keep * prev
        s = np.where(np.abs(s - prev) > max_change,
                     np.where(s > prev, prev + max_change, prev - max_change), s)
        s = np.maximum(np.minimum(s, hi), lo)
        s = np.where(np.isnan(v), prev, s)
        return {"prev": s}, {"smoothed": s}
    return Fold([x], {"prev": init}, {"smoothed": "double"}, step, passthrough)


def slew_fold(x: str, max_change: float, passthrough: Sequence[str] = ()) -> Fold:
    """STA7: limit each step against the previous output to ±max_change;
    the first value passes through."""
    def step(st, xs):
        v, prev = xs[x], st["prev"]
        lim = np.where(np.abs(v - prev) > max_change,
                       np.where(v > prev, prev + max_change, prev - max_change), v)
        out = np.where(np.isnan(prev), v, lim)
        out = np.where(np.isnan(v), prev, out)
        return {"prev": out}, {"limited": out}
    return Fold([x], {"prev": np.nan}, {"limited": "double"}, step, passthrough)


def violation_fold(x: str, t: str, limit: str, max_violations: int = 3,
                   passthrough: Sequence[str] = (), lo: str | None = None, hi: str | None = None) -> Fold:
    """STA8: per-minute gradient against the previous *output*; a breach
    limits the value to ``prev ± limit·Δmin``, clamped to the range in columns
    ``lo`` and ``hi`` if given, and counts +1 (warn and reset at
    ``max_violations``), a normal step counts −1 (floor 0). ``gradient`` is
    the limited gradient on a breach, else the measured one (0 without a predecessor)."""
    def step(st, xs):
        v, ts, lim = xs[x], xs[t], xs[limit]
        prev, pt, cnt = st["prev"], st["prev_t"], st["count"]
        dmin = (ts - pt) / 60.0
        have = ~np.isnan(prev) & (dmin > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            grad = (v - prev) / dmin
        breach = have & (np.abs(grad) > lim)
        limited = np.where(grad > 0, lim, -lim)
        adjusted = prev + limited * dmin
        if lo is not None:
            adjusted = np.maximum(np.minimum(adjusted, xs[hi]), xs[lo])
        out = np.where(breach, adjusted, v)
        cnt1 = np.where(breach, cnt + 1, np.where(have, np.maximum(0.0, cnt - 1), cnt))
        warn = breach & (cnt1 >= max_violations)
        cnt2 = np.where(warn, 0.0, cnt1)
        return ({"prev": out, "prev_t": ts, "count": cnt2},
                {"adjusted": out, "gradient": np.where(breach, limited, np.where(have, grad, 0.0)),
                 "violations": cnt2, "warning": warn.astype(float)})
    return Fold([x, t, limit, *([lo, hi] if lo is not None else [])], {"prev": np.nan, "prev_t": np.nan, "count": 0.0},
                {"adjusted": "double", "gradient": "double", "violations": "double", "warning": "boolean"},
                step, passthrough)
