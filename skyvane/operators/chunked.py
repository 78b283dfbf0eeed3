"""Exact sequential folds with parallelism inside a key (speculative chunks).

A fold with no associative merge (the gated EWMA, slew limiters, counters)
visits a key's rows in order, so one very large key becomes one long task.
This splits every large key into time chunks and keeps the result exact:

1. *Speculate*: fold every (key, chunk) in parallel from the initial state,
   recording the state after each row. Written to the shared checkpoint folder.
2. *Resolve*: per key, walk its chunks in order over a small input (each
   chunk's first ``prefix`` rows plus one summary row per chunk). Re-run a
   chunk's first rows from the true incoming state until the state equals the
   speculative state after the same row, bit for bit: from there on the
   speculative rows are exact (same state, same inputs, same steps). The key's
   first chunk is exact as speculated.
3. *Go on in rounds*: if a chunk has not converged within ``prefix`` rows, all
   of the key's chunks from there on are speculated again in parallel, now from
   the true state before that chunk, and resolved again. A round settles at
   least one chunk of every unresolved key; a locked gate, whose means no
   longer move, settles in the next one. No task ever folds more than one chunk.

Contractive folds (EWMA means forget their start geometrically; limiters and
"last value" states reset on the next unclamped row) converge within a few
hundred rows. Chunks are cut by a key's own rate, so they hold about
``CHUNK_ROWS`` rows each whatever that rate is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, prepare
from .fold import Fold, _key_at, key_groups, sorted_fold

CHUNK = "_chunk"


def _dedupe(cols: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(cols))


def _speculative(fold: Fold, carry_cols: Sequence[str]) -> Fold:
    """The fold plus the state after each row (``_st_<field>``) and the row's
    1-based position in its chunk (``_pos``)."""
    fields = list(fold.state)

    def step(st, xs):
        new, out = fold.step({f: st[f] for f in fields}, xs)
        n = st["_n"] + 1
        out = {**out, **{f"_st_{f}": new[f] for f in fields}, "_pos": n}
        return {**new, "_n": n}, out

    def rows(st, xs):
        out, after = fold.rows({f: st[f] for f in fields}, xs)
        n = st["_n"] + np.arange(1, len(after[fields[0]]) + 1)
        return {**out, **{f"_st_{f}": after[f] for f in fields}, "_pos": n}, {**after, "_n": n}

    outputs = {**fold.outputs, **{f"_st_{f}": "double" for f in fields}, "_pos": "double"}
    return Fold(fold.inputs, {**fold.state, "_n": 0.0}, outputs, step, _dedupe(carry_cols), rows if fold.rows is not None else None)


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b) | ((a != a) & (b != b))


def _rows_of(fold: Fold):
    """The fold's walk over one key's rows; row by row with its array step if it gives no other."""
    if fold.rows is not None:
        return fold.rows

    def rows(st, xs):
        now = {f: np.array([v], dtype=float) for f, v in st.items()}
        outs = {o: [] for o in fold.outputs}
        after = {f: [] for f in fold.state}
        for i in range(len(next(iter(xs.values())))):
            now, out = fold.step(now, {n: v[i:i + 1] for n, v in xs.items()})
            for o in outs:
                outs[o].append(float(out[o][0]))
            for f in after:
                after[f].append(float(now[f][0]))
        return {o: np.array(v) for o, v in outs.items()}, {f: np.array(v) for f, v in after.items()}

    return rows


# Rows that a re-run does before it looks for convergence; then twice as many each time.
RERUN_ROWS = 8


def _rerun(rows, st: dict[str, float], xs: dict[str, np.ndarray], spec: dict[str, np.ndarray]):
    """Re-run rows from the state ``st`` until it equals the speculative one: (outputs of the rows
    re-run, the state then, whether it is equal)."""
    n = len(next(iter(spec.values())))
    outs, i, size = [], 0, RERUN_ROWS
    while i < n:
        part = slice(i, min(i + size, n))
        out, after = rows(st, {c: x[part] for c, x in xs.items()})
        same = np.logical_and.reduce([_same(after[f], v[part]) for f, v in spec.items()])
        hit = int(np.argmax(same)) if same.any() else len(same) - 1
        outs.append({o: v[:hit + 1] for o, v in out.items()})
        st = {f: float(after[f][hit]) for f in spec}
        if same[hit]:
            return outs, st, True
        i, size = part.stop, 2 * size
    return outs, st, False


def _resolve(batches: Iterator[pd.DataFrame], keys: Sequence[str], order: Sequence[str],
             fold: Fold, prefix: int) -> Iterator[pd.DataFrame]:
    """Pass 2 over rows sorted by (keys, chunk, tag, pos): emits corrections
    (``_type`` = 'c') for re-run rows and, once per key, the first chunk that
    stays open with its true starting state (``_type`` = 'f')."""
    fields = list(fold.state)
    outs_t = fold.outputs
    rows = _rows_of(fold)
    cur_key = None
    true: dict[str, float] = {}
    dead = False
    chunk = None
    first_chunk = True
    conv = True
    st: dict[str, float] = {}
    start: dict[str, float] = {}
    out_cols = ["_type", *_dedupe([*keys, CHUNK, *order]), *outs_t, *[f"_init_{f}" for f in fields]]
    for pdf in batches:
        if len(pdf) == 0:
            continue
        found: list[np.ndarray] = []            # rows re-run, and their outputs
        again: list[dict[str, np.ndarray]] = []
        opened: list[dict] = []
        _, starts, _ = key_groups(pdf, [*keys, CHUNK, "_tag"])
        ends = np.append(starts[1:], len(pdf))
        key_no = key_groups(pdf, keys)[0]
        num = lambda c: pdf[c].to_numpy(dtype=float, na_value=np.nan)
        xs = {c: num(c) for c in fold.inputs}
        spec = {f: num(f"_st_{f}") for f in fields}
        fin = {f: num(f"_fin_{f}") for f in fields}
        tags, lens, chunks = pdf["_tag"].to_numpy(), num("_len"), pdf[CHUNK].to_numpy()
        k, no = None, -1
        for a, b in zip(starts.tolist(), ends.tolist()):
            if key_no[a] != no:
                no, k = key_no[a], _key_at(pdf, keys, a)
                if k != cur_key:
                    cur_key, true, dead, chunk, first_chunk = k, dict(fold.state), False, None, True
            if dead:
                continue
            if chunks[a] != chunk:
                chunk = chunks[a]
                start = dict(true)
                st = dict(true)
                conv = first_chunk
            if tags[a] == 0:
                if conv:
                    continue
                part, st, conv = _rerun(rows, st, {c: x[a:b] for c, x in xs.items()}, {f: v[a:b] for f, v in spec.items()})
                again += part
                found.append(np.arange(a, a + sum(len(next(iter(o.values()))) for o in part)))
            else:
                if conv:
                    true = {f: float(fin[f][a]) for f in fields}
                elif lens[a] <= prefix:
                    true = dict(st)
                else:
                    opened.append({"_type": "f", **dict.fromkeys(order), **dict(zip(keys, k)), CHUNK: chunk, **{f"_init_{f}": v for f, v in start.items()}})
                    dead = True
                first_chunk = False
        if found:
            res = pdf.iloc[np.concatenate(found)][_dedupe([*keys, CHUNK, *order])].reset_index(drop=True)
            res.insert(0, "_type", "c")
            for o, t in outs_t.items():
                vals = np.concatenate([p[o] for p in again])
                res[o] = (pd.array(np.where(np.isnan(vals), None, vals == 1.0), dtype="boolean")
                          if t == "boolean" else vals)
            yield res.reindex(columns=out_cols)
        if opened:
            yield pd.DataFrame.from_records(opened, columns=out_cols)


# Keys with more rows than this are split into chunks; the rest stay whole.
SPLIT_ABOVE = 2_000_000
# Rows of a chunk, by the key's average rate.
CHUNK_ROWS = 200_000


def by_rate(df: DataFrame, hot: DataFrame, keys: Sequence[str], time_col: str, chunk_rows: int) -> DataFrame:
    """Add the chunk of each row: equal spans of a hot key's time, as many as its
    rows need; other keys are chunk 0. ``hot`` has the keys, ``_rows``, ``_from`` and ``_to``."""
    cond = None
    h = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_rows", "_from", "_to")
    for k in keys:
        e = df[k].eqNullSafe(h[f"_h_{k}"])
        cond = e if cond is None else cond & e
    at = F.unix_micros(F.col(time_col).cast("timestamp"))
    n = F.ceil(F.col("_rows") / F.lit(chunk_rows))
    span = F.greatest((F.col("_to") - F.col("_from") + 1) / n, F.lit(1.0))
    chunk = F.when(F.col("_rows").isNotNull(), F.floor((at - F.col("_from")) / span).cast("long")).otherwise(F.lit(0).cast("long"))
    return df.join(h, cond, "left").withColumn(CHUNK, chunk).select(*df.columns, CHUNK)


def chunked_fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], fold: Fold,
                 chunk: Column | None = None, prefix: int = 256, split_above: int = SPLIT_ABOVE,
                 chunk_rows: int = CHUNK_ROWS, rounds: list[int] | None = None,
                 init_cols: dict[str, str] | None = None) -> DataFrame:
    """Exactly :func:`sorted_fold` (same rows, same outputs), but parallel over
    (key, chunk) for keys with more than ``split_above`` rows. ``init_cols`` (state field -> column, named
    ``_init_<field>``) gives each key's state before its first row.

    ``chunk`` is a timestamp bucket that is non-decreasing in ``order`` within
    a key; by default the key's time span (``order[0]``) in equal parts of about
    ``chunk_rows`` rows. Smaller keys are one chunk, whose speculative fold is
    already exact. ``rounds`` collects the number of unresolved keys after each round.
    """
    prepare(df.sparkSession)
    # hot keys: one partial aggregate; the list has at most rows/split_above entries
    at = F.unix_micros(F.col(order[0]).cast("timestamp"))
    hot = materialize(
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min(at).alias("_from"), F.max(at).alias("_to"))
        .filter(F.col("_rows") > split_above), "chunked-hot")
    if hot.limit(1).count() == 0:
        return sorted_fold(df, keys, order, fold, init_cols=init_cols)
    pending = by_rate(df, hot, keys, order[0], chunk_rows)
    if chunk is not None:
        fine = F.unix_micros(chunk.cast("timestamp"))
        many = materialize(hot.select(*keys), "chunked-keys")
        pending = _null_safe(pending.drop(CHUNK), many.withColumn("_hot", F.lit(True)), keys).withColumn(
            CHUNK, F.when(F.col("_hot"), fine).otherwise(F.lit(0).cast("long"))).drop("_hot")
    done: list[DataFrame] = []
    init = init_cols
    while True:
        exact, rest = _round(pending, keys, order, fold, prefix, init)
        done.append(exact)
        left = 0 if rest is None else rest.select(*keys).distinct().count()
        if rounds is not None:
            rounds.append(left)
        if not left:
            break
        pending, init = rest, {f: f"_init_{f}" for f in fold.state}
        # slow convergence: look further into the chunks, but never into more than a fiftieth
        prefix = min(4 * prefix, max(prefix, CHUNK_ROWS // 50))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys where NULL equals NULL; the columns of ``right`` that are not keys are added."""
    extra = [c for c in right.columns if c not in keys]
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *extra)
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).select(*left.columns, *extra)


def _round(pending: DataFrame, keys: Sequence[str], order: Sequence[str], fold: Fold, prefix: int,
           init: dict[str, str] | None) -> tuple[DataFrame, DataFrame | None]:
    """Speculate and resolve all chunks of ``pending``: (exact output rows, input rows
    of the chunks still open with their keys' true state in ``_init_<field>``)."""
    fields = list(fold.state)
    ckeys = [*keys, CHUNK]
    carry = _dedupe([*fold.passthrough, *order, *fold.inputs])
    spec = materialize(sorted_fold(pending, ckeys, order, _speculative(fold, carry), init_cols=init), "chunked-fold")
    summary = spec.groupBy(*ckeys).agg(
        F.max("_pos").alias("_len"),
        *[F.max_by(f"_st_{f}", "_pos").alias(f"_fin_{f}") for f in fields])
    # a key's first chunk is exact as speculated: its rows need no re-run
    firsts = summary.groupBy(*keys).agg(F.min(CHUNK).alias("_first"))
    heads = (_null_safe(spec.filter(F.col("_pos") <= prefix), firsts, keys, "inner")
             .filter(F.col(CHUNK) > F.col("_first"))
             .select(*ckeys, *_dedupe([*order, *fold.inputs]), "_pos",
                     *[f"_st_{f}" for f in fields], F.lit(0).alias("_tag")))
    p2 = heads.unionByName(summary.withColumn("_tag", F.lit(1)), allowMissingColumns=True)
    types = {f.name: f.dataType.simpleString() for f in spec.schema.fields}
    out_schema = ", ".join(
        ["`_type` string"] + [f"`{c}` {types[c]}" for c in _dedupe([*ckeys, *order])]
        + [f"`{o}` {t}" for o, t in fold.outputs.items()]
        + [f"`_init_{f}` double" for f in fields])
    k, o_ = list(keys), list(order)
    resolved = materialize(
        p2.repartition(*keys).sortWithinPartitions(*keys, CHUNK, "_tag", "_pos")
        .mapInPandas(lambda it: _resolve(it, k, o_, fold, prefix), out_schema), "chunked-resolve")
    out_cols = _dedupe([*keys, *fold.passthrough])
    outs = list(fold.outputs)
    opened = resolved.filter(F.col("_type") == "f").select(
        *keys, F.col(CHUNK).alias("_open"), *[f"_init_{f}" for f in fields])
    corr = resolved.filter(F.col("_type") == "c").select(
        *keys, *_dedupe(order), *[F.col(o).alias(f"_c_{o}") for o in outs], F.lit(True).alias("_hit"))
    kept = _null_safe(spec, opened.select(*keys, "_open"), keys).filter(
        F.col("_open").isNull() | (F.col(CHUNK) < F.col("_open")))
    kept = _null_safe(kept, corr, _dedupe([*keys, *order]))
    exact = kept.select(*out_cols, *[F.when(F.col("_hit"), F.col(f"_c_{o}")).otherwise(F.col(o)).alias(o) for o in outs])
    if opened.limit(1).count() == 0:
        return exact, None
    carry = [c for c in carry if not c.startswith("_init_")]
    rest = _null_safe(spec.select(*_dedupe([*ckeys, *carry])), opened, keys, "inner").filter(F.col(CHUNK) >= F.col("_open"))
    return exact, materialize(rest.drop("_open"), "chunked-open")
