"""The online model on a stream in event order, for keys of any size (STR11, STA2-STA5).

Keyed state folds a key's rows in one task and, unless it holds them back, in the order of arrival. Here the model's
state is a table with one row per key and one version per micro-batch. A batch

1. writes its rows once, adds them to those that wait, and takes out what the watermark has passed (the latest time so
   far less the delay): these are complete, so their order is final however they arrived;
2. folds them from each key's stored state with the chunked fold of
   :mod:`skyvane.operators.chunked`, which splits a key that holds most rows into parts of its time;
3. writes the scored rows, each key's new state, and what still waits.

Rows that arrive behind the watermark of an earlier batch can't be folded in order; they are kept in ``late``. Memory
is bounded by the Arrow batches of the fold whatever a key or a batch holds. All tables are versions of
:mod:`skyvane.streaming.versions`, so a replayed batch overwrites its own outputs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..operators import chunked as CH
from ..operators import fold as FD
from ..operators import model as M
from . import model_state as MS
from . import versions as V

CLOCK = "watermark_us long"


def remembering(fold: FD.Fold, passthrough: Sequence[str]) -> FD.Fold:
    """The fold with the state as outputs ``_after_<field>``: after each row where many keys advance together, and
    after the last row of each stretch that is walked for one key (its other rows have NaN)."""
    def step(st, xs):
        new, out = fold.step(st, xs)
        return new, {**out, **{f"_after_{f}": new[f] for f in fold.state}}

    def rows(st, xs):
        out, after = fold.rows(st, xs)
        n = len(after["hp"])
        last = np.arange(n) == n - 1
        return {**out, **{f"_after_{f}": np.where(last, after[f], np.nan) for f in fold.state}}, after

    return FD.Fold(fold.inputs, fold.state, {**fold.outputs, **{f"_after_{f}": "double" for f in fold.state}}, step, passthrough,
                   rows if fold.rows is not None else None)


def _until(at: Column, us: int | None) -> Column:
    """Whether a time is at most the watermark ``us`` (none yet: no time is)."""
    return F.lit(False) if us is None else at <= F.timestamp_micros(F.lit(us))


def ordered_score_writer(base: str, features: Sequence[str], delay: str, sink: Callable[[DataFrame, int], None],
                         weights: dict[str, float] | None = None, alpha: float = 0.2,
                         split_above: int = CH.SPLIT_ABOVE, chunk_rows: int = CH.CHUNK_ROWS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback over model rows (:func:`skyvane.operators.model.model_input` shape); ``sink`` gets the
    scored rows of each batch. :func:`finish` scores what waits when a stream has ended."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        _step(spark, batch, epoch_id, F.expr(f"INTERVAL {delay}"))

    def _step(spark: SparkSession, batch: DataFrame, epoch_id: int, wait) -> None:
        kept = MS.kept_columns(batch)
        fold = remembering(M.model_step(list(features), MS.row_weights(batch, features, weights), alpha), [*kept[3:], "ts"])
        fields = list(fold.state)
        state_schema = StructType([f for f in batch.schema.fields if f.name in M.MODEL_KEYS]
                                  + [StructField(f"_init_{f}", DoubleType()) for f in fields])
        state = V.before(spark, f"{base}/state", epoch_id, state_schema)
        # decoded once: the clock, what is late, what waits and the fold all read this table
        batch.write.mode("overwrite").parquet(f"{base}/arrived/batch={epoch_id}")
        fresh = spark.read.schema(batch.schema).parquet(f"{base}/arrived/batch={epoch_id}")
        at = F.col("ts").cast("timestamp")
        passed = V.before(spark, f"{base}/clock", epoch_id, CLOCK).agg(F.max("watermark_us")).first()[0]
        seen = (1 << 62) if wait is None else fresh.agg(F.max(F.unix_micros(at - wait))).first()[0]
        now = max((us for us in (passed, seen) if us is not None), default=None)
        spark.createDataFrame([(now,)], CLOCK).write.mode("overwrite").parquet(f"{base}/clock/batch={epoch_id}")
        late, ready = _until(at, passed), F.lit(True) if wait is None else _until(at, now)
        fresh.filter(late).write.mode("overwrite").parquet(f"{base}/late/batch={epoch_id}")
        # a row without a time is neither late nor ready
        timely = V.before(spark, f"{base}/waiting", epoch_id, batch.schema).unionByName(fresh.filter(F.col("ts").isNull() | ~late))
        timely.filter(F.col("ts").isNull() | ~ready).write.mode("overwrite").parquet(f"{base}/waiting/batch={epoch_id}")
        ready, init = timely.filter(F.col("ts").isNotNull() & ready), None
        if state.limit(1).count():
            # a key without a stored state begins with the fold's own
            ready, init = CH._null_safe(ready, state, M.MODEL_KEYS), {f: f"_init_{f}" for f in fields}
            ready = ready.select(*batch.columns, *[F.coalesce(F.col(f"_init_{f}"), F.lit(float(v))).alias(f"_init_{f}") for f, v in fold.state.items()])
        scored = CH.chunked_fold(ready, list(M.MODEL_KEYS), list(M.MODEL_ORDER), fold, split_above=split_above, chunk_rows=chunk_rows,
                                 init_cols=init)
        scored.write.mode("overwrite").parquet(f"{base}/folded/batch={epoch_id}")
        scored = spark.read.schema(scored.schema).parquet(f"{base}/folded/batch={epoch_id}")
        after = scored.filter(F.col("_after_hp").isNotNull()).groupBy(*M.MODEL_KEYS).agg(F.max_by(
            F.struct(*[f"_after_{f}" for f in fields]), F.struct(*M.MODEL_ORDER)).alias("_s")).select(
            *M.MODEL_KEYS, *[F.col(f"_s._after_{f}").alias(f"_init_{f}") for f in fields], F.lit(1).alias("_new"))
        both = after.unionByName(state.withColumn("_new", F.lit(0)))
        newest = both.groupBy(*M.MODEL_KEYS).agg(F.max_by(F.struct(*[f"_init_{f}" for f in fields]), "_new").alias("_s"))
        newest.select(*M.MODEL_KEYS, *[F.col(f"_s._init_{f}").alias(f"_init_{f}") for f in fields]).write.mode("overwrite").parquet(
            f"{base}/state/batch={epoch_id}")
        sink(scored.drop("ts", *[f"_after_{f}" for f in fields]), epoch_id)
        for table in ("state", "clock", "waiting", "arrived", "folded"):
            V.forget(spark, f"{base}/{table}", epoch_id)

    run.finish = lambda empty, epoch_id: _step(empty.sparkSession, empty, epoch_id, None)
    return run


def finish(writer: Callable[[DataFrame, int], None], rows_schema: StructType, spark: SparkSession, epoch_id: int) -> None:
    """Score what waits, as batch ``epoch_id`` (one after the last). Rows that arrive later are late."""
    writer.finish(spark.createDataFrame([], rows_schema), epoch_id)


def next_batch(spark: SparkSession, base: str) -> int:
    """The number after the last batch that a writer on ``base`` has finished."""
    return int(spark.read.parquet(f"{base}/clock").agg(F.max("batch")).first()[0]) + 1
