"""Spark helpers shared by the operators: sessions, Arrow maps, durable tables, global offsets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyvane.session import materialize, prepare

#: Rows of an Arrow batch: whole texts can be long, so batches stay small.
ARROW_ROWS = 512


def begin(spark: SparkSession) -> SparkSession:
    """Settings of every operator here: the package on the workers, small Arrow batches."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a written table of a few numbers that may be broadcast (a few MB).
BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` only if its counted size allows; else Spark shuffles for the join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def of_least_hash(df: DataFrame, key: Column, n: int, total: int) -> DataFrame:
    """Rows of ``df`` among which are the ``n`` of least ``xxhash64(key)``, about as many: a bound on the hash from
    the counted ``total``, so that a sorted limit gets a few rows of each task and not ``n`` of each."""
    if total <= 2 * n:
        return df
    share = (1.2 * n + 1000) / total
    few = df.filter(F.xxhash64(key) <= F.lit(min((1 << 63) - 1, int(share * 2.0 ** 64) - (1 << 63))))
    return few if few.count() >= n else df


def numbered(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` once with a unique row number ``rid`` and read it back, so the
    numbers stay the same whoever is lost later."""
    return materialize(df.withColumn("rid", F.monotonically_increasing_id()), kind)


def with_offsets(df: DataFrame, keys: list[str], sums: dict[str, str], kind: str,
                 group: str | None = None) -> DataFrame:
    """Exclusive running sums in the global order of ``keys``.

    ``sums`` maps an output column to the long column it adds up; ``group`` (the
    first key) restarts them. Rows are range-partitioned and sorted once; each
    task adds up its own range while it streams, the table is written, and the
    totals of the ranges (one small row per range and group) give each range its base.
    No task holds a group and no row is moved twice.
    """
    cols = df.columns
    ranged = df.repartitionByRange(*[F.col(k).asc_nulls_last() for k in keys]).sortWithinPartitions(
        *[F.col(k).asc_nulls_last() for k in keys])

    schema = df.schema

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        carry: dict = {}
        last = None
        for b in it:
            n = b.num_rows
            if not n:
                continue
            if group:
                g = b.column(cols.index(group)).to_pandas().to_numpy()
                cut = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [n]])
            else:
                g, cut = None, np.array([0, n])
            out = list(b.columns)
            for name, src in sums.items():
                v = b.column(cols.index(src)).to_numpy(zero_copy_only=False).astype(np.int64)
                c = np.concatenate([[0], np.cumsum(v)])
                local = np.empty(n, np.int64)
                for lo, hi in zip(cut[:-1], cut[1:]):
                    base = carry.get(name, 0) if lo == 0 and (g is None or last is None or g[0] == last) else 0
                    local[lo:hi] = c[lo:hi] - c[lo] + base
                    end = int(local[hi - 1] + v[hi - 1])
                carry[name] = end
                out.append(pa.array(local))
            last = g[-1] if g is not None else None
            out.append(pa.array(np.full(n, part, np.int32)))
            yield pa.RecordBatch.from_arrays(out, names=[*cols, *sums, "_range"])

    for name in sums:
        schema = schema.add(name, "long")
    table = materialize(ranged.mapInArrow(run, schema.add("_range", "integer")), kind)
    by = [group] if group else []
    totals = table.groupBy("_range", *by).agg(
        *[F.sum(src).alias(f"_t_{name}") for name, src in sums.items()])
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    if by:
        w = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_range", *by, *[
        F.coalesce(F.sum(f"_t_{name}").over(w), F.lit(0)).cast("long").alias(f"_b_{name}") for name in sums])
    # ranges x groups small rows: bounded by the shuffle width
    out = table.join(F.broadcast(bases), ["_range", *by], "left")
    return out.select(*cols, *[(F.col(name) + F.col(f"_b_{name}")).alias(name) for name in sums])
