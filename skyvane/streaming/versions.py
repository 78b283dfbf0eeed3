"""Small tables that a micro-batch callback keeps between batches, one version per batch.

Batch N reads version N-1 and writes version N, over whatever an earlier try of N left. So a
replayed batch starts from the same state and gives the same result. Only the two
latest versions are kept: an older one can't be asked for any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    """Create ``path`` on whatever store it names (a stream cannot read a folder that is not there yet)."""
    where, fs = _path(spark, path)
    fs.mkdirs(where)


def before(spark: SparkSession, path: str, epoch_id: int, schema) -> DataFrame:
    """The state before batch ``epoch_id``: empty before the first one."""
    if epoch_id == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch={epoch_id - 1}")


def forget(spark: SparkSession, path: str, epoch_id: int) -> None:
    """Drop the version that no replay can need once batch ``epoch_id`` has written its own."""
    where, fs = _path(spark, f"{path}/batch={epoch_id - 2}")
    fs.delete(where, True)
