"""Session helpers: one place for the configuration the library relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every query needs for deterministic results. They are runtime SQL
# confs, so they can be applied to a session someone else built.
_RUNTIME_CONF = {
    # Phase boundaries, window starts and epoch seconds are all UTC.
    "spark.sql.session.timeZone": "UTC",
    # A payload may carry the same key twice after renaming; the later entry
    # wins, like assignment into a Python dict.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Spark 4.1 takes a union of equally partitioned children for partitioned like them, also where adaptive
    # execution has coalesced the children differently; a window above it then sees parts of its groups.
    "spark.sql.unionOutputPartitioning": "false",
    # Folds are vectorised across the keys of a batch; operators on long texts lower this for themselves.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``skyvane`` importable in the Python workers (folds, Arrow UDFs,
    keyed state): zip the package once per application and register it with
    ``addPyFile``, as ``--py-files`` would on submit."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    # Functions and classes of this package travel by value inside the
    # pickled UDFs, so workers that do not see the shipped files (e.g. the
    # driver-side runner of keyed state) need no import of it either.
    import skyvane
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(skyvane)
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="skyvane-pyfiles-"), "skyvane.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library depends on, ship the package to
    the Python workers, and return ``spark``."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def small_methods(spark: SparkSession) -> SparkSession:
    """Run stages whose generated method exceeds 8,000 bytes operator by operator: HotSpot compiles no larger
    method, so a message's many CASE branches would stay interpreted."""
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit") != "8000":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def build_session(master: str | None = None, app: str = "skyvane",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew handling switched on.

    On a cluster leave ``master`` unset; ``local[N]`` is for tests and the bench.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files of DataFrames that are no longer referenced are removed
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **_RUNTIME_CONF,
    }
    if shuffle_partitions:          # else the cluster's own setting holds
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it) or the context's
    checkpoint folder. Only a ``local`` session that names neither, as in a
    bare test, gets a folder under the system temp dir; on a cluster that
    folder would not be shared, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="skyvane-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/skyvane/{kind}/{uuid.uuid4().hex}"


def materialize(df, kind: str):
    """Write ``df`` once as a table under the shared checkpoint folder and read
    it back: cuts the lineage for a result that several later passes consume
    (and that survives executor loss, unlike a cache)."""
    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
