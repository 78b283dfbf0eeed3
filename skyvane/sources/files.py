"""File sources and sinks (SRC3, SNK7) and stream sources (SRC1, SRC2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S

# Log file names: ``<sensor>.json`` or ``<sensor>_faulty.json``.
LOG_NAME = r"^(.+?)(_faulty)?\.json$"


def read_sensor_logs(spark: SparkSession, path: str, indent: int | None = None, pattern: str = LOG_NAME,
                     of: str = "file_name") -> DataFrame:
    """SRC3: per-sensor logs, each file one JSON array of
    ``{timestamp, value: {...}}``; the sensor and the faulty label come from
    the file name (or, with ``of="file_path"`` and a ``pattern`` of two groups, its path). ``value`` is kept as JSON
    text for the decode functions.

    ``indent``: the logs' own layout, in which an entry is indented by that many spaces. A large file is then read by
    as many tasks as it has blocks: a line break followed by exactly these spaces and ``},`` ends an entry and stands
    nowhere else (inner braces are indented further, and a JSON text has no raw line break),
    so it serves as the text source's record separator. Without ``indent`` any layout is read, a file by one task.
    An entry that is no JSON gives NULL in ``timestamp`` and ``value``.
    """
    schema = "timestamp double, value string"
    if indent is None:
        df = spark.read.schema(schema).option("multiLine", True).json(path).select("timestamp", "value", "_metadata")
    else:
        end = "\n" + " " * indent + "}"
        text = spark.read.text(path, lineSep=end + ",").select("value", "_metadata")
        # the first entry follows the bracket; the last one has its brace and is followed by the bracket
        body = F.regexp_replace("value", r"^\s*\[", "")
        last = F.rtrim(F.regexp_replace(body, r"\s*\]\s*$", ""))
        closed = F.col("value").rlike(r"\n {%d}\}\s*\]\s*$" % indent)
        entry = F.when(closed, last).otherwise(F.concat(body, F.lit("}")))
        df = text.filter(~F.col("value").rlike(r"^\s*(\[\s*\]\s*)?$")).select(F.from_json(entry, schema).alias("e"), "_metadata").select(
            "e.*", "_metadata")
    name = F.col(f"_metadata.{of}")
    return df.select(
        F.regexp_extract(name, pattern, 1).alias("sensor"),
        (F.regexp_extract(name, pattern, 2) != "").alias("is_faulty"),
        "timestamp", "value",
    )


def write_sensor_arrays(readings: DataFrame, path: str, indent: int = 4) -> None:
    """The logs that :func:`read_sensor_logs` reads: per ``sensor`` one array of ``timestamp`` and ``value`` (a JSON
    text), in order of time, under ``path/sensor=<name>``. An array is one file, so a sensor's entries go through one
    task, sorted on disk; :func:`append_logs` has no such limit."""
    pad = " " * indent
    order = Window.partitionBy("sensor").orderBy("timestamp", "value")
    entry = F.concat(F.lit(pad + "{\n" + 2 * pad + '"timestamp": '), F.col("timestamp").cast("string"), F.lit(",\n" + 2 * pad + '"value": '),
                     F.col("value"), F.lit("\n" + pad + "}"))
    first = F.lag(F.lit(1)).over(order).isNull()
    last = F.lead(F.lit(1)).over(order).isNull()
    lines = readings.filter("timestamp is not null and value is not null").select(
        "sensor", F.concat(F.when(first, "[\n").otherwise(""), entry, F.when(last, "\n]").otherwise(",")).alias("value"))
    lines.write.partitionBy("sensor").text(path)


def append_logs(df: DataFrame, path: str, partition: str = "sensor") -> None:
    """SNK7: append readings as newline-delimited JSON, one folder per sensor
    (no whole-file rewrite per reading)."""
    df.write.mode("append").partitionBy(partition).json(path)


def read_appended_logs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read back what :func:`append_logs` wrote (partition column restored)."""
    return spark.read.schema(schema).json(path)


def telemetry_stream(spark: SparkSession, fmt: str = "text", path: str | None = None,
                     **options: str) -> DataFrame:
    """SRC1: telemetry messages as a stream with a ``value`` column.

    ``fmt="kafka"`` subscribes like the original job (pass
    ``kafka.bootstrap.servers``, ``subscribe``, ``startingOffsets``,
    ``failOnDataLoss``); file formats (``text``/``json``) take ``path`` and
    options such as ``maxFilesPerTrigger`` and give the same plan downstream.
    """
    reader = spark.readStream.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path) if path else reader.load()


def update_stream(spark: SparkSession, fmt: str = "text", path: str | None = None,
                  **options: str) -> DataFrame:
    """SRC2: model-update messages decoded from JSON."""
    raw = telemetry_stream(spark, fmt, path, **options)
    return raw.select(F.from_json(F.col("value").cast("string"), S.UPDATE_MESSAGE).alias("u")) \
              .select("u.*")


def merge_feeds(*feeds: DataFrame) -> DataFrame:
    """SET1: per-sensor feeds with different columns merged into one table
    (missing columns become NULL)."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
