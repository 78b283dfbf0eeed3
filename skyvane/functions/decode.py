"""Decode telemetry messages into typed features (all JVM-side expressions).

Message -> envelope struct -> payload map -> numeric features / typed
columns. Every cast is a ``try_cast``: under ANSI mode a plain cast raises on
text such as ``"OK"``, and a bad reading must become NULL, not a failed job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def record_text(df: DataFrame, col: str = "value") -> DataFrame:
    """PRJ1: message bytes -> text (keeps the raw line for dead-lettering)."""
    return df.select(F.col(col).cast("string").alias("json_str"))


def parse_envelope(df: DataFrame, envelope=S.ENVELOPE, col: str = "json_str",
                   keep_raw: bool = False) -> DataFrame:
    """PRJ2 + PRJ3: JSON text -> envelope struct -> top-level columns.

    PERMISSIVE parsing: a malformed line gives a row of NULLs. Declare only the
    envelope fields a job needs; the parser then skips the rest.

    The struct is produced by a one-element ``inline`` generator: a later
    filter on the parsed fields (the dead-letter split) cannot be pushed below
    a generator, so each message is parsed once instead of once per use.
    """
    parsed = F.from_json(F.col(col), envelope).alias("_env")
    gen = F.inline(F.array(F.struct(parsed, *([F.col(col)] if keep_raw else []))))
    return df.select(gen).select("_env.*", *([col] if keep_raw else []))


def payload_map(value: Column) -> Column:
    """PRJ4: payload JSON text (object, or quoted JSON object) -> map<string,string>.

    A nested object declared as string arrives as its raw JSON text, so one
    ``from_json`` covers both forms. A bare scalar gives NULL (see PRJ8).
    """
    return F.from_json(value, S.PAYLOAD_MAP)


def to_double(c: Column) -> Column:
    """FIL6: text -> double, NULL when not numeric."""
    return F.try_cast(c, "double") if hasattr(F, "try_cast") else c.try_cast("double")


def scalar_payload(value: Column, m: Column) -> Column:
    """PRJ8: a payload that is a bare number becomes ``{"value": v}``."""
    return F.coalesce(
        m,
        F.when(to_double(value).isNotNull(), F.create_map(F.lit("value"), value)),
    )


def numeric_features(m: Column) -> Column:
    """PRJ7: keep only entries whose value parses as a number -> map<string,double>."""
    as_num = F.transform_values(m, lambda k, v: to_double(v))
    return F.map_filter(as_num, lambda k, v: v.isNotNull())


def feature_rows(decoded: DataFrame, *keep: str) -> DataFrame:
    """PRJ7 as rows: one (``feature``, ``fvalue``) per numeric entry, beside the columns ``keep``.

    The map comes out of a one-element generator first. The filter that an explode implies (the map is
    not empty) would otherwise repeat the whole map expression, parse included, below the generator.
    """
    one = decoded.select(*keep, F.explode(F.array("features")).alias("_features"))
    return one.select(*keep, F.explode("_features").alias("feature", "fvalue"))


def rename_keys(m: Column, key_map: dict[str, str]) -> Column:
    """PRJ6: raw keys -> clean names from a literal map; unknown keys pass through."""
    lookup = S.as_map_literal(key_map)
    return F.transform_keys(m, lambda k, v: F.coalesce(F.element_at(lookup, k), k))


def edge_features(value: Column, key_map: dict[str, str]) -> Column:
    """PRJ4 + PRJ8 + PRJ6 + PRJ7: the feature map the edge model consumes."""
    return numeric_features(rename_keys(scalar_payload(value, payload_map(value)), key_map))


def coalesce_aliases(m: Column, raw_keys: Sequence[str]) -> Column:
    """PRJ9 + PRJ5: first non-null alias of a feature, as a double."""
    return F.coalesce(*[to_double(F.element_at(m, F.lit(k))) for k in raw_keys])


def flatten(m: Column, spec: Iterable[tuple[str, Sequence[str]]]) -> list[Column]:
    """PRJ5: one typed double column per (feature, raw keys) of ``spec``."""
    return [coalesce_aliases(m, keys).alias(name) for name, keys in spec]


def event_feature_spec() -> list[tuple[str, list[str]]]:
    """Flatten spec of the derived telemetry; the scalar form maps to ``value``."""
    return [(f, keys) for f, keys in S.EVENT_RAW_KEYS.items()]


def normalise_sensor(sensor: Column) -> Column:
    """Sensor names that mean the same sensor collapse to one name."""
    return F.coalesce(F.element_at(S.as_map_literal(S.WING_SENSOR_NAMES), sensor), sensor)


def event_time(epoch: Column) -> Column:
    """PRJ10: epoch seconds (double, with fraction) -> TIMESTAMP."""
    return F.timestamp_seconds(epoch)


def valid_envelope(df: DataFrame) -> Column:
    """FIL8: a usable message has a sensor and a time."""
    return F.col("sensor").isNotNull() & F.col("timestamp").isNotNull()


def decode_stream(records: DataFrame, key_map: dict[str, str] | None = None,
                  spec: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Full decode of message records into typed telemetry with event time.

    Works unchanged on a batch or a streaming DataFrame. Rows without sensor
    or time are kept (see :func:`split_dead_letters`).
    """
    spec = spec if spec is not None else event_feature_spec()
    key_map = key_map if key_map is not None else S.EVENT_KEY_MAP
    env = parse_envelope(record_text(records), keep_raw=True)
    # The payload map is materialised as its own column (parsed once) and then
    # read by the feature map and every flattened column.
    env = env.withColumn("_m", scalar_payload(F.col("value"), payload_map(F.col("value"))))
    m = F.col("_m")
    return env.select(
        "json_str", "event_id", "asset_id",
        normalise_sensor(F.col("sensor")).alias("sensor"),
        "timestamp", event_time(F.col("timestamp")).alias("event_time"),
        "phase", "prediction", "is_anomaly",
        F.col("value").alias("payload"),
        numeric_features(rename_keys(m, key_map)).alias("features"),
        *flatten(m, spec),
    )


def split_dead_letters(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FIL8: (good rows, dead letters with the raw line)."""
    ok = valid_envelope(decoded)
    return (decoded.filter(ok).drop("json_str"),
            decoded.filter(~ok).select("json_str"))
