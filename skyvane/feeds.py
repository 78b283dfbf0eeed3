"""Feed definitions: what a message source reports and how it is scored.

A feed names, per sensor, which raw payload keys carry which feature. So the
same key means the right quantity for its sensor (the strain sensor's
``temperature_C`` is not the fuel temperature), weights and thresholds go with
clean names, and one job serves any feed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import schema as S
from .functions import decode as D
from .operators import model as M
from .session import small_methods


@dataclass(frozen=True)
class Feed:
    """``aliases``: (sensor, feature, raw keys) of the training row; ``model_only``: further
    readings that only the model scores; ``shared``: feature -> (sensor, feature) whose
    values it also takes; ``monitoring``: features of the monitoring rows."""
    aliases: Sequence[tuple[str, str, Sequence[str]]]
    monitoring: Sequence[str]
    thresholds: dict[str, float]
    weights: dict[str, float]
    update_features: dict[str, list[str]]
    model_only: Sequence[tuple[str, str, Sequence[str]]] = ()
    shared: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def sensors(self) -> list[str]:
        return list(dict.fromkeys(s for s, _, _ in self.aliases))

    @property
    def training(self) -> list[str]:
        return [f for _, f, _ in self.aliases]

    @property
    def model_features(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for s, f, _ in [*self.aliases, *self.model_only]:
            out.setdefault(s, []).append(f)
        return out

    @property
    def slots(self) -> list[str]:
        """Positions that hold a sensor's model features: as many as the widest sensor has."""
        return [f"f{i}" for i in range(max(len(v) for v in self.model_features.values()))]

    def by_sensor(self, values: dict[str, Column], default: Column) -> Column:
        """A CASE over the sensors that have a value."""
        expr = None
        for s, v in values.items():
            cond = F.col("sensor") == s
            expr = F.when(cond, v) if expr is None else expr.when(cond, v)
        return default if expr is None else expr.otherwise(default)


WING = Feed(aliases=S.WING_ALIASES, monitoring=S.WING_MONITORING, thresholds=S.WING_THRESHOLDS, weights=S.WING_WEIGHTS,
            update_features=S.WING_UPDATE_FEATURES, model_only=S.WING_MODEL_ONLY,
            shared={"strain": ("wingtip_node", "node_strain")})


def decode(records: DataFrame, feed: Feed) -> DataFrame:
    """Messages -> typed telemetry of the feed: every feature of the training row and the model
    as a column that only its sensor fills. The payload text and its map are parsed once and kept."""
    small_methods(records.sparkSession)
    env = D.parse_envelope(D.record_text(records), keep_raw=True)
    env = env.withColumn("sensor", D.normalise_sensor(F.col("sensor"))).withColumn(
        "payload", F.col("value")).withColumn("_m", D.scalar_payload(F.col("value"), D.payload_map(F.col("value"))))
    cols = [F.when(F.col("sensor") == s, D.coalesce_aliases(F.col("_m"), keys)).alias(f)
            for s, f, keys in [*feed.aliases, *feed.model_only]]
    out = env.select(
        "json_str", F.coalesce("event_id", F.xxhash64("json_str")).alias("event_id"), "asset_id", "sensor",
        "timestamp", D.event_time(F.col("timestamp")).alias("event_time"), "phase", "prediction", "is_anomaly", "payload", *cols)
    return out


def telemetry(records: DataFrame, feed: Feed) -> tuple[DataFrame, DataFrame]:
    """(telemetry, dead letters) of a feed's messages, batch or stream."""
    return D.split_dead_letters(decode(records, feed))


def monitoring_input(tel: DataFrame, feed: Feed) -> DataFrame:
    """Telemetry with the monitoring row's shared features filled from every sensor that reports them."""
    for f, (sensor, other) in feed.shared.items():
        tel = tel.withColumn(f, F.when(F.col("sensor") == sensor, F.col(other)).otherwise(F.col(f)))
    return tel


def model_rows(tel: DataFrame, feed: Feed, ts: str = "event_time", extra: Sequence[str] = ()) -> DataFrame:
    """Readings in the model's input shape: the sensor's features and their weights by position."""
    feats = feed.model_features
    thr = F.coalesce(F.element_at(S.as_map_literal(feed.thresholds), F.col("sensor")), F.lit(S.DEFAULT_THRESHOLD))
    xs = [feed.by_sensor({s: F.col(v[i]) for s, v in feats.items() if i < len(v)}, F.lit(None).cast("double")).alias(f"x_{slot}")
          for i, slot in enumerate(feed.slots)]
    ws = [feed.by_sensor({s: F.lit(feed.weights.get(v[i], S.DEFAULT_WEIGHT)) for s, v in feats.items() if i < len(v)},
                         F.lit(S.DEFAULT_WEIGHT)).alias(f"w_{slot}") for i, slot in enumerate(feed.slots)]
    return tel.select(*M.MODEL_KEYS, F.col(ts).alias("ts"), F.lit(M.READING).alias("kind"), "event_id",
                      thr.alias("threshold"), *xs, *ws, *extra)


def update_rows(updates: DataFrame, feed: Feed) -> DataFrame:
    """Update messages (``features`` map by clean name, ``effective_ts``) in the model's input shape."""
    feats = feed.model_features
    # the monitoring row's shared name stands for the sensor's own feature
    own = {(s, f): shared for shared, (s, f) in feed.shared.items()}
    xs = [feed.by_sensor({s: F.coalesce(F.col("features").getItem(v[i]),
                                        *([F.col("features").getItem(own[s, v[i]])] if (s, v[i]) in own else []))
                          for s, v in feats.items() if i < len(v)}, F.lit(None).cast("double")).alias(f"x_{slot}")
          for i, slot in enumerate(feed.slots)]
    asset = F.col("asset_id") if "asset_id" in updates.columns else F.lit(None).cast("long")
    return updates.select(asset.alias("asset_id"), "sensor", "phase", F.col("effective_ts").alias("ts"), F.lit(M.UPDATE).alias("kind"),
                          F.lit(-1).cast("long").alias("event_id"), F.lit(0.0).alias("threshold"), *xs,
                          *[F.lit(S.DEFAULT_WEIGHT).alias(f"w_{slot}") for slot in feed.slots])


def training_row(tel: DataFrame, feed: Feed, duration: str = "1 second", time_col: str = "event_time") -> DataFrame:
    """AGG1: one row per window with every feature of the feed (only its own sensor fills a feature)."""
    out = tel.groupBy(F.window(F.col(time_col), duration).alias("window")).agg(
        *[F.max(f).alias(f) for f in feed.training], F.max("prediction").alias("prediction"))
    return out.select(F.col("window.start").alias("timestamp"), *feed.training, "prediction")
