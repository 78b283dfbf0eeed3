"""Run the streaming pipeline as a job (``spark-submit -m``-style entry point).

    python -m skyvane.streaming.job --source kafka \\
        --option kafka.bootstrap.servers=host:9092 --option subscribe=sensor-data \\
        --option startingOffsets=latest --option failOnDataLoss=false \\
        --out s3a://bucket/telemetry

    python -m skyvane.streaming.job --source text --path /data/incoming \\
        --out /data/telemetry --available-now

One message source feeds all queries (model updates, training set, scored
readings with alerts, dead letters); checkpoints live under ``--out``.
"""

from __future__ import annotations

import argparse

from ..operators.lookups import learnable
from ..session import build_session
from ..sources.files import telemetry_stream
from ..feeds import WING
from ..sources.files import update_stream
from .pipeline import start_feed, start_pipeline, with_effective_ts


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="skyvane.streaming.job")
    p.add_argument("--source", default="kafka", help="kafka, text or json")
    p.add_argument("--path", default=None, help="input folder for file sources")
    p.add_argument("--option", action="append", default=[], help="source option key=value")
    p.add_argument("--out", required=True, help="base folder for sinks and checkpoints")
    p.add_argument("--trigger-seconds", type=int, default=5)
    p.add_argument("--available-now", action="store_true",
                   help="process what is there, then stop")
    p.add_argument("--shuffle-partitions", type=int, default=None)
    p.add_argument("--model-shards", type=int, default=8,
                   help="state shards per (sensor, phase); about fleet size / 5000")
    p.add_argument("--feed", choices=["wing", "events"], default="wing",
                   help="what the messages report: the ten wing sensors, or the derived events")
    p.add_argument("--feedback", default=None, metavar="SOURCE",
                   help="wing feed: read model-update messages back, from a folder or, with a kafka source, a topic")
    p.add_argument("--sink", default="text", choices=["text", "kafka"], help="where messages go")
    p.add_argument("--sink-option", action="append", default=[], help="sink option key=value")
    p.add_argument("--topic", action="append", default=[], metavar="WHAT=NAME",
                   help="topic of scored, alerts or updates messages with a kafka sink "
                   "(default: sensor-data, alerts, model-updates)")
    p.add_argument("--console", action="store_true", help="also print monitoring rows (wing feed)")
    p.add_argument("--exact-order-delay", default=None,
                   help="e.g. '1 minute': score in event order, buffered to the watermark")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(app="skyvane-stream", shuffle_partitions=args.shuffle_partitions)
    options = dict(o.split("=", 1) for o in args.option)
    records = telemetry_stream(spark, args.source, args.path, **options)
    trigger = ({"availableNow": True} if args.available_now
               else {"processingTime": f"{args.trigger_seconds} seconds"})
    common = dict(trigger=trigger, model_shards=args.model_shards, order_delay=args.exact_order_delay)
    if args.feed == "events":
        queries = start_pipeline(spark, records, args.out.rstrip("/"), **common)
    else:
        updates = None
        if args.feedback:
            updates = (update_stream(spark, "kafka", **{**options, "subscribe": args.feedback}) if args.source == "kafka"
                       else update_stream(spark, "text", args.feedback))
            updates = with_effective_ts(learnable(updates), "5 seconds")
        # a model that is fed back must blend each window once: send windows when they are closed
        queries = start_feed(spark, records, args.out.rstrip("/"), WING, updates=updates, fmt=args.sink,
                             topics=dict(t.split("=", 1) for t in args.topic), update_mode="append" if args.feedback else "update", console=args.console,
                             **dict(o.split("=", 1) for o in args.sink_option), **common)
    if args.available_now:
        for q in queries:
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
