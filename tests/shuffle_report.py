"""Shuffle and scan volume per registered query, from Spark's event log.

Usage: python tests/shuffle_report.py <scratch_dir> [sf_dir] [name ...]

Writes the event log into <scratch_dir> (a fresh folder), runs each query into
the ``noop`` sink, and prints, per query, rows read from the input files and
shuffle records written, both as multiples of the events table size. A plan
that shuffles the data once shows a shuffle ratio a little above 1.
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    scratch = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    names = sys.argv[3:]
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName("shuffle-report")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", "file://" + os.path.abspath(scratch))
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from skyvane.session import checkpoint_root, prepare
    prepare(spark)
    checkpoint_root(spark)
    import __spark_entry__ as E

    qs = E.queries()
    names = names or list(qs)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    sc = spark.sparkContext
    for name in names:
        sc.setJobGroup(name, name)
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    job_group, stage_job, per = {}, {}, {}
    for f in glob.glob(f"{scratch}/**/events*", recursive=True):
        for line in open(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = g
            elif kind == "SparkListenerTaskEnd":
                g = stage_job.get(ev["Stage ID"])
                m = ev.get("Task Metrics") or {}
                a = per.setdefault(g, [0, 0])
                a[0] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                a[1] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
    print(f"{'query':28s} {'input/rows':>10s} {'shuffle/rows':>12s}")
    for name in names:
        i, s = per.get(name, [0, 0])
        print(f"{name:28s} {i / rows:10.2f} {s / rows:12.2f}")


if __name__ == "__main__":
    main()
