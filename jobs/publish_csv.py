"""J2 — publish the historical CSV table as keyed-JSON comment messages.

    spark-submit jobs/publish_csv.py --input CSV_PATH (--brokers H:P [--topic comments] | --out DIR)
        [--quarantine DIR]

Fully parallel (no per-row producer, no replay pacing): the CSV is read with
standard quoting, validated with the same rules as the consumer, valid rows
are encoded (key = comment id, epoch milliseconds) and written in one job.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str], spark=None) -> int:
    """Run the job; with ``spark`` given, reuse that session and leave it running."""
    p = argparse.ArgumentParser()
    p.add_argument("--input", required=True)
    p.add_argument("--brokers")
    p.add_argument("--topic")
    p.add_argument("--out")
    p.add_argument("--quarantine")
    a = p.parse_args(argv)
    if not (a.brokers or a.out):
        p.error("give --brokers or --out")

    from windtally import get_spark
    from windtally.plans.jobs import publish
    from windtally.sources.comments import csv_comments
    from windtally.sources.sinks import INPUT_TOPIC, kafka_sink_options

    own = spark is None
    spark = spark or get_spark(app="windtally-publish")
    checked = csv_comments(spark, a.input)
    if a.brokers:
        publish(checked, "kafka", kafka=kafka_sink_options(a.brokers, a.topic or INPUT_TOPIC), quarantine=a.quarantine)
    else:
        publish(checked, "json", out=a.out, quarantine=a.quarantine)
    if own:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
