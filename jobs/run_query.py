"""J1 — run query 1 or 2 (all three window sizes), batch or stream.

    spark-submit jobs/run_query.py q1 [true] --source json --input DIR --out DIR
        [--sink text|parquet|kafka] [--stream] [--delay "0 seconds"]
        [--checkpoint DIR] [--brokers HOST:PORT,...] [--topic comments]

The query name is case-insensitive; a second positional ``true`` (any case)
turns latency tracking on, anything else leaves it off.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

USAGE = "run_query.py {query1|query2|q1|q2} [true] --input PATH --out PATH [options]"


def main(argv: list[str], spark=None) -> int:
    """Run the job; with ``spark`` given, reuse that session and leave it running."""
    p = argparse.ArgumentParser(usage=USAGE)
    p.add_argument("query", help="query1 | query2 (case-insensitive; q1 / q2 also accepted)")
    p.add_argument("latency", nargs="?", default="false", help="'true' turns latency tracking on")
    p.add_argument("--source", choices=["json", "csv", "kafka", "events"], default="json")
    p.add_argument("--input")
    p.add_argument("--out", required=True)
    p.add_argument("--sink", choices=["text", "parquet", "kafka"], default="text")
    p.add_argument("--stream", action="store_true")
    p.add_argument("--delay", default="0 seconds")
    p.add_argument("--checkpoint")
    p.add_argument("--brokers")
    p.add_argument("--topic", default=None)
    p.add_argument("--quarantine")
    p.add_argument("--trigger-interval", help="stream mode: run continuously with this processing-time "
                                              "trigger (e.g. '10 seconds'); default: process what is "
                                              "available now and stop")
    p.add_argument("--direct", action="store_true",
                   help="stream mode: count each Q1 window size directly (one state store) instead of "
                        "chaining 1h -> 24h -> 7d")
    p.add_argument("--stage", help="stream mode: decode/validate once into this Parquet stage "
                                   "(rejects included) and run the three results from it")
    p.add_argument("--shared", metavar="DIR", help="stream mode: read the comments once and hand closed windows on "
                                                   "from level to level through logs in this folder")
    p.add_argument("--state-partitions", type=int, help="stream mode: state-store partitions, fixed for the life of "
                                                        "the checkpoint (default: spark.sql.shuffle.partitions)")
    a = p.parse_args(argv)

    q = {"query1": "q1", "q1": "q1", "query2": "q2", "q2": "q2"}.get(a.query.lower())
    if q is None:
        print(f"usage: {USAGE}")
        return 2
    if a.stream and not a.checkpoint:
        p.error("--stream needs --checkpoint: a shared folder of this job's own, kept between runs")
    latency = a.latency.lower() == "true"

    from windtally import get_spark
    from windtally.operators.quality import rejects, valid_only
    from windtally.plans import jobs
    from windtally.plans.fixtures import comments_from_events, events_stream, events_to_comments
    from windtally.sources import comments as src
    from windtally.sources.sinks import INPUT_TOPIC

    own = spark is None
    spark = spark or get_spark(app=f"windtally-{q}")
    kafka = {"kafka.bootstrap.servers": a.brokers} if a.brokers else None
    if a.source == "events":
        comments = events_to_comments(events_stream(spark, a.input)) if a.stream else comments_from_events(spark, a.input)
        checked = None
    else:
        if a.source == "json":
            checked = src.json_comments(spark, a.input, stream=a.stream)
        elif a.source == "csv":
            checked = src.csv_comments(spark, a.input, stream=a.stream)
        else:
            checked = src.kafka_comments(spark, src.kafka_options(a.brokers, a.topic or INPUT_TOPIC), stream=a.stream)
        if a.quarantine and not a.stream:
            checked = jobs.decoded(checked)
        comments = valid_only(checked)

    trigger = {"processingTime": a.trigger_interval} if a.trigger_interval else None
    if a.stream and a.stage and checked is not None:
        ck = a.checkpoint
        handles = jobs.start_staged(checked, q, stage=a.stage, out=a.out, checkpoint=ck, sink=a.sink,
                                    latency=latency, delay=a.delay, kafka=kafka, trigger=trigger,
                                    chained=not a.direct, state_partitions=a.state_partitions)
        for h in handles:
            h.awaitTermination()
    elif a.stream and a.shared:
        handles = jobs.start_shared_streams(comments, q, logs=a.shared, out=a.out, checkpoint=a.checkpoint, sink=a.sink, latency=latency,
                                            delay=a.delay, kafka=kafka, trigger=trigger, state_partitions=a.state_partitions)
        for h in handles:
            h.awaitTermination()
    elif a.stream:
        ck = a.checkpoint
        handles = jobs.start_streams(comments, q, out=a.out, checkpoint=ck, sink=a.sink, latency=latency,
                                     delay=a.delay, kafka=kafka, trigger=trigger, chained=not a.direct,
                                     state_partitions=a.state_partitions)
        if checked is not None and a.quarantine:
            handles.append(rejects(checked).writeStream.format("parquet").option("path", a.quarantine)
                           .option("checkpointLocation", f"{ck}/quarantine")
                           .trigger(**(trigger or {"availableNow": True})).start())
        for h in handles:
            h.awaitTermination()
    else:
        results = jobs.batch_results(spark, comments, q, latency, fmt="rows" if a.sink == "parquet" else "lines")
        jobs.write_batch(results, q, a.sink, a.out, kafka, latency)
        if checked is not None and a.quarantine:
            rejects(checked).write.mode("overwrite").parquet(a.quarantine)
    if own:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
