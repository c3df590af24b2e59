"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is fully executed with the ``noop`` sink (no driver collect); a batch
query's time is the median of three runs, a stream's is that of one.  ``value`` adds up
the headline queries; ``extra`` has the other ones' times.
``q1_all`` / ``q2_all`` run a whole query job: all three window sizes from
one shared first-level aggregate, as the streaming job does.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "rank_article_1h", "rank_article_24h", "rank_article_7d", "rank_article_24h_entry",
    "rollup_article_7d", "profile_24h", "profile_7d", "profile_30d", "profile_7d_entry",
    "rank_lines_1h", "profile_lines_24h", "valid_comments", "reject_reasons",
    "json_roundtrip", "csv_roundtrip", "rank_lineitem_24h", "rank_lineitem_7d",
    "profile_lineitem_30d", "stream_rank_7d", "stream_profile_24h", "stream_profile_lines_7d",
]

# Not part of the total, so that it stays comparable between rounds.
EXTRA = [
    "wire_rank_lines_24h", "wire_profile_lines_7d", "csv_file_comments", "csv_multiline_comments", "late_verdicts", "late_exact_rank_1h",
    "threshold_rank_7d", "threshold_rank_lineitem_7d", "incremental_rank_7d", "publish_observed", "stream_late_rank_1h",
    "stream_shared_rank_7d", "stream_shared_profile_7d", "stream_dedup_rank_1h",
]


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from windtally import get_spark
    from windtally.plans.catalog import QUERIES
    from windtally.plans.fixtures import comments_from_events

    # One shuffle partition per core: batch stages are coalesced by AQE anyway;
    # streaming state stores (AQE off) are fixed at this count per checkpoint.
    spark = get_spark(f"local[{cpus}]", app="windtally-bench", shuffle_partitions=cpus)
    # Warm-up (not timed): every headline query once on the smallest tables so
    # JIT and whole-stage-codegen compilation are not charged to one query.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.exists(f"{warm_dir}/events.parquet"):
        warm_dir = None  # no small tables available: measure cold
    for name in HEADLINE if warm_dir else []:
        _noop(QUERIES[name](spark, warm_dir))

    def timed(name: str) -> float:
        runs = []
        for _ in range(1 if name.startswith(("stream_", "incremental_")) else 3):
            t = time.perf_counter()
            _noop(QUERIES[name](spark, sf_dir))
            runs.append(time.perf_counter() - t)
        return round(statistics.median(runs), 3)

    times = {name: timed(name) for name in HEADLINE}

    # Whole jobs (plans.jobs.batch_results): the first-level aggregate is
    # checkpointed once to spark.checkpoint.dir and every window size is
    # derived from it — the timing includes that checkpoint write.
    from windtally.plans import jobs
    comments = comments_from_events(spark, sf_dir)
    for q in ("q1", "q2"):
        t = time.perf_counter()
        for df in jobs.batch_results(spark, comments, q, fmt="rows").values():
            _noop(df)
        times[f"{q}_all"] = round(time.perf_counter() - t, 3)

    # Streaming throughput and state size: Q1 7-day ranking over ``events``
    # replayed as a file stream, chained (1h -> 24h -> 7d) and direct.
    from windtally.plans.fixtures import events_stream, events_to_comments
    from windtally.session import scratch_path
    from windtally.streaming.runner import start
    stream_stats = {}
    for label, chained in (("q1_7d_chained", True), ("q1_7d_direct", False)):
        t = time.perf_counter()
        h = start(events_to_comments(events_stream(spark, sf_dir)), "q1", "7d",
                  path=scratch_path(spark, "bench-out"), checkpoint=scratch_path(spark, "bench-ck"),
                  chained=chained, state_partitions=cpus)
        h.awaitTermination()
        secs = time.perf_counter() - t
        prog = h.recentProgress
        rows = sum(p["numInputRows"] for p in prog)
        stream_stats[label] = {
            "sec": round(secs, 3), "input_rows": rows, "rows_per_sec": round(rows / secs),
            "batches": len(prog),
            "peak_state_rows": max((sum(op.get("numRowsTotal", 0) for op in p["stateOperators"]) for p in prog),
                                   default=0),
        }
        times[f"stream_{label}"] = round(secs, 3)

    extra = {name: timed(name) for name in EXTRA}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "extra": extra,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "warmup_dir": warm_dir,
        "stream_stats": stream_stats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
