"""Rows scanned and rows crossing each shuffle, per query (from Spark's event log).

Usage: python tools/shuffle_stats.py [sf_dir] [query ...]
The event log goes to a fresh scratch folder (``mktemp``-style) and is read
back after the session stops; no UI or server is involved.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DEFAULT = ["rank_article_24h", "rank_article_24h_entry", "rank_article_7d", "profile_7d", "rank_lineitem_7d"]


def _read_log(folder: str) -> list[dict]:
    out = []
    for p in glob.glob(f"{folder}/**/events_*", recursive=True):
        raw = open(p, "rb").read()
        if p.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        out += [json.loads(line) for line in raw.decode().splitlines() if line]
    return out


def main(argv: list[str]) -> None:
    from windtally import get_spark
    from windtally.plans.catalog import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    names = argv[1:] or DEFAULT
    log_dir = tempfile.mkdtemp(prefix="run-evlog-")
    spark = get_spark("local[8]", app="windtally-shuffle-stats", shuffle_partitions=8,
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    group, stages = {}, {}
    for e in _read_log(log_dir):
        if e.get("Event") == "SparkListenerJobStart":
            for sid in e.get("Stage IDs", []):
                group[sid] = (e.get("Properties") or {}).get("spark.jobGroup.id")
        elif e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            acc = {a["Name"]: a.get("Value", 0) for a in si.get("Accumulables", [])}
            stages[si["Stage ID"]] = (acc.get("internal.metrics.input.recordsRead", 0),
                                      acc.get("internal.metrics.shuffle.write.recordsWritten", 0))
    print("| query | rows scanned | rows written to each shuffle, in order |")
    print("| --- | --- | --- |")
    for n in names:
        sids = sorted(s for s, g in group.items() if g == n and s in stages)
        scanned = sum(stages[s][0] for s in sids)
        shuffles = [f"{stages[s][1]:,}" for s in sids if stages[s][1]]
        print(f"| `{n}` | {scanned:,} | {' → '.join(shuffles)} |")


if __name__ == "__main__":
    main(sys.argv[1:])
