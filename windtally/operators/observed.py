"""Validity counts taken in the same pass as the work (P5).

``observed`` attaches the counts of valid rows and of every reject reason to a
checked frame as an observation, so that whatever action runs on it delivers
them too, without a second scan.  ``publish_observed`` is the publish job on top of
it: the messages become visible only if the share of rejects is acceptable.
``RejectGuard`` does the same for streams, from each batch's progress.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from windtally.operators.quality import valid_only
from windtally.schema import EPOCH_FIELDS, INT_FIELDS, UNSIGNED_FIELDS, WIRE_FIELDS
from windtally.session import rename_path


class RejectShareExceeded(RuntimeError):
    """Too large a share of the records is invalid."""


def reasons() -> list[str]:
    """Every reason a record can be rejected for, in rule order."""
    out = ["value_null", "not_json", *[f"missing:{f}" for f in WIRE_FIELDS]]
    for f in WIRE_FIELDS:
        if f in (*EPOCH_FIELDS, *UNSIGNED_FIELDS, *INT_FIELDS):
            out.append(f"bad:{f}")
        if f == "createDate":
            out.append(f"range:{f}")
    return out


def _counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.count_if("is_valid").alias("valid"),
            *[F.count_if(F.col("reject_reason") == r).alias(r) for r in reasons()]]


def observed(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """``checked`` (batch) with its counts; read them with ``reject_counts`` after an action."""
    seen = Observation(f"validity-{uuid.uuid4().hex}")
    return checked.observe(seen, *_counts()), seen


def reject_counts(metrics: dict) -> dict[str, int]:
    """Reasons that occurred, with their counts."""
    return {r: metrics[r] for r in reasons() if metrics.get(r)}


def check_share(rows: int, valid: int, max_share: float | None) -> None:
    if max_share is not None and rows and (rows - valid) / rows > max_share:
        raise RejectShareExceeded(f"{rows - valid} of {rows} records are invalid, more than a share of {max_share}")


def publish_observed(checked: DataFrame, out: str, max_share: float | None = None) -> dict[str, int]:
    """Write valid comments as JSON lines to ``out`` and return the reject counts, in one scan.

    The files are written beside ``out`` and renamed; with more than
    ``max_share`` of rejects the job fails and ``out`` does not appear."""
    from windtally.sources.comments import encode_wire

    seen_rows, seen = observed(checked)
    staging = f"{out.rstrip('/')}.staging-{uuid.uuid4().hex}"
    encode_wire(valid_only(seen_rows)).select("value").write.text(staging)
    metrics = seen.get
    check_share(metrics["rows"], metrics["valid"], max_share)
    rename_path(checked.sparkSession, staging, out)
    return reject_counts(metrics)


class RejectGuard(StreamingQueryListener):
    """Adds up a stream's validity counts and stops it beyond a share of rejects.

    Attach with ``spark.streams.addListener(guard)`` and run the stream on
    ``guard.watch(checked)``.  A batch that is replayed counts once.  The share
    is judged from ``min_rows`` on; ``check`` raises once it has been exceeded."""

    def __init__(self, max_share: float | None = None, min_rows: int = 1):
        self.name, self.max_share, self.min_rows = f"validity_{uuid.uuid4().hex[:12]}", max_share, min_rows
        self.batches: dict[tuple[str, int], dict] = {}
        self.tripped = False

    def watch(self, checked: DataFrame) -> DataFrame:
        self.spark = checked.sparkSession
        return checked.observe(self.name, *_counts())

    def total(self, name: str) -> int:
        return sum(b[name] for b in self.batches.values())

    def rejects(self) -> dict[str, int]:
        return {r: n for r in reasons() if (n := self.total(r))}

    def check(self) -> None:
        if self.total("rows") >= self.min_rows:
            check_share(self.total("rows"), self.total("valid"), self.max_share)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = (event.progress.observedMetrics or {}).get(self.name)
        if row is None:
            return
        self.batches[(str(event.progress.id), event.progress.batchId)] = row.asDict()
        try:
            self.check()
        except RejectShareExceeded:
            if not self.tripped:
                self.tripped = True
                query = self.spark.streams.get(str(event.progress.id))
                if query is not None:  # not from the listener's own thread: stopping waits for it
                    threading.Thread(target=query.stop, daemon=True).start()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
