"""Tumbling event-time windows and the two-hour time-of-day bucket.

All windows are aligned to the Unix epoch in UTC plus a fixed start offset,
which is exactly what ``F.window(ts, d, d, offset)`` computes, so one spec
serves batch, streaming and chained (hierarchical) use.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class WindowSpec:
    name: str
    duration: str
    offset: str
    seconds: int

    def over(self, time_col: Column | str) -> Column:
        """``window`` struct for a raw event-time column."""
        return F.window(time_col, self.duration, self.duration, self.offset)

    def over_window(self, window_col: Column | str = "window") -> Column:
        """Chained form: assign a finer window (struct) to this coarser one.

        ``window_time`` (end - 1 µs) keeps the event-time marker, so the same
        expression works in an append-mode stream after a first aggregation.
        """
        return F.window(F.window_time(window_col), self.duration, self.duration, self.offset)

    def end_ms(self, time_col: Column | str) -> Column:
        """End (epoch ms) of the window of a time; null for null, where ``over`` drops the row."""
        number, unit = self.offset.split()
        offset = int(number) * {"seconds": 1, "days": 86400}[unit] * 1000
        ms = F.unix_millis(time_col)
        return ms - F.pmod(ms - offset, F.lit(self.seconds * 1000)) + self.seconds * 1000


# --- fixed values: window sizes and start offsets ---------------------------
# 7 days starts on Mondays: offset -3 days from the epoch (a Thursday), i.e. +4.
# 30 days uses offset +12 days, so a window begins on 2018-01-01.
HOUR = WindowSpec("1h", "1 hour", "0 seconds", 3600)
TWO_HOURS = WindowSpec("2h", "2 hours", "0 seconds", 7200)
DAY = WindowSpec("24h", "24 hours", "0 seconds", 86400)
WEEK = WindowSpec("7d", "7 days", "4 days", 7 * 86400)
DAYS30 = WindowSpec("30d", "30 days", "12 days", 30 * 86400)
# -----------------------------------------------------------------------------

SPECS = {s.name: s for s in (HOUR, TWO_HOURS, DAY, WEEK, DAYS30)}


def bucket_label(ts: Column | str) -> Column:
    """Two-hour time-of-day label of a timestamp (UTC): ``HH:00:00``, HH even."""
    h = F.hour(ts)
    return F.concat(F.lpad((h - h % 2).cast("string"), 2, "0"), F.lit(":00:00"))


def window_start_ntz(window_col: Column | str = "window") -> Column:
    """Window start as TIMESTAMP_NTZ (UTC wall clock) for result tables."""
    c = F.col(window_col) if isinstance(window_col, str) else window_col
    return c.getField("start").cast("timestamp_ntz")
