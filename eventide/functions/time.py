"""Event-time helpers (SC-4..SC-8, SC-10, STR-4/5/7).

Everything here is a plain Column expression, so it stays inside whole-stage
codegen.  Timestamps may be ``timestamp`` or ``timestamp_ntz``; interval
arithmetic works on both without a time-zone round trip.
"""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60,
    "hour": 3600, "day": 86400, "week": 7 * 86400,
}


def duration_seconds(d) -> float:
    """'5 seconds' / '1 hour' / timedelta / number of seconds -> seconds."""
    if isinstance(d, timedelta):
        return d.total_seconds()
    if isinstance(d, (int, float)):
        return float(d)
    total, rest = 0.0, d.strip().lower()
    for num, unit in re.findall(r"(\d+(?:\.\d+)?)\s*([a-z]+)", rest):
        unit = unit.rstrip("s")
        if unit not in _UNITS:
            raise ValueError(f"unknown duration unit in {d!r}")
        total += float(num) * _UNITS[unit]
    if total == 0 and not re.search(r"\d", rest):
        raise ValueError(f"cannot parse duration {d!r}")
    return total


def duration_micros(d) -> int:
    return int(round(duration_seconds(d) * 1_000_000))


def interval(d) -> Column:
    """A day-time interval literal for ``ts + interval(d)``."""
    return F.expr(f"make_dt_interval(0, 0, 0, {duration_seconds(d):.6f})")


def from_epoch_seconds(c) -> Column:          # SC-4 (value * 1000 as event time)
    return F.timestamp_seconds(F.col(c) if isinstance(c, str) else c)


def from_epoch_millis(c) -> Column:
    return F.timestamp_millis(F.col(c) if isinstance(c, str) else c)


def epoch_micros(c) -> Column:
    """Micros since the epoch.  For ``timestamp_ntz`` the wall clock is read
    as UTC (the package pins ``spark.sql.session.timeZone`` to UTC)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def epoch_millis_text(c) -> Column:           # SC-7: window end as text of ms
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_millis(c.cast("timestamp")).cast("string")


def format_java_ts(c) -> Column:              # SC-6: java.sql.Timestamp.toString
    """'yyyy-MM-dd HH:mm:ss.f' with the fraction's trailing zeros removed
    (at least one digit), the text the reference prints for window bounds."""
    c = F.col(c) if isinstance(c, str) else c
    frac = F.regexp_replace(F.date_format(c, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("."),
                    F.when(frac == "", F.lit("0")).otherwise(frac))


def next_day_start(c) -> Column:              # SC-8: next UTC midnight
    c = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("DAY", c) + F.expr("INTERVAL 1 DAY")


def day_of(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(c)


def event_window(ts, size, slide=None) -> Column:   # STR-4 / STR-5
    """Epoch-aligned tumbling (slide=None) or sliding window struct."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.window(ts, size) if slide in (None, size) else F.window(ts, size, slide)


def hop(ts, slide, size) -> Column:           # SC-10: HOP(ts, slide, size)
    """SQL HOP argument order (slide first) mapped onto ``window``."""
    return event_window(ts, size, slide)


def time_bucket(ts, width) -> Column:
    """Integer bucket number of an event time (floor(epoch / width))."""
    t, w = epoch_micros(ts), F.lit(duration_micros(width)).cast("long")
    return F.call_function("div", t - F.pmod(t, w), w)
