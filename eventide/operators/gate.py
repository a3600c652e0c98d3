"""Per-key abuse gate with a one-time warning (GATE-1, WIN-3, SNK-3).

Semantics (per key and period, in event order): let n be the number of
events already passed in the period.  If n > max_count the event is dropped,
and the first dropped event produces one warning.  So max_count + 1 events
pass and event max_count + 2 warns.  The reference resets at the next UTC
midnight of processing time; here the period is the event-time day (or any
window size, or ``None`` for no reset).

Batch form: the position of each event inside its (key, period) is computed
with :func:`keyed_position`, which only ever looks at the first
max_count + 2 events of a key: each task forwards no more of a key than that,
so a hot key costs nothing.  Beyond the bound of that plan (a thousand rows)
hot keys are cut by volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import epoch_micros, event_window, time_bucket
from eventide.operators.topn import WINDOW_GROUP_LIMIT_MAX
from eventide.plans.ordered import keyed_position, volume_cuts

# Fixed value: the reference's warning text is "Click over" + max + " times today."
GATE_MSG_PREFIX = "Click over"
GATE_MSG_SUFFIX = " times today."
TAG_PASS = "pass"
TAG_BLACKLIST = "blacklist"


def gate_message(max_count: int) -> str:
    return f"{GATE_MSG_PREFIX}{max_count}{GATE_MSG_SUFFIX}"


def click_gate(df: DataFrame, keys: Sequence[str] = ("user_id", "ad_id"), ts: str = "ts",
               max_count: int = 100, period: str | None = "1 day", seq: str | None = None,
               bucket: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """Passed events and warnings in one frame, told apart by ``tag``
    (``pass`` / ``blacklist``); ``msg`` is set on warnings.  Dropped events
    after the warning are not returned."""
    keys = list(keys)
    d = df
    part_keys = keys
    if period is not None:
        d = d.withColumn("__period", event_window(ts, period).start)
        part_keys = keys + ["__period"]
    order = [ts] + ([seq] if seq else [])
    cuts = None
    if bucket:
        cuts = time_bucket(ts, bucket)
    elif max_count + 2 > WINDOW_GROUP_LIMIT_MAX:
        cuts = volume_cuts(d, part_keys, epoch_micros(ts), hot_rows)
    pos = keyed_position(d, part_keys, order, cuts, "__pos", limit=max_count + 2)
    tagged = pos.withColumn(
        "tag", F.when(F.col("__pos") <= max_count + 1, F.lit(TAG_PASS))
                .otherwise(F.lit(TAG_BLACKLIST)))
    tagged = tagged.withColumn(
        "msg", F.when(F.col("tag") == TAG_BLACKLIST, F.lit(gate_message(max_count))))
    return tagged.select(*df.columns, "tag", "msg")


def gate_passed(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("tag") == TAG_PASS).drop("tag", "msg")


def gate_warnings(gated: DataFrame, keys: Sequence[str] = ("user_id", "ad_id"),
                  ts: str = "ts") -> DataFrame:
    return gated.filter(F.col("tag") == TAG_BLACKLIST).select(*keys, ts, "msg")
