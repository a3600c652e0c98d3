"""Changelog (retract) streams for non-append results (CHG-1, AGG-8).

The reference converts a running aggregate into a stream of
(insert=true/false, row) pairs.  ``running_count_changelog`` produces the
same information as rows ``(key, op, count)``: for every key touched in a
micro-batch a retraction ``-`` of its previous count (if any) and the new
count ``+``.  It is an append-mode stream, so any sink works; state is one
long per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventide.streaming.processors import RunningCountChangelog

CHANGELOG_SCHEMA = T.StructType([T.StructField("key", T.StringType()),
                                 T.StructField("op", T.StringType()),
                                 T.StructField("count", T.LongType())])


def running_count_changelog(stream: DataFrame, key: str) -> DataFrame:
    keyed = stream.select(stream[key].cast("string").alias("key"))
    return keyed.groupBy("key").transformWithState(
        RunningCountChangelog(), CHANGELOG_SCHEMA, "Append", "None")


def final_counts(changelog: DataFrame) -> DataFrame:
    """Fold a changelog table back to the current counts (last '+' per key
    equals the sum of signed counts)."""
    from pyspark.sql import functions as F
    signed = F.when(F.col("op") == "+", F.col("count")).otherwise(-F.col("count"))
    return changelog.groupBy("key").agg(F.sum(signed).alias("count"))
