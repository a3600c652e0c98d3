"""Side outputs as a tag column (SNK-3).

Operators with a main and side outputs return one frame with a ``tag``
column.  Consumers either filter by tag, or write every tag in one pass
with ``partitionBy("tag")`` (one scan instead of one per output).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_by_tag(df: DataFrame, tags: Iterable[str], tag_col: str = "tag") -> dict[str, DataFrame]:
    """Lazy per-tag views; ``tags`` are the operator's declared tags."""
    return {t: df.filter(F.col(tag_col) == t).drop(tag_col) for t in tags}


def write_tagged(df: DataFrame, path: str, tag_col: str = "tag", mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(tag_col).parquet(path)


def write_tagged_stream(df: DataFrame, path: str, checkpoint: str, tag_col: str = "tag",
                        trigger: dict | None = None):
    """Streaming form: the file sink is exactly-once and keeps one folder per tag."""
    w = (df.writeStream.format("parquet").partitionBy(tag_col)
         .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
