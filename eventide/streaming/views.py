"""SQL over streaming views (PRJ-5, PRJ-6, AGG-8, TOP-2).

A stream registered as a view can be queried like a table; the result is a
stream.  Queries without an aggregate append rows.  Aggregates run in
``update`` mode: every micro-batch writes the groups it changed, and the reader
takes the last version of each group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from eventide.streaming.runner import run_and_read, run_to_table
from eventide.streaming.upsert import latest


def stream_view(stream: DataFrame, name: str) -> str:
    """Register a stream as a temporary view."""
    if not stream.isStreaming:
        raise ValueError(f"{name}: not a stream")
    stream.createOrReplaceTempView(name)
    return name


def streaming_sql(spark: SparkSession, sql: str) -> DataFrame:
    """The stream behind a query over streaming views."""
    out = spark.sql(sql)
    if not out.isStreaming:
        raise ValueError("the query reads no streaming view")
    return out


def sql_appended(spark: SparkSession, sql: str, name: str,
                 transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows of a query without an aggregate (or with a closed window)."""
    return run_and_read(streaming_sql(spark, sql), name, transform=transform)


def sql_latest(spark: SparkSession, sql: str, name: str, keys: Sequence[str]) -> DataFrame:
    """The last version of every group of an aggregating query."""
    stream = streaming_sql(spark, sql)
    folder = run_to_table(stream, name, output_mode="update")
    return latest(spark.read.parquet(folder), keys).select(*stream.columns)
