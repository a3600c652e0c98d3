"""Kafka string source and sink (SRC-8, SNK-1).

The Kafka connector jar is not bundled; these functions only build the
reader/writer, so they work wherever the cluster provides
``spark-sql-kafka``.  Parsing and formatting of the message value are plain
DataFrame transforms and are tested without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.sources.delimited import format_lines, parse_lines


def kafka_source_options(bootstrap_servers: str, topic: str, group_id: str | None = None,
                         starting_offsets: str = "latest", **extra) -> dict:
    """String values, from the latest offset.  ``extra`` are options of Spark's
    reader (``failOnDataLoss``, ``maxOffsetsPerTrigger``, ...) and go through
    unchanged; consumer properties are given with their ``kafka.`` prefix."""
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def kafka_sink_options(bootstrap_servers: str, topic: str, checkpoint_location: str | None = None
                       ) -> dict:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    if checkpoint_location:
        opts["checkpointLocation"] = checkpoint_location
    return opts


def kafka_values(raw: DataFrame) -> DataFrame:
    """Kafka rows -> ``value string`` (CAST(value AS STRING))."""
    return raw.select(F.col("value").cast("string").alias("value"))


def read_kafka_records(spark: SparkSession, kind: str, bootstrap_servers: str, topic: str,
                       group_id: str | None = None, starting_offsets: str = "latest",
                       mode: str = "FAILFAST", **options) -> DataFrame:
    """Streaming Kafka topic of delimited lines -> typed records."""
    raw = (spark.readStream.format("kafka")
           .options(**kafka_source_options(bootstrap_servers, topic, group_id,
                                           starting_offsets, **options)).load())
    return parse_lines(kafka_values(raw), kind, mode=mode)


def to_kafka_value(df: DataFrame, columns: list, sep: str = ",") -> DataFrame:
    return format_lines(df, columns, sep=sep, value_col="value")


def write_kafka_stream(df: DataFrame, bootstrap_servers: str, topic: str,
                       checkpoint_location: str):
    return (df.writeStream.format("kafka")
            .options(**kafka_sink_options(bootstrap_servers, topic, checkpoint_location))
            .start())


def write_kafka_batch(df: DataFrame, bootstrap_servers: str, topic: str) -> None:
    df.write.format("kafka").options(**kafka_sink_options(bootstrap_servers, topic)).save()
