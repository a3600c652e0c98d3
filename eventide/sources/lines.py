"""Line streams (SRC-7): one string per line in column ``value``.

A TCP socket source (``host``/``port``) is for demos only (not fault
tolerant); a watched folder of text files is the durable equivalent and what
the tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_line_stream(spark: SparkSession, path: str | None = None, host: str | None = None,
                     port: int | None = None) -> DataFrame:
    if path is not None:
        return spark.readStream.text(path)
    if host is None or port is None:
        raise ValueError("give a folder path, or host and port")
    return (spark.readStream.format("socket").option("host", host)
            .option("port", str(port)).load())


def lines_as(df: DataFrame, name: str, value_col: str = "value") -> DataFrame:
    """Name the single text column (the reference names it ``word``)."""
    return df.withColumnRenamed(value_col, name)
