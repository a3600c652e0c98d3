"""Console and table sinks (SNK-2, SNK-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """The reference's ``print("prefix")``: a leading label column."""
    return df.select(F.lit(prefix).alias("stream"), "*")


def show_prefixed(df: DataFrame, prefix: str | None = None, n: int = 20,
                  truncate: bool = False) -> None:
    """Batch console print of the first ``n`` rows (display only)."""
    (with_prefix(df, prefix) if prefix else df).show(n, truncate=truncate)


def console_stream(df: DataFrame, prefix: str | None = None, output_mode: str = "append",
                   checkpoint: str | None = None, trigger: dict | None = None):
    w = ((with_prefix(df, prefix) if prefix else df).writeStream.format("console")
         .option("truncate", "false").outputMode(output_mode))
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
