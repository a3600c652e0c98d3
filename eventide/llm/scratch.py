"""Tables written to the shared folder to cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventide.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the folder of ``spark.checkpoint.dir`` and
    read it back: later steps start from files that every executor can see, so
    a lost executor costs only its own tasks."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
