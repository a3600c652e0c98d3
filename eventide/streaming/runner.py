"""Running streaming queries to a durable table (SNK-2, SNK-3, STR-14).

Sinks write one folder per micro-batch epoch with overwrite, so a batch that
is replayed after a failure replaces its own output (idempotent), and all
checkpoints and outputs live under the shared checkpoint folder.

End of input (STR-14): a bounded source never moves the watermark past its
last windows and timers.  ``replay_stream`` puts one far-future row behind the
last rows of a table, so the next (no-data) micro-batch closes everything.  The
sentinel is known by its time alone (``before_flush``): rows with NULL keys are
ordinary rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import STATE_STORE_PROVIDER, checkpoint_root, scratch_path, use_runtime_conf

SENTINEL_TS = datetime(2999, 1, 1)


def prepare_streaming(spark: SparkSession) -> SparkSession:
    use_runtime_conf(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_STORE_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE_PROVIDER)
    checkpoint_root(spark)
    return spark


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Stream the rows of ``{sf_dir}/{name}.parquet`` (a one-character glob,
    because a file stream source needs a folder or a pattern)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    pattern = f"{sf_dir.rstrip('/')}/{name[:-1]}[{name[-1]}].parquet"
    return spark.readStream.schema(schema).parquet(pattern)


def time_bounds(df: DataFrame, ts: str, slices: int) -> list:
    """Times that cut ``df`` into ``slices`` parts of about equal size."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    share = [k / slices for k in range(1, slices)]
    got = df.agg(F.percentile_approx(at, share)).first()[0] or []
    return sorted(set(got))


def replay_stream(df: DataFrame, ts: str, slices: int = 4, file_rows: int = 2_000_000,
                  bounds: list | None = None, arrival: Column | None = None) -> DataFrame:
    """Stream a table in event-time order over several micro-batches.

    The table is written slice by slice (rows without a time come first), each
    slice in files of about ``file_rows`` rows, and read back one slice per
    trigger, so state and timers are carried from batch to batch as on a live
    stream.  A slice that has fewer files than the others gets empty ones, so it
    does not share its trigger with a part of the next one.  The last file is
    the flush sentinel: all columns NULL, ``ts`` far in the future.  Streams
    that are united need the same ``bounds``.  With ``arrival`` (a time), rows come
    in that order instead, so rows whose ``ts`` is well before it come late."""
    spark = df.sparkSession
    folder = scratch_path(spark, "replay")
    files = max(1, -(-df.count() // (slices * file_rows)))
    plain = df
    if arrival is not None:
        df = df.withColumn("__arrival", arrival)
    order = "__arrival" if arrival is not None else ts
    if bounds is None:
        bounds = time_bounds(df, order, slices)
    at = F.unix_micros(F.col(order).cast("timestamp"))
    edges = [None, *bounds, None]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in plain.schema.fields])
    for k, (lo, hi) in enumerate(zip(edges, edges[1:]), 1):
        part = df
        if lo is not None:
            part = part.filter(at >= lo)
        if hi is not None:
            part = part.filter((at < hi) | at.isNull()) if lo is None else part.filter(at < hi)
        part = part.select(*plain.columns)
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.mode("append").parquet(folder)
        if files > 1:
            for _ in range(k * files - len(spark.read.schema(nullable).parquet(folder).inputFiles())):
                spark.createDataFrame([], nullable).coalesce(1).write.mode("append").parquet(folder)
    row = [SENTINEL_TS if f.name == ts else None for f in plain.schema.fields]
    spark.createDataFrame([row], nullable).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(nullable).option("maxFilesPerTrigger", str(files)).parquet(folder)


def replay_parts(df: DataFrame, parts: int = 4, file_bytes: int = 64 << 20) -> DataFrame:
    """Stream a table that has no time in ``parts`` micro-batches, each of as many
    files of about ``file_bytes`` (texts as they are, 8 for other values) as it needs."""
    spark = df.sparkSession
    folder = scratch_path(spark, "replay")
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields
             if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = sum(texts, F.lit(8 * (len(df.columns) - len(texts))).cast("long"))
    files = max(1, -(-(df.agg(F.sum(size)).first()[0] or 0) // (parts * file_bytes)))
    df.repartition(parts * files).write.mode("overwrite").parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", str(files)).parquet(folder)


def before_flush(batch: DataFrame, *ts_cols: str) -> DataFrame:
    """Results without those of the flush sentinel."""
    at = F.coalesce(*[F.col(c).cast("timestamp") for c in ts_cols])
    return batch.filter(at.isNull() | (at < F.lit(SENTINEL_TS).cast("timestamp")))


def live(cond, ts: str = "ts"):
    """A stream filter that keeps the flush sentinel.  Referencing the
    event-time column also keeps Catalyst from pushing the filter below the
    watermark node, so filtered-out rows still move the watermark."""
    return cond | (F.col(ts) >= F.lit(SENTINEL_TS).cast("timestamp"))


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Cast an NTZ time column to ``timestamp`` (watermarks need it) and set
    the watermark (STR-1 with delay 0, STR-2 with a bound)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def run_to_table(stream: DataFrame, name: str, output_mode: str = "append",
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 timeout_s: float | None = None) -> str:
    """Run ``stream`` until its available input is consumed (availableNow)
    and return the folder of its results.  ``transform`` is applied to each
    micro-batch (a batch DataFrame, so any batch operator works there)."""
    return _run(stream, name, lambda batch, epoch: transform(batch) if transform else batch, output_mode, timeout_s)


def run_epochs(stream: DataFrame, name: str, epoch_rows: Callable[[DataFrame, int], DataFrame],
               output_mode: str = "append", timeout_s: float | None = None) -> str:
    """``run_to_table`` for sinks with state of their own: ``epoch_rows`` gets
    the micro-batch, cached because it is read more than once, and its epoch."""
    return _run(stream, name, epoch_rows, output_mode, timeout_s, cache=True)


def _run(stream: DataFrame, name: str, epoch_rows: Callable[[DataFrame, int], DataFrame], output_mode: str,
         timeout_s: float | None, cache: bool = False) -> str:
    out = scratch_path(stream.sparkSession, f"{name}-out")

    def write_batch(batch: DataFrame, epoch: int) -> None:
        if cache:
            batch = batch.persist()
        epoch_rows(batch, epoch).write.mode("overwrite").parquet(f"{out}/epoch={epoch:09d}")
        if cache:
            batch.unpersist()

    run_batches(stream, name, write_batch, output_mode, timeout_s)
    return out


def run_batches(stream: DataFrame, name: str, write_batch: Callable[[DataFrame, int], None],
                output_mode: str = "append", timeout_s: float | None = None) -> None:
    """Give every micro-batch and its epoch to ``write_batch`` until the available
    input is consumed."""
    ckpt = scratch_path(stream.sparkSession, f"{name}-ckpt")
    q = (stream.writeStream.outputMode(output_mode).foreachBatch(write_batch)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish")
    if q.exception():
        raise q.exception()


def read_results(spark: SparkSession, folder: str, schema: T.StructType, keep: str = "all"
                 ) -> DataFrame:
    """Read what ``run_to_table`` wrote; ``epoch=`` folders are discovered
    as a partition column.  Empty frame when nothing was written."""
    try:
        df = spark.read.parquet(folder)
    except Exception as e:  # noqa: BLE001  (no output folder: nothing emitted)
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], schema)
        raise
    if keep == "last":
        last = df.agg(F.max("epoch")).first()[0]
        df = df.filter(F.col("epoch") == last)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def run_and_read(stream: DataFrame, name: str, schema: T.StructType | None = None,
                 output_mode: str = "append",
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 keep: str = "all") -> DataFrame:
    """``keep="last"`` keeps only the latest epoch (complete-mode snapshots)."""
    spark = stream.sparkSession
    folder = run_to_table(stream, name, output_mode, transform)
    if schema is None:
        probe = stream.sparkSession.createDataFrame([], stream.schema)
        schema = (transform(probe) if transform else probe).schema
    return read_results(spark, folder, schema, keep)
