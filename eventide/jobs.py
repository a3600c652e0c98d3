"""Command-line jobs with the reference's parameters and input formats.

    python -m eventide.jobs <job> --input PATH [--input2 PATH] --output PATH [--stream]

Each job reads the positional text files of its domain, runs the operator
with the windows / limits the reference uses, and writes Parquet (batch) or
a streaming Parquet sink (``--stream``).  A stream's checkpoint is fixed for its
output (``--checkpoint``, or ``_checkpoint`` inside the output folder), so a job
that is started again goes on where it stopped.  Output columns carry a ``tag`` where the reference has
side outputs.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide import operators as ops
from eventide.functions.report import uv_line
from eventide.operators import sequence as seq_ops
from eventide.session import use_runtime_conf
from eventide.streaming.runner import prepare_streaming
from eventide.sources import read_access_log, read_access_log_stream, read_delimited
from eventide.sources.delimited import read_delimited_stream


@dataclass
class Job:
    kind: str                                   # input layout
    run: Callable[..., DataFrame]               # (df[, df2]) -> result
    stream_ok: bool = False                     # has a streaming form here
    kind2: str | None = None                    # second input (reconciliation)


def _pv(df):
    return df.filter(F.col("behavior") == "pv")


JOBS: dict[str, Job] = {
    # hot items: pv, 1 h / 5 min, top 3 per window end
    "hot_items": Job("user_behavior", lambda d: ops.hot_items(d, size="1 hour", slide="5 minutes",
                                                              n=3)),
    "hot_items_report": Job("user_behavior", lambda d: ops.ranked_report(
        ops.hot_items(d, size="1 hour", slide="5 minutes", n=3), "item_id", "item_count", 3)),
    # URL ranking over the access log: 10 s / 5 s, 65 s watermark in streams
    "url_ranking": Job("access_log", lambda d: ops.url_ranking(d, size="10 seconds",
                                                               slide="5 seconds", n=5)),
    "page_views": Job("user_behavior", lambda d: ops.page_views(d, size="10 seconds"),
                      stream_ok=True),
    "unique_visitors": Job("user_behavior", lambda d: ops.uv_exact(_pv(d), size="10 seconds")),
    "uv_bloom": Job("user_behavior", lambda d: ops.uv_bloom(_pv(d), size="2 minutes").withColumn(
        "line", uv_line(F.col("window_end"), F.col("uv_estimate")))),
    "uv_bitmap": Job("user_behavior", lambda d: ops.uv_bitmap(_pv(d), size="2 minutes")),
    "app_marketing": Job("marketing", lambda d: ops.marketing_total(d, "ts", "10 seconds",
                                                                    "5 seconds"), stream_ok=True),
    "app_marketing_by_channel": Job("marketing", lambda d: ops.marketing_by_channel(
        d, "ts", "10 seconds", "5 seconds"), stream_ok=True),
    # ad clicks: gate at 100 per user/ad/day, then 10 s / 5 s per province
    "ad_gate": Job("ad_click", lambda d: ops.click_gate(d, max_count=100, seq="__seq")),
    "ad_by_province": Job("ad_click", lambda d: ops.count_by_key_per_window(
        ops.gate_passed(ops.click_gate(d, max_count=100, seq="__seq")), "ts", "10 seconds",
        "5 seconds", "province")),
    # login failures: fail next fail within 2 s (event time), and arrival-order rule
    "login_fail_cep": Job("login", lambda d: ops.strict_next(
        d, ["user_id"], "ts", F.col("event_type") == "fail", F.col("event_type") == "fail",
        "2 seconds", seq="__seq", msg=seq_ops.MSG_STRICT)),
    "login_fail": Job("login", lambda d: ops.strict_next(
        d, ["user_id"], "ts", F.col("event_type") == "fail", F.col("event_type") == "fail",
        "2 seconds", order=["__seq"], msg=seq_ops.MSG_ARRIVAL)),
    "login_fail_burst": Job("login", lambda d: ops.burst_warnings(
        d, ["user_id"], "ts", F.col("event_type") == "fail", "2 seconds", min_count=2)),
    # orders: create followedBy pay within 15 min; state-machine outcomes
    "order_timeout_cep": Job("order", lambda d: ops.followed_by(
        d, ["order_id"], "ts", F.col("event_type") == "create", F.col("event_type") == "pay",
        "15 minutes")),
    "order_timeout": Job("order", lambda d: ops.order_outcomes(d, within="15 minutes")),
    "order_deadline": Job("order", lambda d: ops.decide_at_deadline(d, within="15 minutes")),
    # pay / receipt reconciliation within 5 s
    "tx_match": Job("order", lambda pays, rcps: ops.reconcile(
        ops.with_tx(pays).select("tx_id", "order_id", "event_type", F.col("ts").alias("pay_ts")),
        rcps.withColumnRenamed("ts", "receipt_ts"), "5 seconds"), kind2="receipt"),
    # SQL over a view: running word count, select *
    "word_count": Job("lines", lambda d: ops.running_count(d.withColumnRenamed("value", "word"),
                                                           "word"), stream_ok=True),
    "select_all": Job("user_behavior", lambda d: d),
}


# Streaming top-N jobs: (filter, key, size, slide, n, count column, rank column).
STREAM_TOPN = {
    "hot_items": (lambda: F.col("behavior") == "pv", "item_id", "1 hour", "5 minutes", 3,
                  "item_count", "row_num"),
    "url_ranking": (None, "url", "10 seconds", "5 seconds", 5, "views", "rank"),
}


def _stream_top_n(name: str, df: DataFrame, output_path: str, checkpoint: str):
    """Counts close with their window (append), so each micro-batch holds
    whole windows and is ranked with the batch top-N; one folder per epoch."""
    cond, key, size, slide, n, count_col, rank_col = STREAM_TOPN[name]
    if cond is not None:
        df = df.filter(cond())
    counts = ops.windowed_count(df, "ts", size, slide, keys=[key], count_col=count_col)

    def rank(batch: DataFrame, epoch: int) -> None:
        top = ops.top_n_per_window(batch, n, key_cols=[key], count_col=count_col,
                                   rank_col=rank_col)
        top.write.mode("overwrite").parquet(f"{output_path}/epoch={epoch:09d}")

    return (counts.writeStream.outputMode("append").foreachBatch(rank)
            .option("checkpointLocation", checkpoint).start())


def _read(spark: SparkSession, kind: str, path: str, stream: bool) -> DataFrame:
    if kind == "access_log":
        return read_access_log_stream(spark, path) if stream else read_access_log(spark, path)
    if kind == "lines":
        return spark.readStream.text(path) if stream else spark.read.text(path)
    df = read_delimited_stream(spark, path, kind) if stream else read_delimited(spark, path, kind)
    return df if stream else _with_arrival(df)


def _with_arrival(df: DataFrame) -> DataFrame:
    """``__seq``: arrival order.  Files arrive in the order of their
    modification time, then name; lines in that of their place in the file.
    Only the blocks that Spark reads are ranked (one row each); inside a block
    rows are numbered as they are read.  How blocks are packed into tasks has
    no part in it."""
    d = df.select("*", F.col("_metadata.file_modification_time").alias("__time"),
                  F.col("_metadata.file_path").alias("__file"),
                  F.col("_metadata.file_block_start").alias("__start"))
    blocks = d.select("__time", "__file", "__start").distinct().withColumn(
        "__rank", F.row_number().over(Window.orderBy("__time", "__file", "__start")))
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (d.withColumn("__row", in_task).join(blocks.drop("__time"), ["__file", "__start"])
            .withColumn("__seq", F.shiftleft(F.col("__rank").cast("long"), 33) + F.col("__row"))
            .drop("__time", "__file", "__start", "__rank", "__row"))


def run_job(spark: SparkSession, name: str, input_path: str, output_path: str | None = None,
            input2: str | None = None, stream: bool = False, watermark: str = "5 seconds",
            checkpoint: str | None = None):
    """Run one job; returns the result DataFrame (batch) or the started
    StreamingQuery (``stream=True``, which needs an output path).

    The word count is an append-only log of refinements in ``epoch=`` folders;
    ``eventide.streaming.upsert.latest`` gives the counts as of any time."""
    use_runtime_conf(spark)
    job = JOBS[name]
    if stream:
        if output_path is None:
            raise ValueError("a stream needs an output path")
        prepare_streaming(spark)
        checkpoint = checkpoint or f"{output_path.rstrip('/')}/_checkpoint"
    if stream and name in STREAM_TOPN:
        df = _read(spark, job.kind, input_path, stream=True)
        delay = "65 seconds" if name == "url_ranking" else watermark
        return _stream_top_n(name, df.withWatermark("ts", delay), output_path, checkpoint)
    if stream and not job.stream_ok:
        raise ValueError(f"{name} has no streaming form in the job runner; "
                         "see eventide.streaming for the stateful processors")
    df = _read(spark, job.kind, input_path, stream)
    if stream and "ts" in df.columns:
        df = df.withWatermark("ts", watermark)
    if job.kind2:
        out = job.run(df, _read(spark, job.kind2, input2, stream))
    else:
        out = job.run(df)
    if "__seq" in out.columns:
        out = out.drop("__seq")
    if stream:
        if name == "word_count":
            return (out.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
                    .foreachBatch(lambda b, e: b.write.mode("overwrite").parquet(f"{output_path}/epoch={e:09d}"))
                    .start())
        return (out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
                .format("parquet").option("path", output_path).start())
    if output_path:
        out.write.mode("overwrite").parquet(output_path)
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m eventide.jobs")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--input", required=True)
    ap.add_argument("--input2", help="second input (receipts for tx_match)")
    ap.add_argument("--output", required=True)
    ap.add_argument("--stream", action="store_true")
    ap.add_argument("--watermark", default="5 seconds")
    ap.add_argument("--checkpoint", help="of the stream; default: _checkpoint in the output folder")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"eventide-{a.job}").getOrCreate()
    res = run_job(spark, a.job, a.input, a.output, a.input2, a.stream, a.watermark, a.checkpoint)
    if a.stream:
        res.awaitTermination()


if __name__ == "__main__":
    main()
