"""Stateful stream rules over several micro-batches: nothing is lost between
them, NULL keys count, and keys that are done leave no state."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import scratch_path
from eventide.streaming.processors import DeadlineDecision, FollowedBy, StrictPairs
from eventide.streaming.runner import SENTINEL_TS, before_flush, event_time, prepare_streaming

T0 = datetime(2024, 1, 1, 10, 0, 0)
ROW = "k long, ts timestamp, seq long, a boolean, b boolean"
OUT = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("start_ts", T.TimestampType()),
                    T.StructField("match_ts", T.TimestampType()), T.StructField("result_msg", T.StringType()),
                    T.StructField("tag", T.StringType())])
MINUTE = 60_000_000


def at(seconds):
    return T0 + timedelta(microseconds=round(seconds * 1e6))


def run(spark, tmp, batches, processor, schema, flush=True):
    """One micro-batch per list of rows; returns results and the checkpoint."""
    prepare_streaming(spark)
    folder, ckpt, out = (scratch_path(spark, n) for n in ("st-in", "st-ckpt", "st-out"))
    for rows in [*batches, *([[(None, SENTINEL_TS, None, None, None)]] if flush else [])]:
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(folder)
    src = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", "1").parquet(folder)
    rows = event_time(src, "ts", "0 seconds")
    if isinstance(processor, DeadlineDecision):
        rows = rows.select("k", "ts", F.col("a").alias("is_create"), F.col("b").alias("is_pay"))
    q = (rows.groupBy("k").transformWithState(processor, schema, "Append", "EventTime").writeStream
         .option("checkpointLocation", ckpt).trigger(availableNow=True)
         .foreachBatch(lambda b, e: b.write.mode("overwrite").parquet(f"{out}/epoch={e}")).start())
    q.awaitTermination(120)
    assert q.exception() is None
    got = spark.read.schema(schema).parquet(out)
    return before_flush(got, schema.fieldNames()[1]).collect(), ckpt


def state_rows(spark, ckpt, var):
    return spark.read.format("statestore").option("path", ckpt).option("stateVarName", var).load().count()


def test_a_row_between_two_milliseconds_gets_its_timeout(spark, tmp_path):
    """The newest row of its batch, 700 us after a whole millisecond: the
    watermark stops at that millisecond, below the row."""
    batches = [[(1, at(10.9007), 1, True, False)], [(2, at(1300), 2, False, False)],
               [(3, at(2600), 3, False, False)]]
    got, _ = run(spark, tmp_path, batches, FollowedBy(15 * MINUTE, "m", "t"), OUT, flush=False)
    assert [(r.order_id, r.start_ts, r.tag) for r in got] == [(1, at(10.9007), "timeout")]


def test_null_keys_and_state_carried_over_batches(spark, tmp_path):
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("first_ts", T.TimestampType()),
                           T.StructField("last_ts", T.TimestampType()), T.StructField("msg", T.StringType())])
    batches = [[(None, at(0), 1, True, True), (7, at(0.5), 2, True, True)],
               [(None, at(1.0000001), 3, True, True), (7, at(9), 4, True, True)],
               [(7, at(10.2), 5, True, True), (8, at(10.3), 6, True, True)],
               [(8, at(500), 7, True, True)]]
    got, ckpt = run(spark, tmp_path, batches, StrictPairs(2_000_000, "x"), schema)
    assert sorted((str(r.user_id), r.first_ts) for r in got) == [("7", at(9)), ("None", at(0))]
    assert state_rows(spark, ckpt, "st") == 0


@pytest.mark.parametrize("keep", [0, 30 * MINUTE])
def test_decided_orders_leave_no_state(spark, tmp_path, keep):
    schema = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("create_ts", T.TimestampType()),
                           T.StructField("pay_ts", T.TimestampType()), T.StructField("result_msg", T.StringType())])
    batches = [[(1, at(0), 1, True, False), (2, at(1), 2, True, False), (4, at(2), 9, False, True)],
               [(1, at(60), 3, False, True)], [(3, at(1000), 4, True, False)],
               [(2, at(1100), 5, False, True)],                     # late pay of a decided order
               [(5, at(9000), 6, False, False)]]
    got, ckpt = run(spark, tmp_path, batches, DeadlineDecision(15 * MINUTE, "payed", "timeout", keep), schema)
    if keep:
        assert sorted((r.order_id, r.result_msg) for r in got) == [(1, "payed"), (2, "timeout"), (3, "timeout")]
    assert state_rows(spark, ckpt, "first") == 0
