"""Batch operators on a stream with carried rows: equal to the batch queries over
several micro-batches, also for rows without a time, without state calls per key."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventide.operators.sequence import MSG_STRICT
from eventide.plans import catalog as C
from eventide.session import scratch_path
from eventide.streaming import twins
from eventide.streaming.carried import run_carried, strict_next_step
from eventide.streaming.runner import SENTINEL_TS, prepare_streaming, replay_parts, replay_stream

T0 = datetime(2024, 1, 1)
KINDS = ["error", "error", "signup", "purchase", "view", "click"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("carried"))
    at = lambda i: None if i % 37 == 0 else T0 + timedelta(minutes=97 * (i * 7919 % 200), microseconds=i)
    day = lambda i: None if i % 23 == 0 else T0 + timedelta(days=i * 61 % 1500)
    events = [(i, at(i), None if i % 41 == 0 else i % 3, KINDS[i * 5 // 7 % 6]) for i in range(400)]
    orders = [(i // 2 if i % 9 == 0 else i, i % 5, day(i)) for i in range(120)]
    lines = [(i * 13 % 130, i % 6, i % 7, day(i + 3)) for i in range(300)]
    for name, rows, schema in (
            ("events", events, "event_id long, ts timestamp_ntz, user_id long, event_type string"),
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
            ("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int, l_shipdate timestamp_ntz")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("twin,batch", [
    (twins.s_ad_by_geo, C.q_ad_by_geo), (twins.s_ad_gate_daily, C.q_ad_gate_daily),
    (twins.s_order_outcomes, C.q_order_outcomes), (twins.s_order_deadline, C.q_order_deadline),
    (twins.s_tx_reconcile_once, C.q_tx_reconcile_once), (twins.s_login_fail_strict, C.q_login_fail_strict),
    (twins.s_order_timeout, C.q_order_timeout_cep), (twins.s_tx_reconcile, lambda spark, sf: C.q_tx_reconcile(
        spark, sf).filter("coalesce(pay_ts, receipt_ts) IS NOT NULL"))])
def test_stream_equals_batch_with_rows_without_time(spark, tables, monkeypatch, twin, batch):
    def state_calls(*_, **__):
        raise AssertionError("a state call per key")

    monkeypatch.setattr("pyspark.sql.GroupedData.transformWithState", state_calls)
    # fails before this change: by the state calls, and by rows without a time
    got, want = twin(spark, tables), batch(spark, tables)
    rows = [sorted(map(str, df.select(*sorted(df.columns)).collect())) for df in (got, want)]
    assert rows[0] == rows[1] and rows[0]


def test_burst_chunks_cross_micro_batches(spark, tables):
    timed = scratch_path(spark, "timed")
    spark.read.parquet(f"{tables}/events.parquet").filter("ts IS NOT NULL").coalesce(1).write.parquet(f"{timed}/events.parquet")
    got, want = twins.s_login_fail_burst(spark, timed), C.q_login_fail_burst(spark, timed)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []


def test_waiting_and_late_rows(spark):
    """The watermark is 5 s behind: the row of second 3 comes in time, that of second 1 too late."""
    prepare_streaming(spark)
    folder = scratch_path(spark, "late")
    schema = "k long, ts timestamp_ntz, seq long, fail boolean"
    sec = lambda s: T0 + timedelta(seconds=s)
    for rows in ([(1, sec(2), 0, True), (1, sec(7), 1, True)], [(1, sec(3), 2, False)], [(1, sec(20), 3, True)],
                 [(1, sec(1), 4, True)], [(None, SENTINEL_TS, None, None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(folder)
    out = run_carried(stream, "late", [strict_next_step(["k"], "ts", "seq", "fail", "fail", "1 minute", MSG_STRICT)],
                      delay="5 seconds")
    assert [(r.first_ts, r.last_ts) for r in out.select("first_ts", "last_ts").collect()] == [(sec(7), sec(20))]


def _epochs(stream):
    seen = []
    q = (stream.writeStream.foreachBatch(lambda b, e: seen.append((b.count(), b.select(F.input_file_name()).distinct().count())))
         .option("checkpointLocation", scratch_path(stream.sparkSession, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    return seen


def test_parts_are_files_of_bounded_size(spark):
    prepare_streaming(spark)
    df = spark.range(4000).select(F.repeat(F.lit("x"), 100).alias("text"))
    seen = _epochs(replay_parts(df, 4, file_bytes=20_000))
    assert len(seen) == 4 and sum(n for n, _ in seen) == 4000 and [k for _, k in seen] == [5] * 4


def test_slices_do_not_share_a_trigger(spark):
    """The second slice has one row and the others many: it still has a trigger of its own."""
    prepare_streaming(spark)
    df = spark.range(300).select("id", F.timestamp_micros(F.col("id") * 1_000_000).alias("ts"))
    seen = _epochs(replay_stream(df, "ts", file_rows=20, bounds=[100_000_000, 101_000_000, 200_000_000]))
    assert [n for n, _ in seen] == [100, 1, 99, 100, 1]
