"""Streams fed in several micro-batches: order independence, lateness,
refinements (SURVEY §5 (d))."""

import os
import time

from pyspark.sql import functions as F

from eventide.operators.sequence import MSG_STRICT
from eventide.sources import read_delimited_stream
from eventide.streaming.processors import StrictPairs
from eventide.streaming.runner import event_time, prepare_streaming, run_and_read
from eventide.streaming.upsert import latest, write_update_log
from tests.fixtures import LOGIN_KEY_LINES, epoch
from pyspark.sql import types as T


def _files(folder, chunks):
    folder.mkdir()
    for i, lines in enumerate(chunks):
        p = folder / f"part-{i:03d}.csv"
        p.write_text("\n".join(lines))
        os.utime(p, (time.time() + i, time.time() + i))   # processing order = file order
    return str(folder)


def test_event_time_pairs_independent_of_batching(spark, tmp_path):
    """The login boundary rows: the 843 failure arrives one micro-batch after
    the 844 success; event-time order still pairs 842 with 843."""
    prepare_streaming(spark)
    path = _files(tmp_path / "login", [LOGIN_KEY_LINES[:2], LOGIN_KEY_LINES[2:],
                                       ["0,0.0.0.0,none,32503680000"]])   # flush sentinel
    stream = read_delimited_stream(spark, path, "login", max_files_per_trigger=1)
    rows = event_time(stream, "ts", "5 seconds").select(
        "user_id", "ts", F.lit(0).cast("long").alias("seq"),
        (F.col("event_type") == "fail").alias("a"), (F.col("event_type") == "fail").alias("b"))
    schema = T.StructType([T.StructField("user_id", T.LongType()),
                           T.StructField("first_ts", T.TimestampType()),
                           T.StructField("last_ts", T.TimestampType()),
                           T.StructField("msg", T.StringType())])
    out = rows.groupBy("user_id").transformWithState(
        StrictPairs(2_000_000, MSG_STRICT), schema, "Append", "EventTime")
    got = run_and_read(out, "login_batches", schema=schema).collect()
    assert [(r.user_id, r.first_ts, r.last_ts, r.msg) for r in got] == \
        [(1035, epoch(1558430842), epoch(1558430843), MSG_STRICT)]


def test_update_mode_refines_a_window_with_a_late_row(spark, tmp_path):
    prepare_streaming(spark)
    path = _files(tmp_path / "clicks", [
        ["1,7,bj,bj,100", "2,7,bj,bj,101", "3,7,bj,bj,130"],
        ["4,7,bj,bj,102"],                                    # late, within 60 s lateness
        ["5,7,bj,bj,300"],                                    # watermark -> 235
        ["6,7,bj,bj,301"],   # late rows are judged by the previous batch's watermark
        ["7,7,bj,bj,103"],                                    # too late: dropped (STR-12)
    ])
    stream = read_delimited_stream(spark, path, "ad_click", max_files_per_trigger=1)
    counts = (event_time(stream, "ts", "65 seconds")
              .groupBy(F.window("ts", "10 seconds").alias("w"), "province").count()
              .select(F.col("w.end").alias("window_end"), "province", "count"))
    folder = write_update_log(counts, "refine")
    log = spark.read.parquet(folder)
    assert log.select("epoch").distinct().count() >= 3
    final = {(r.window_end, r.province): r["count"]
             for r in latest(log, ["window_end", "province"]).collect()}
    assert final == {(epoch(110), "bj"): 3, (epoch(140), "bj"): 1, (epoch(310), "bj"): 2}
