from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eventide.operators import burst_warnings, followed_by, strict_next
from eventide.operators.sequence import MSG_ARRIVAL, MSG_STRICT
from eventide.sources import parse_lines
from tests.fixtures import LOGIN_KEY_LINES, ORDER_KEY_LINES, at, epoch


def _logins(spark, lines):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "seq long, value string")
    parsed = parse_lines(df, "login")
    return parsed.join(df.select("seq", F.col("value").alias("v")),
                       F.concat_ws(",", "user_id", "ip", "event_type",
                                   F.unix_seconds("ts").cast("string")) == F.col("v")).drop("v")


def test_event_time_order_finds_the_pair_arrival_order_does_not(spark):
    df = _logins(spark, LOGIN_KEY_LINES)
    fail = F.col("event_type") == "fail"
    strict = strict_next(df, ["user_id"], "ts", fail, fail, "2 seconds", seq="seq").collect()
    assert [(r.user_id, r.first_ts, r.last_ts, r.msg) for r in strict] == \
        [(1035, epoch(1558430842), epoch(1558430843), MSG_STRICT)]
    arrival = strict_next(df, ["user_id"], "ts", fail, fail, "2 seconds", order=["seq"],
                          msg=MSG_ARRIVAL).collect()
    assert arrival == []


def test_strict_gap_bounds_and_overlaps(spark):
    rows = [(0, 1, "fail", at(0)), (1, 1, "fail", at(1)), (2, 1, "fail", at(2.5)),
            (3, 1, "fail", at(4.5)), (4, 2, "fail", at(0)), (5, 2, "fail", at(2))]
    df = spark.createDataFrame(rows, "seq long, user_id long, event_type string, ts timestamp")
    fail = F.col("event_type") == "fail"
    got = sorted((r.user_id, r.first_ts, r.last_ts) for r in
                 strict_next(df, ["user_id"], "ts", fail, fail, "2 seconds", seq="seq").collect())
    # f f f -> overlapping pairs; exactly 2 s apart is out
    assert got == [(1, at(0), at(1)), (1, at(1), at(2.5))]


def test_arrival_order_warns_on_negative_gaps(spark):
    rows = [(0, 1, "fail", at(5)), (1, 1, "fail", at(1))]
    df = spark.createDataFrame(rows, "seq long, user_id long, event_type string, ts timestamp")
    fail = F.col("event_type") == "fail"
    got = strict_next(df, ["user_id"], "ts", fail, fail, "2 seconds", order=["seq"]).collect()
    assert [(r.first_ts, r.last_ts) for r in got] == [(at(5), at(1))]


def test_followed_by_on_order_boundary_rows(spark):
    df = parse_lines(spark.createDataFrame([(l,) for l in ORDER_KEY_LINES], "value string"), "order")
    out = followed_by(df, ["order_id"], "ts", F.col("event_type") == "create",
                      F.col("event_type") == "pay", "15 minutes")
    got = {r.order_id: r.result_msg for r in out.collect()}
    assert got == {34730: "timeout", 34747: "payed successfully", 34756: "timeout",
                   34767: "timeout"}          # 34768 (pay without create) gives nothing


def test_followed_by_skips_events_between_and_each_start_matches(spark):
    rows = [(7, "create", at(0)), (7, "view", at(1)), (7, "create", at(2)), (7, "pay", at(3)),
            (7, "pay", at(4))]
    df = spark.createDataFrame(rows, "order_id long, event_type string, ts timestamp")
    out = followed_by(df, ["order_id"], "ts", F.col("event_type") == "create",
                      F.col("event_type") == "pay", "3 seconds").orderBy("start_ts").collect()
    assert [(r.start_ts, r.match_ts, r.tag) for r in out] == \
        [(at(0), None, "timeout"), (at(2), at(3), "matched")]


def _burst_brute(rows, within_s, min_count):
    """Event-by-event simulation of the burst rule."""
    out = []
    by_user = {}
    for r in sorted(rows, key=lambda r: (r[0], r[2])):
        by_user.setdefault(r[0], []).append(r)
    for u, evs in by_user.items():
        start, fails = None, []
        for _, kind, t in evs:
            if start is not None and t > start + timedelta(seconds=within_s):
                if len(fails) >= min_count:
                    out.append((u, fails[0], fails[-1], len(fails)))
                start, fails = None, []
            if kind == "fail":
                if start is None:
                    start = t
                fails.append(t)
            else:
                start, fails = None, []
        if start is not None and len(fails) >= min_count:
            out.append((u, fails[0], fails[-1], len(fails)))
    return sorted(out)


def test_burst_matches_brute_force(spark):
    import random
    rnd = random.Random(11)
    rows, t = [], datetime(2024, 1, 1)
    for i in range(300):
        t += timedelta(seconds=rnd.choice([0.5, 1, 1.5, 2, 3]))
        rows.append((rnd.choice([1, 1, 1, 2, 3]), "fail" if rnd.random() < 0.75 else "success", t))
    df = spark.createDataFrame(rows, "user_id long, event_type string, ts timestamp")
    got = sorted((r.user_id, r.first_ts, r.last_ts, int(r.msg.split(" for ")[1].split()[0]))
                 for r in burst_warnings(df, ["user_id"], "ts", F.col("event_type") == "fail",
                                         "2 seconds", min_count=2, bucket="10 seconds").collect())
    assert got == _burst_brute(rows, 2, 2)
    assert len(got) > 5


def test_match_sequence_dispatch(spark):
    from eventide.operators import match_sequence
    df = _logins(spark, LOGIN_KEY_LINES)
    fail = F.col("event_type") == "fail"
    strict = match_sequence(df, ["user_id"], "ts", [("begin", fail), ("next", fail)],
                            "2 seconds", contiguity="strict", seq="seq")
    assert strict.count() == 1
    ok = F.col("event_type") == "success"
    relaxed = match_sequence(df, ["user_id"], "ts", [("begin", fail), ("follow", ok)],
                             "2 seconds", contiguity="relaxed")
    got = {r.start_ts: r.tag for r in relaxed.collect()}
    # 842 -> success at 844 is exactly 2 s later (out); 843 -> 844 is 1 s (in)
    assert got == {epoch(1558430842): "timeout", epoch(1558430843): "matched"}


def test_burst_rule_keeps_null_keys_and_needs_one_batch_only(spark):
    """A key that only ever fails is one run; batches of 10 rows must give the
    same chunks, and a NULL key is a group of its own."""
    from datetime import timedelta

    rows = [(k, at(0) + timedelta(milliseconds=700 * i), "fail") for k in (None, 9007199254740993) for i in range(95)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp, event_type string")
    want = [(str(k), 3) for k in (None, 9007199254740993) for _ in range(31)]
    want += [(str(k), 2) for k in (None, 9007199254740993)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = burst_warnings(df, ["user_id"], "ts", F.col("event_type") == "fail", "2 seconds").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == len(want)
    assert {r.user_id for r in got} >= {None}
