from datetime import datetime, timedelta

from eventide.operators import click_gate, gate_passed, gate_warnings


def _clicks(spark, n, start=datetime(2017, 11, 26, 1, 0), user=937166, ad=1715, step_s=1):
    rows = [(i, user, ad, start + timedelta(seconds=i * step_s)) for i in range(n)]
    return spark.createDataFrame(rows, "seq long, user_id long, ad_id long, ts timestamp")


def test_101_pass_and_the_102nd_warns_once(spark):
    gated = click_gate(_clicks(spark, 121), max_count=100, seq="seq")
    assert gate_passed(gated).count() == 101
    warn = gate_warnings(gated).collect()
    assert len(warn) == 1
    assert warn[0].msg == "Click over100 times today."
    assert warn[0].ts == datetime(2017, 11, 26, 1, 0) + timedelta(seconds=101)  # the 102nd click


def test_counts_reset_at_the_next_utc_midnight(spark):
    start = datetime(2017, 11, 26, 23, 59, 55)
    gated = click_gate(_clicks(spark, 10, start=start), max_count=2, seq="seq", bucket="2 seconds")
    passed = [r.ts for r in gate_passed(gated).orderBy("ts").collect()]
    # 3 pass before midnight (23:59:55..57), 3 pass after (00:00:00..02)
    assert [t.second for t in passed] == [55, 56, 57, 0, 1, 2]
    assert gate_warnings(gated).count() == 2


def test_keys_are_independent_and_period_can_be_off(spark):
    a = _clicks(spark, 5, user=1)
    b = _clicks(spark, 5, user=2)
    gated = click_gate(a.unionByName(b), max_count=1, period=None, seq="seq")
    assert gate_passed(gated).count() == 4
    assert gate_warnings(gated).count() == 2


def test_hot_key_split_over_many_buckets_gives_same_result(spark):
    df = _clicks(spark, 300, step_s=37)
    a = {r.seq for r in gate_passed(click_gate(df, max_count=100, seq="seq", bucket="5 minutes")).collect()}
    b = {r.seq for r in gate_passed(click_gate(df, max_count=100, seq="seq", bucket="7 days")).collect()}
    assert a == b == set(range(101))
