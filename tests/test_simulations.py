"""Batch operators against event-by-event simulations of the reference's
keyed state machines, on random inputs."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eventide.operators import click_gate, followed_by, strict_next


def _gate_sim(rows, max_count):
    """Per (user, ad, UTC day): n passed so far; n > max drops, first drop warns."""
    state, passed, warned = {}, set(), set()
    for seq, user, ad, ts in sorted(rows, key=lambda r: (r[3], r[0])):
        key = (user, ad, ts.date())
        n, sent = state.get(key, (0, False))
        if n > max_count:
            if not sent:
                warned.add(seq)
                sent = True
        else:
            passed.add(seq)
            n += 1
        state[key] = (n, sent)
    return passed, warned


def test_click_gate_equals_state_machine(spark):
    rnd = random.Random(21)
    t0 = datetime(2024, 3, 1, 20)
    rows = [(i, rnd.choice([1, 1, 1, 2]), rnd.choice([7, 8]),
             t0 + timedelta(minutes=rnd.randint(0, 60 * 30))) for i in range(1500)]
    df = spark.createDataFrame(rows, "seq long, user_id long, ad_id long, ts timestamp")
    for max_count in (3, 40):
        gated = click_gate(df, max_count=max_count, seq="seq", bucket="45 minutes").collect()
        got_pass = {r.seq for r in gated if r.tag == "pass"}
        got_warn = {r.seq for r in gated if r.tag == "blacklist"}
        want_pass, want_warn = _gate_sim(rows, max_count)
        assert got_pass == want_pass and got_warn == want_warn


def _arrival_sim(rows, within_s):
    """Keep the last fail; a fail with a stored fail warns if t < first + within;
    any other event clears the state (arrival order)."""
    last, out = {}, []
    for seq, user, kind, ts in sorted(rows, key=lambda r: r[0]):
        if kind == "fail":
            prev = last.get(user)
            if prev is not None and ts < prev + timedelta(seconds=within_s):
                out.append((user, prev, ts))
            last[user] = ts
        else:
            last.pop(user, None)
    return sorted(out)


def test_arrival_rule_across_many_sequence_buckets(spark):
    rnd = random.Random(5)
    t0 = datetime(2024, 1, 1)
    rows = [(i, rnd.choice([1, 2, 3]), "fail" if rnd.random() < 0.6 else "success",
             t0 + timedelta(seconds=rnd.randint(0, 400))) for i in range(500)]
    df = spark.createDataFrame(rows, "seq long, user_id long, event_type string, ts timestamp")
    fail = F.col("event_type") == "fail"
    got = sorted((r.user_id, r.first_ts, r.last_ts) for r in strict_next(
        df, ["user_id"], "ts", fail, fail, "2 seconds", order=["seq"], seq_bucket=7).collect())
    assert got == _arrival_sim(rows, 2)


def _followed_by_sim(rows, within_s):
    """Each create waits for the first pay at or after it."""
    out = {}
    for seq, order, kind, ts in rows:
        if kind != "create":
            continue
        pays = [t for _, o, k, t in rows if o == order and k == "pay" and t >= ts]
        first = min(pays) if pays else None
        ok = first is not None and first < ts + timedelta(seconds=within_s)
        out[(order, ts)] = first if ok else None
    return out


def test_followed_by_equals_simulation(spark):
    rnd = random.Random(8)
    t0 = datetime(2024, 1, 1)
    rows = [(i, rnd.randint(1, 12), rnd.choice(["create", "pay", "view"]),
             t0 + timedelta(seconds=rnd.randint(0, 5000))) for i in range(600)]
    df = spark.createDataFrame(rows, "seq long, order_id long, event_type string, ts timestamp")
    got = {(r.order_id, r.start_ts): r.match_ts for r in followed_by(
        df, ["order_id"], "ts", F.col("event_type") == "create", F.col("event_type") == "pay",
        "15 minutes", bucket="10 minutes").collect()}
    assert got == _followed_by_sim(rows, 900)
