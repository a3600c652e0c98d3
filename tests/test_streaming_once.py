"""One open record per id on a stream, and the time-ordered buffers behind it."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from eventide.operators.reconciliation import reconcile_once
from eventide.streaming.processors import ClickGate, EventTimeReplay, FollowedBy, OneOpenRecord, timer_ms
from eventide.streaming.reconcile import reconcile_once_stream
from eventide.streaming.runner import (before_flush, event_time, live, prepare_streaming, replay_stream, run_and_read,
                                       time_bounds)

T0 = datetime(2024, 1, 1)
US = 1_000_000


def test_stream_equals_batch(spark):
    rnd = random.Random(6)
    at = lambda s: T0 + timedelta(seconds=s)
    pays = [(rnd.choice(["hot", "a", None]), at(rnd.randint(0, 600)), i) for i in range(150)]
    rcps = [(rnd.choice(["hot", "a", None]), at(rnd.randint(0, 600)), i) for i in range(150)]
    p = spark.createDataFrame(pays, "tx_id string, pay_ts timestamp, p int")
    r = spark.createDataFrame(rcps, "tx_id string, receipt_ts timestamp, r int")
    want = reconcile_once(p, r, "3 seconds", pay_seq="p", receipt_seq="r").collect()
    prepare_streaming(spark)
    bounds = time_bounds(p, "pay_ts", 4)
    ps = event_time(replay_stream(p, "pay_ts", bounds=bounds), "pay_ts", "0 seconds")
    rs = event_time(replay_stream(r, "receipt_ts", bounds=bounds), "receipt_ts", "0 seconds")
    once = reconcile_once_stream(ps.filter(live(F.lit(True), "pay_ts")), rs.filter(live(F.lit(True), "receipt_ts")),
                                 "3 seconds", pay_seq="p", receipt_seq="r")
    got = run_and_read(once, "once", transform=lambda b: before_flush(b, "pay_ts", "receipt_ts")).collect()
    key = lambda x: str((x.tx_id, x.pay_ts, x.p, x.receipt_ts, x.r, x.tag))
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert {x.tag for x in got} == {"matched", "unmatched_pay", "unmatched_receipt"}


# ------------------------------------------------- a processor without a stream
class Value:
    def __init__(self):
        self.v = None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v

    def clear(self):
        self.v = None


class Map:
    def __init__(self):
        self.d, self.read = {}, 0

    def getValue(self, k):
        self.read += len(self.d[k][0])
        return self.d[k]

    def updateValue(self, k, v):
        self.d[k] = v

    def removeKey(self, k):
        del self.d[k]


class Handle:
    """The state calls that a processor makes, with its timers."""

    def __init__(self):
        self.timers, self.map, self.value = set(), Map(), Value()

    def getMapState(self, *_):
        return self.map

    def getValueState(self, *_):
        return self.value

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.discard(ms)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def started(processor):
    processor.init(Handle())
    return processor, processor.handle


def advance(p, h, wm_ms, key=("k",)):
    out = []
    while due := [t for t in h.timers if t <= wm_ms]:
        h.timers.difference_update(due)
        for _ in sorted(due):
            out += p.handleExpiredTimer(key, At(wm_ms), None)
        p.close()
    return out


def us(row_s):
    return T0 + timedelta(seconds=row_s)


def wm(s):
    return timer_ms(int((us(s) - datetime(1970, 1, 1)).total_seconds() * US))


def test_state_read_per_timer_does_not_grow_with_the_buffer():
    reads = []
    for far in (10, 1000):
        p, h = started(FollowedBy(60 * US, "m", "t"))
        rows = [Row(ts=us(0), seq=0, a=True, b=False), Row(ts=us(1), seq=1, a=False, b=True)]
        rows += [Row(ts=us(10 * 3600 + 5 * i), seq=i, a=False, b=True) for i in range(far)]
        p.handleInputRows(("k",), iter(rows), At(0))
        h.map.read = 0
        out = advance(p, h, wm(2))
        assert [r.tag for r in out] == ["matched"]
        reads.append(h.map.read)
    assert reads[0] == reads[1] == 2


def test_a_match_takes_the_timer_back():
    from pyspark.sql import types as T

    side = T.StructType([T.StructField("no", T.IntegerType())])
    p, h = started(OneOpenRecord(5 * US, side, side, ("m", "up", "ur")))
    row = lambda s, who, no: Row(ts=us(s), side=who, seq=no, same=no, p=(no,) if who == 0 else None,
                                 r=(no,) if who == 1 else None)
    p.handleInputRows(("k",), iter([row(0, 0, 1)]), At(0))
    assert advance(p, h, wm(0)) == []
    assert h.timers == {timer_ms(int((us(5) - datetime(1970, 1, 1)).total_seconds() * US) + 1)}
    p.handleInputRows(("k",), iter([row(3, 1, 2)]), At(wm(0)))
    out = advance(p, h, wm(3))
    assert [(r.tag, r.p, r.r) for r in out] == [("m", {"no": 1}, {"no": 2})]
    assert h.timers == set() and h.value.v is None and not h.map.d       # nothing is left
    p.handleInputRows(("k",), iter([row(10, 1, 3)]), At(wm(3)))
    assert advance(p, h, wm(10)) == []
    assert [(r.tag, r.r) for r in advance(p, h, wm(20))] == [("ur", {"no": 3})]
    assert h.timers == set() and h.value.v is None


@pytest.mark.parametrize("period_us", [None, 86_400 * US])
def test_the_gate_keeps_what_can_matter(period_us):
    p, h = started(ClickGate(2, "msg", period_us))
    for part in range(5):
        p.handleInputRows(("u", "ad"), iter([Row(ts=us(60 * part + i / 10), seq=100 * part + i) for i in range(100)]), At(0))
    assert sum(len(v[0]) for v in h.map.d.values()) == 4                  # max_count + 2 of the slot's 500
    out = advance(p, h, wm(3000), ("u", "ad"))
    assert [(r.event_id, r.tag) for r in out] == [(0, "pass"), (1, "pass"), (2, "pass"), (3, "blacklist")]
    p.handleInputRows(("u", "ad"), iter([Row(ts=us(3100), seq=999)]), At(wm(3000)))
    assert (len(h.map.d) == 0) == (period_us is None)                     # warned for good: nothing is buffered
    assert advance(p, h, wm(3200), ("u", "ad")) == []


def test_rows_are_released_in_order_over_slots_and_watermarks():
    class Seen(FollowedBy):
        slot_us = 7 * US

        def on_event(self, key, st, row):
            return [row.seq]

    rnd = random.Random(1)
    times = [rnd.randint(0, 100) for _ in range(200)]
    p, h = started(Seen(US, "m", "t"))
    out = []
    for lo in range(0, 101, 13):
        rows = [Row(ts=us(t), seq=i, a=False, b=False) for i, t in enumerate(times) if lo <= t < lo + 13]
        p.handleInputRows(("k",), iter(rows), At(0))
        out += advance(p, h, wm(lo + 5))
    out += advance(p, h, wm(500))
    assert out == sorted(range(200), key=lambda i: (times[i], i))
    assert not h.map.d and h.value.v is None
    assert issubclass(Seen, EventTimeReplay)
