"""Event-time stateful processors for ``transformWithState`` (STR-9,
GATE-1, SEQ-1, SEQ-2, SEQ-3, JOIN-1, CHG-1).

Rows of one key inside a micro-batch arrive in no particular order, so every
processor here follows one pattern (:class:`EventTimeReplay`):

* new rows go to a MapState buffer by time slot, with one event-time timer
  per slot, at its earliest row;
* when the watermark passes, the rows of the due slots, and of no other one,
  are read, released up to the watermark in ``(ts, seq)`` order and fed to a
  small per-key state machine; the next deadline of that machine (timeout,
  period end) is a timer too, and is fired in time order between the released
  rows.

This makes the result independent of how the input is cut into
micro-batches, and equal to the batch operators for rows that are not late.
State is per key, so it is spread over all tasks like any keyed shuffle.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def to_ms(ts: datetime) -> int:
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=timezone.utc)
    return int((ts - _EPOCH) // timedelta(milliseconds=1))


def _us(ts: datetime) -> int:
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=timezone.utc)
    return (ts - _EPOCH) // timedelta(microseconds=1)


def timer_ms(us: int) -> int:
    """Timer for a time in microseconds: timers and watermarks are whole
    milliseconds, so the first one that is not before the time."""
    return -(-us // 1000)


def _plain(v):
    """Rows as plain tuples: the state API takes nested values in that form."""
    return tuple(_plain(x) for x in v) if isinstance(v, tuple) else v


class EventTimeReplay(StatefulProcessor):
    """Base class.  Subclasses define ``row_schema`` (buffered fields; must
    contain ``ts``), ``state_schema`` (one value per key, handled as a dict)
    and the hooks ``on_event`` / ``on_deadline`` / ``next_deadline``.  A deadline
    fires before any row with a time at or after it."""

    row_schema: T.StructType
    state_schema: T.StructType
    order_fields: tuple = ("ts",)
    #: Width of a buffer slot.
    slot_us: int = 3_600_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getMapState("buf", T.StructType([T.StructField("slot", T.LongType())]),
                                      T.StructType([T.StructField("rows", T.ArrayType(self.row_schema))]))
        self.state = handle.getValueState("st", T.StructType([
            *self.state_schema.fields, T.StructField("__slots", T.ArrayType(T.LongType())),
            T.StructField("__timer", T.LongType())]))
        self._ts_at = self.row_schema.names.index("ts")
        # Keys already replayed up to the current watermark in this batch.
        # Timers run after all input rows of a batch, so a second timer of
        # the same key and watermark has nothing left to do.
        self._replayed: dict = {}

    # -- subclass hooks -------------------------------------------------
    def initial_state(self) -> dict:
        return {}

    def on_event(self, key, st: dict, row: Row) -> list:
        return []

    def on_deadline(self, key, st: dict, at_us: int) -> list:
        return []

    def next_deadline(self, st: dict) -> int | None:
        """Earliest pending deadline (micros) of the state machine."""
        return None

    def wanted(self, st: dict) -> bool:
        """Whether later rows can still matter; else they aren't buffered."""
        return True

    def trim(self, rows: list) -> list:
        """The rows of one slot (tuples) that can still matter."""
        return rows

    def idle(self, st: dict) -> bool:
        """Whether the state says no more than no state at all; it is then
        removed, so keys that have come to rest cost nothing."""
        start = self.initial_state()
        return all(st.get(n) == start.get(n) for n in self.state_schema.names)

    # -- machinery ------------------------------------------------------
    # Every state call is a round trip to the state server, so each callback
    # reads the value state once, and a slot's rows are read once when it is due.
    def _load(self) -> dict:
        v = self.state.get()
        names = [*self.state_schema.names, "__slots", "__timer"]
        return dict(zip(names, v)) if v is not None else {**self.initial_state(), "__slots": [], "__timer": None}

    def _save(self, st: dict) -> None:
        if not st["__slots"] and self.idle(st):
            self.state.clear()
        else:
            self.state.update(tuple(_plain(st.get(n)) for n in [*self.state_schema.names, "__slots", "__timer"]))

    def _in_order(self, rows: list) -> list:
        at = [self.row_schema.names.index(f) for f in self.order_fields]
        return sorted(rows, key=lambda t: tuple(t[i] for i in at))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new: dict[int, list] = {}
        for r in rows:
            new.setdefault(_us(r["ts"]) // self.slot_us, []).append(tuple(_plain(r[n]) for n in self.row_schema.names))
        if not new:
            return iter([])
        st = self._load()
        if not self.wanted(st):
            return iter([])
        known = set(st["__slots"] or [])
        for slot, got in new.items():
            self.handle.registerTimer(min(timer_ms(_us(t[self._ts_at])) for t in got))
            if slot in known:
                got = [_plain(r) for r in self.buf.getValue((slot,))[0]] + got
            self.buf.updateValue((slot,), (self.trim(got),))
        if not known.issuperset(new):
            st["__slots"] = sorted(known | set(new))
            self._save(st)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        if self._replayed.get(key) == wm_us:
            return iter([])
        self._replayed[key] = wm_us
        st = self._load()
        out: list = []
        stay = []
        for slot in st["__slots"] or []:                    # ascending
            if slot * self.slot_us > wm_us:
                stay.append(slot)
                continue
            rows = [_plain(r) for r in self.buf.getValue((slot,))[0]]
            rest = []
            if (slot + 1) * self.slot_us > wm_us:           # due in part
                rest = [t for t in rows if _us(t[self._ts_at]) > wm_us]
                rows = [t for t in rows if _us(t[self._ts_at]) <= wm_us]
            if rest:
                stay.append(slot)
                self.handle.registerTimer(min(timer_ms(_us(t[self._ts_at])) for t in rest))
                if rows:
                    self.buf.updateValue((slot,), (rest,))
            else:
                self.buf.removeKey((slot,))
            for t in self._in_order(rows):
                r = Row(**dict(zip(self.row_schema.names, t)))
                out += self._fire(key, st, _us(r["ts"]))    # deadlines at or before the row
                out += self.on_event(key, st, r)
        st["__slots"] = stay
        out += self._fire(key, st, wm_us)
        due = self.next_deadline(st)
        timer = None if due is None else timer_ms(due)
        if timer != st["__timer"]:
            # the old one is off (matched, reset, moved), unless a buffered row may share it
            if st["__timer"] is not None and st["__timer"] * 1000 > wm_us and not stay:
                self.handle.deleteTimer(st["__timer"])
            if timer is not None:
                self.handle.registerTimer(timer)
            st["__timer"] = timer
        self._save(st)
        return iter(out)

    def close(self) -> None:
        self._replayed.clear()

    def _fire(self, key, st: dict, t_us: int) -> list:
        out = []
        while True:
            due = self.next_deadline(st)
            if due is None or due > t_us:
                return out
            out += self.on_deadline(key, st, due)


def _ts(us: int) -> datetime:
    return (_EPOCH + timedelta(microseconds=us)).replace(tzinfo=None)


class StrictPairs(EventTimeReplay):
    """SEQ-1: A immediately followed by B (per key, event time) within T."""

    row_schema = T.StructType([T.StructField("ts", T.TimestampType()),
                               T.StructField("seq", T.LongType()),
                               T.StructField("a", T.BooleanType()),
                               T.StructField("b", T.BooleanType())])
    state_schema = T.StructType([T.StructField("last_us", T.LongType()),
                                 T.StructField("last_a", T.BooleanType())])
    order_fields = ("ts", "seq")

    def __init__(self, within_us: int, msg: str):
        self.within_us, self.msg = within_us, msg

    def next_deadline(self, st):       # past it, the open A can't be matched any more
        return st["last_us"] + self.within_us if st.get("last_a") else None

    def on_deadline(self, key, st, at_us):
        st.update(last_us=None, last_a=None)
        return []

    def idle(self, st):
        return not st.get("last_a")

    def on_event(self, key, st, row):
        t = _us(row["ts"])
        out = []
        if row["b"] and st.get("last_a") and t < st["last_us"] + self.within_us:
            out.append(Row(user_id=key[0], first_ts=_ts(st["last_us"]), last_ts=row["ts"],
                           msg=self.msg))
        st["last_us"], st["last_a"] = t, bool(row["a"])
        return out


class ClickGate(EventTimeReplay):
    """GATE-1: max_count + 1 events pass per key and period, the next one
    warns once; the period (UTC day) ends with a timer that clears state.  Of a
    slot's events only the first max_count + 2 can matter and are kept; without
    a period, nothing is kept once the warning is out."""

    row_schema = T.StructType([T.StructField("ts", T.TimestampType()),
                               T.StructField("seq", T.LongType())])
    state_schema = T.StructType([T.StructField("count", T.LongType()),
                                 T.StructField("sent", T.BooleanType()),
                                 T.StructField("period_end_us", T.LongType())])
    order_fields = ("ts", "seq")

    def __init__(self, max_count: int, msg: str, period_us: int | None):
        self.max_count, self.msg, self.period_us = max_count, msg, period_us
        # slots do not cross the end of a period
        self.slot_us = type(self).slot_us if period_us is None or period_us % type(self).slot_us == 0 else period_us

    def wanted(self, st):
        return self.period_us is not None or not st.get("sent")

    def trim(self, rows):
        most = self.max_count + 2
        return rows if len(rows) <= most else self._in_order(rows)[:most]

    def initial_state(self):
        return {"count": 0, "sent": False, "period_end_us": None}

    def next_deadline(self, st):
        return st.get("period_end_us")

    def on_deadline(self, key, st, at_us):
        st.update(count=0, sent=False, period_end_us=None)
        return []

    def on_event(self, key, st, row):
        t = _us(row["ts"])
        if st.get("count") is None:
            st.update(self.initial_state())
        if self.period_us and st["period_end_us"] is None:
            st["period_end_us"] = (t // self.period_us + 1) * self.period_us
        base = dict(event_id=row["seq"], user_id=key[0], ad_id=key[1], ts=row["ts"])
        if st["count"] > self.max_count:
            if not st["sent"]:
                st["sent"] = True
                return [Row(**base, tag="blacklist", msg=self.msg)]
            return []
        st["count"] += 1
        return [Row(**base, tag="pass", msg=None)]


class FollowedBy(EventTimeReplay):
    """SEQ-2: each A waits for the first B at or after it; matched if the
    gap is < T, else a timeout fired by the deadline A + T."""

    row_schema = T.StructType([T.StructField("ts", T.TimestampType()),
                               T.StructField("seq", T.LongType()),
                               T.StructField("a", T.BooleanType()),
                               T.StructField("b", T.BooleanType())])
    state_schema = T.StructType([T.StructField("open_us", T.ArrayType(T.LongType()))])
    order_fields = ("ts", "seq")

    def __init__(self, within_us: int, matched_msg: str, timeout_msg: str):
        self.within_us, self.matched_msg, self.timeout_msg = within_us, matched_msg, timeout_msg

    def initial_state(self):
        return {"open_us": []}

    def next_deadline(self, st):
        return st["open_us"][0] + self.within_us if st.get("open_us") else None     # in time order

    def on_deadline(self, key, st, at_us):
        opened = st["open_us"]
        n = bisect_right(opened, at_us - self.within_us)
        st["open_us"] = opened[n:]
        return [Row(order_id=key[0], start_ts=_ts(s), match_ts=None, result_msg=self.timeout_msg, tag="timeout")
                for s in opened[:n]]

    def on_event(self, key, st, row):
        t = _us(row["ts"])
        out = []
        if row["b"]:
            for s in st["open_us"]:   # deadlines <= t already fired, so t < s + T here
                out.append(Row(order_id=key[0], start_ts=_ts(s), match_ts=row["ts"],
                               result_msg=self.matched_msg, tag="matched"))
            st["open_us"] = []
        if row["a"]:
            st["open_us"] = [*st["open_us"], t]
        return out


class OneOpenRecord(EventTimeReplay):
    """JOIN-1 with each record matched once: a key has at most one open record.
    A record of the other side within the tolerance matches it and takes its
    timer back; otherwise the new record replaces it; a timer reports a record
    that stayed alone.  ``p`` and ``r`` are the records of the two sides."""

    order_fields = ("ts", "side", "seq", "same")

    def __init__(self, tolerance_us: int, pay: T.StructType, receipt: T.StructType, tags: tuple):
        self.tolerance_us, self.tags = tolerance_us, tags
        self.slot_us = max(16 * tolerance_us, 1_000_000)     # few state calls per key
        sides = [T.StructField("p", pay), T.StructField("r", receipt)]
        self.row_schema = T.StructType([
            T.StructField("ts", T.TimestampType()), T.StructField("side", T.IntegerType()),
            T.StructField("seq", T.LongType()), T.StructField("same", T.LongType()), *sides])
        self.state_schema = T.StructType([T.StructField("open_us", T.LongType()),
                                          T.StructField("side", T.IntegerType()), *sides])

    def _out(self, key, p, r, tag):
        # nested results are handed over by name
        p, r = (None if v is None else dict(zip(self.row_schema[c].dataType.names, v)) for c, v in (("p", p), ("r", r)))
        return Row(tx=key[0], p=p, r=r, tag=tag)

    def next_deadline(self, st):
        return None if st.get("open_us") is None else st["open_us"] + self.tolerance_us + 1

    def _alone(self, key, st):
        return [self._out(key, st["p"], st["r"], self.tags[1 + st["side"]])]

    def on_deadline(self, key, st, at_us):
        out = self._alone(key, st)
        st.update(open_us=None, side=None, p=None, r=None)
        return out

    def on_event(self, key, st, row):
        out = []
        if st.get("open_us") is not None:
            if st["side"] != row["side"]:           # its deadline has not fired, so it is near enough
                p, r = (st["p"], row["r"]) if st["side"] == 0 else (row["p"], st["r"])
                st.update(open_us=None, side=None, p=None, r=None)
                return [self._out(key, p, r, self.tags[0])]
            out = self._alone(key, st)
        st.update(open_us=_us(row["ts"]), side=row["side"], p=row["p"], r=row["r"])
        return out


class RunningCountChangelog(StatefulProcessor):
    """CHG-1: running count per key as a changelog: for every key touched in
    a micro-batch, a retraction of the old count (op '-') and the new count
    (op '+')."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n = sum(1 for _ in rows)
        old = self.count.get()[0] if self.count.exists() else 0
        self.count.update((old + n,))
        out = []
        if old:
            out.append(Row(key=key[0], op="-", count=old))
        out.append(Row(key=key[0], op="+", count=old + n))
        return iter(out)


class ArrivalPairs(StatefulProcessor):
    """SEQ-1b on a stream: arrival order, no waiting for the watermark.
    Rows of a key within a micro-batch are ordered by their arrival
    sequence; the last event is kept in state."""

    state_schema = T.StructType([T.StructField("last_us", T.LongType()),
                                 T.StructField("last_a", T.BooleanType())])

    def __init__(self, within_us: int, msg: str):
        self.within_us, self.msg = within_us, msg

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("last", self.state_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last_us, last_a = self.state.get() or (None, False)
        out = []
        for r in sorted(rows, key=lambda r: r["seq"]):
            t = _us(r["ts"])
            if r["b"] and last_a and t < last_us + self.within_us:
                out.append(Row(user_id=key[0], first_ts=_ts(last_us), last_ts=r["ts"],
                               msg=self.msg))
            last_us, last_a = t, bool(r["a"])
        if last_a:
            self.state.update((last_us, last_a))
        else:               # only an open A matters to the next row
            self.state.clear()
        return iter(out)


class BurstRule(EventTimeReplay):
    """SEQ-1c: the first failure opens a chunk; its deadline is start + T
    (+1 us, so a failure exactly at start + T is still in); a success drops
    the chunk; at the deadline the chunk warns when it holds >= N failures."""

    row_schema = T.StructType([T.StructField("ts", T.TimestampType()),
                               T.StructField("seq", T.LongType()),
                               T.StructField("fail", T.BooleanType())])
    state_schema = T.StructType([T.StructField("start_us", T.LongType()),
                                 T.StructField("last_us", T.LongType()),
                                 T.StructField("n", T.LongType())])
    order_fields = ("ts", "seq")

    def __init__(self, within_us: int, min_count: int, prefix: str, suffix: str):
        self.within_us, self.min_count = within_us, min_count
        self.prefix, self.suffix = prefix, suffix

    def initial_state(self):
        return {"start_us": None, "last_us": None, "n": 0}

    def next_deadline(self, st):
        s = st.get("start_us")
        return None if s is None else s + self.within_us + 1

    def on_deadline(self, key, st, at_us):
        out = []
        if (st.get("n") or 0) >= self.min_count:
            out.append(Row(user_id=key[0], first_ts=_ts(st["start_us"]),
                           last_ts=_ts(st["last_us"]),
                           msg=f"{self.prefix}{st['n']}{self.suffix}"))
        st.update(self.initial_state())
        return out

    def on_event(self, key, st, row):
        t = _us(row["ts"])
        if not row["fail"]:
            st.update(self.initial_state())
            return []
        if st.get("start_us") is None:
            st.update(start_us=t, last_us=t, n=1)
        else:
            st.update(last_us=t, n=st["n"] + 1)
        return []


class _FirstTimesFold(StatefulProcessor):
    """Base for order rules that depend only on the first create and first
    pay time of a key.  Rows are folded into two minimums as they arrive
    (O(1) state, no row buffer); the decision waits until the watermark has
    passed the time it depends on, after which no on-time row can change the
    minimums.  A decided key, or one that nothing is due for, is remembered for
    ``keep_us`` more event time, so that its later rows are not taken for a new
    order; then its state is removed."""

    state_schema = T.StructType([T.StructField("create_us", T.LongType()),
                                 T.StructField("pay_us", T.LongType()),
                                 T.StructField("done", T.BooleanType()),
                                 T.StructField("until_us", T.LongType())])
    keep_us: int = 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("first", self.state_schema)

    def due(self, c, p) -> int | None:
        raise NotImplementedError

    def decide(self, key, c, p) -> list:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        c, p, done, until = self.state.get() or (None, None, False, None)
        if done:
            return iter([])
        for r in rows:
            t = _us(r["ts"])
            if r["is_create"] and (c is None or t < c):
                c = t
            if r["is_pay"] and (p is None or t < p):
                p = t
        if c is None and p is None:
            return iter([])
        d = self.due(c, p)
        until = max(x for x in (c, p, d) if x is not None) + self.keep_us
        self.state.update((c, p, False, until))
        self.handle.registerTimer(timer_ms(until if d is None else d))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        v = self.state.get()
        if v is None:
            return iter([])
        c, p, done, until = v
        wm_us = timerValues.getCurrentWatermarkInMs() * 1000
        d = None if done else self.due(c, p)
        out: list = []
        if d is not None and d <= wm_us:
            out, done, d = self.decide(key, c, p), True, None
            self.state.update((c, p, True, until))
        if d is not None:                       # minimums moved the decision
            self.handle.registerTimer(timer_ms(d))
        elif until <= wm_us:
            self.state.clear()
        else:
            self.handle.registerTimer(timer_ms(until))
        return iter(out)


class OrderOutcome(_FirstTimesFold):
    """SEQ-3 with one outcome per order.  Both sides known: decided once the
    watermark passes the later of the two; a lone create is reported at
    create + T + grace, a lone pay at pay + grace (``grace`` = how long the
    other side may still arrive)."""

    def __init__(self, within_us: int, grace_us: int, msgs: dict):
        self.within_us, self.grace_us, self.msgs = within_us, grace_us, msgs
        self.keep_us = grace_us

    def due(self, c, p):
        if c is not None and p is not None:
            return max(c, p)
        if c is not None:
            return c + self.within_us + self.grace_us
        if p is not None:
            return p + self.grace_us
        return None

    def decide(self, key, c, p):
        if c is not None and p is not None:
            msg = self.msgs["payed"] if p < c + self.within_us else self.msgs["payed_late"]
        elif c is not None:
            msg = self.msgs["order_timeout"]
        else:
            msg = self.msgs["pay_no_create"]
        return [Row(order_id=key[0], create_ts=_ts(c) if c is not None else None,
                    pay_ts=_ts(p) if p is not None else None, result_msg=msg,
                    tag="payed" if msg == self.msgs["payed"] else "timeout")]


class DeadlineDecision(_FirstTimesFold):
    """SEQ-4: decide only at create + T (inclusive, so just after it): payed
    if a pay came at or after the create and by the deadline; a pay before
    the create means no deadline and no output."""

    def __init__(self, within_us: int, payed_msg: str, timeout_msg: str, keep_us: int | None = None):
        self.within_us, self.payed_msg, self.timeout_msg = within_us, payed_msg, timeout_msg
        self.keep_us = within_us if keep_us is None else keep_us

    def due(self, c, p):
        return None if c is None else c + self.within_us + 1

    def decide(self, key, c, p):
        if p is not None and p < c:
            return []
        in_time = p is not None and p <= c + self.within_us
        return [Row(order_id=key[0], create_ts=_ts(c), pay_ts=_ts(p) if in_time else None,
                    result_msg=self.payed_msg if in_time else self.timeout_msg)]
