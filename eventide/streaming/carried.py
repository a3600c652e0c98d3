"""Batch operators on a stream, with the open rows carried as a table
(STR-9, GATE-1, SEQ-1, SEQ-1c, SEQ-2, SEQ-3, SEQ-4, JOIN-1, AGG-3).

The processors of :mod:`eventide.streaming.processors` keep state per key and
pay a round trip for each state call; that is for streams that want a row's
result at once.  Here a micro-batch is one set of joins, groups and windows:

* the watermark is the latest event time so far less ``delay``; rows up to it
  are *due*, later ones wait, rows at or before the last watermark are late and
  dropped.  Rows without a time are due at once, before all others;
* a *step* gets the due rows, the rows that the epoch before carried and the
  watermark, and returns rows with two flags: ``__emit`` (a result) and
  ``__carry`` (later rows can depend on it).  Steps can be chained: the next one
  gets the rows that the one before emits.

Rows of one epoch come after those of all epochs before, so a step is the batch
operator over (carried rows + due rows).  Epoch k reads what epoch k - 1 wrote
and overwrites its own folders: a micro-batch that is replayed gives the same
rows once.  What was carried only is removed two epochs later.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.time import duration_micros, epoch_micros, event_window
from eventide.operators.gate import click_gate
from eventide.operators.orders import (MSG_DEADLINE_PAYED, MSG_ORDER_TIMEOUT, MSG_PAY_NO_CREATE, MSG_PAYED,
                                       MSG_PAYED_LATE)
from eventide.operators.reconciliation import (TAG_MATCHED, TAG_UNMATCHED_PAY, TAG_UNMATCHED_RECEIPT,
                                               reconcile_once)
from eventide.operators.sequence import burst_chunks, burst_warning, followed_by, strict_next
from eventide.session import scratch_path
from eventide.streaming.runner import SENTINEL_TS, run_batches

#: (due rows, carried rows or None, watermark) -> rows with ``__emit`` and ``__carry``
Step = Callable[[DataFrame, "DataFrame | None", Column], DataFrame]

_FLAGS = ("__emit", "__carry")


def _epoch(folder: str, epoch: int) -> str:
    return f"{folder}/epoch={epoch:09d}"


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _plus(rows: DataFrame, old: DataFrame | None) -> DataFrame:
    return rows if old is None else rows.unionByName(old.select(*rows.columns))


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def run_carried(stream: DataFrame, name: str, steps: Sequence[Step], ts: str = "ts",
                delay: str = "0 seconds") -> DataFrame:
    """Run the steps over a stream that ends with the flush sentinel; returns
    what the last one emits."""
    spark = stream.sparkSession
    out = scratch_path(spark, f"{name}-out")
    wait_us = duration_micros(delay)
    schemas: dict[int, T.StructType] = {}

    def write_batch(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        last = None if epoch == 0 else session.read.parquet(_epoch(f"{out}/watermark", epoch - 1)).first()["us"]
        latest = batch.agg(F.max(epoch_micros(ts))).first()[0]
        now = max((x for x in (last, None if latest is None else latest - wait_us) if x is not None), default=None)
        at = epoch_micros(F.col(ts))
        rows = batch if last is None else batch.filter(at.isNull() | (at > last))
        if wait_us and epoch > 0:
            rows = rows.unionByName(session.read.schema(batch.schema).parquet(_epoch(f"{out}/waiting", epoch - 1)))
        if wait_us:
            later = rows.filter(at > now) if now is not None else rows.limit(0)
            later.write.mode("overwrite").parquet(_epoch(f"{out}/waiting", epoch))
        flush = F.lit(SENTINEL_TS).cast(batch.schema[ts].dataType)
        due = rows.filter(at.isNull() | ((at <= F.lit(now).cast("long")) & (F.col(ts) < flush)))
        watermark = F.lit(now).cast("long")
        for i, step in enumerate(steps):
            folder = f"{out}/step={i}"
            old = None
            if epoch > 0:
                schema = schemas.get(i) or session.read.parquet(_epoch(f"{folder}-schema", 0)).schema
                old = session.read.schema(schema).parquet(_epoch(folder, epoch - 1)).filter("__carry").drop(*_FLAGS)
            result = step(due, old, watermark)
            if epoch == 0:
                result.limit(0).write.mode("overwrite").parquet(_epoch(f"{folder}-schema", 0))
            schemas[i] = result.schema
            result.filter("__emit OR __carry").write.mode("overwrite").partitionBy(*_FLAGS).parquet(_epoch(folder, epoch))
            due = session.read.schema(result.schema).parquet(_epoch(folder, epoch)).filter("__emit").drop(*_FLAGS)
            if epoch > 1:
                _remove(spark, f"{_epoch(folder, epoch - 2)}/__emit=false")
        if wait_us and epoch > 1:
            _remove(spark, _epoch(f"{out}/waiting", epoch - 2))
        session.range(1).select(F.lit(now).cast("long").alias("us")).write.mode("overwrite") \
            .parquet(_epoch(f"{out}/watermark", epoch))

    run_batches(stream, name, write_batch)
    last = len(steps) - 1
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schemas[last].fields])
    return spark.read.schema(schema).parquet(f"{out}/step={last}").filter("__emit").drop(*_FLAGS, "epoch")


# -------------------------------------------------------------------- steps
def gate_step(keys: Sequence[str], ts: str, seq: str, max_count: int, period: str | None = None) -> Step:
    """GATE-1: of each open period the rows that passed (``max_count`` + 1 at
    most) and the warning are carried."""
    def step(due, old, wm):
        cols = due.columns
        rows = _plus(due.withColumn("__old", F.lit(False)),
                     None if old is None else old.withColumn("__old", F.lit(True)))
        gated = click_gate(rows, keys, ts, max_count, period, seq)
        is_open = F.lit(True)
        if period is not None:
            at, width = epoch_micros(F.col(ts)), duration_micros(period)
            is_open = F.coalesce(at - F.pmod(at, F.lit(width)) + F.lit(width) > wm, F.lit(True))
        return gated.select(*cols, "tag", "msg", (~F.col("__old")).alias("__emit"), is_open.alias("__carry"))
    return step


def window_count_step(ts: str, size: str, slide: str, key: str) -> Step:
    """AGG-3: counts of open windows are carried, closed ones come out."""
    def step(due, old, wm):
        counts = (due.groupBy(event_window(ts, size, slide).alias("w"), key).agg(F.count(F.lit(1)).alias("count"))
                  .select(F.col("w.end").alias("window_end"), key, "count"))
        total = _plus(counts, old).groupBy("window_end", key).agg(F.sum("count").alias("count"))
        closed = epoch_micros(F.col("window_end")) <= wm
        return total.select("*", _flag(closed).alias("__emit"), (~_flag(closed)).alias("__carry"))
    return step


def strict_next_step(keys: Sequence[str], ts: str, seq: str, is_first: str, is_then: str, within: str,
                     msg: str) -> Step:
    """SEQ-1: each key's last row is carried while a next one can still match it.
    ``is_first`` and ``is_then`` are boolean columns."""
    keys, within_us = list(keys), duration_micros(within)
    last = list(dict.fromkeys([ts, seq, is_first, is_then]))
    cols = [*keys, *last]

    def step(due, old, wm):
        rows = _plus(due.select(*cols), old)
        pairs = strict_next(rows, keys, ts, F.col(is_first), F.col(is_then), within, seq=seq, msg=msg)
        newest = (rows.groupBy(*keys).agg(F.max_by(F.struct(*last), F.struct(ts, seq)).alias("v"))
                  .select(*keys, "v.*"))
        waits = F.col(is_first) & (epoch_micros(F.col(ts)) + F.lit(within_us) > wm)
        return (pairs.withColumns({"__emit": F.lit(True), "__carry": F.lit(False)})
                .unionByName(newest.withColumns({"__emit": F.lit(False), "__carry": _flag(waits)}),
                             allowMissingColumns=True))
    return step


def burst_step(keys: Sequence[str], ts: str, is_fail: str, within: str, min_count: int) -> Step:
    """SEQ-1c: the open chunk of a key is carried as first, last and number of
    failures.  It comes back as that many failures, which fold to the same chunk."""
    keys, within_us = list(keys), duration_micros(within)

    def step(due, old, wm):
        rows = due.select(*keys, ts, is_fail)
        if old is not None:
            times = F.concat(F.array("last_ts"), F.array_repeat("first_ts", (F.col("n") - 1).cast("int")))
            rows = rows.unionByName(old.select(*keys, F.explode(times).alias(ts), F.lit(True).alias(is_fail)))
        chunks = burst_chunks(rows, keys, ts, F.col(is_fail), within, 1)
        is_open = _flag(epoch_micros(F.col("first_ts")) + F.lit(within_us) >= wm)
        return chunks.select(*keys, "first_ts", "last_ts", "n", burst_warning("n").alias("msg"),
                             (~is_open & (F.col("n") >= min_count)).alias("__emit"), is_open.alias("__carry"))
    return step


def followed_by_step(keys: Sequence[str], ts: str, is_first: str, is_then: str, within: str) -> Step:
    """SEQ-2: an A without its B is carried until its time is up."""
    keys, within_us = list(keys), duration_micros(within)
    cols = [*keys, ts, is_first, is_then]

    def step(due, old, wm):
        rows = due.select(*cols)
        if old is not None:
            rows = rows.unionByName(old.select(*keys, F.col("start_ts").alias(ts), F.lit(True).alias(is_first),
                                               F.lit(False).alias(is_then)))
        found = followed_by(rows, keys, ts, F.col(is_first), F.col(is_then), within)
        waits = F.col("match_ts").isNull() & _flag(epoch_micros(F.col("start_ts")) + F.lit(within_us) > wm)
        return found.select("*", (~waits).alias("__emit"), waits.alias("__carry"))
    return step


def _first_times(due: DataFrame, old: DataFrame | None, key: str, ts: str, is_create: str, is_pay: str) -> DataFrame:
    """One row per order: its first create and first pay so far, ``done`` and ``until``."""
    rows = (due.groupBy(key).agg(F.min(F.when(F.col(is_create), F.col(ts))).alias("create_ts"),
                                 F.min(F.when(F.col(is_pay), F.col(ts))).alias("pay_ts"))
            .withColumns({"done": F.lit(False), "until": F.lit(None).cast("long")}))
    if old is None:
        return rows
    return (rows.unionByName(old.select(*rows.columns)).groupBy(key)
            .agg(*[F.min(c).alias(c) for c in ("create_ts", "pay_ts")], *[F.max(c).alias(c) for c in ("done", "until")]))


def _decided(rows: DataFrame, wm: Column, due_us: Column, keep: str, result: Column, **columns: Column) -> DataFrame:
    """Orders that are due come out if they have a ``result``.  A decided order,
    or one that nothing is due for, is remembered for ``keep`` more event time."""
    at = [epoch_micros(F.col(c)) for c in ("create_ts", "pay_ts")]
    until = F.when(F.col("done"), F.col("until")).otherwise(F.greatest(*at, due_us) + F.lit(duration_micros(keep)))
    ready = ~F.col("done") & _flag(due_us <= wm)
    return (rows.withColumns({"until": until, "__ready": ready})
            .withColumns({**columns, "done": F.col("done") | F.col("__ready"), "__emit": F.col("__ready") & result,
                          "__carry": F.coalesce(F.col("until") > wm, F.lit(True))})
            .drop("__ready"))


def outcome_step(key: str, ts: str, is_create: str, is_pay: str, within: str, grace: str) -> Step:
    """SEQ-3: decided once the watermark passes the later of create and pay; a
    lone create at create + within + ``grace``, a lone pay at pay + ``grace``
    (how long the other side may still arrive).  An order whose rows have no
    time at all is reported at the flush."""
    within_us, grace_us = duration_micros(within), duration_micros(grace)

    def step(due, old, wm):
        rows = _first_times(due, old, key, ts, is_create, is_pay)
        c, p = epoch_micros(F.col("create_ts")), epoch_micros(F.col("pay_ts"))
        flush = F.unix_micros(F.lit(SENTINEL_TS).cast("timestamp"))
        at = (F.when(c.isNotNull() & p.isNotNull(), F.greatest(c, p)).when(c.isNotNull(), c + F.lit(within_us + grace_us))
              .when(p.isNotNull(), p + F.lit(grace_us)).otherwise(flush))
        msg = (F.when(p < c + F.lit(within_us), F.lit(MSG_PAYED)).when(c.isNotNull() & p.isNotNull(), F.lit(MSG_PAYED_LATE))
               .when(c.isNotNull(), F.lit(MSG_ORDER_TIMEOUT)).otherwise(F.lit(MSG_PAY_NO_CREATE)))
        tag = F.when(msg == MSG_PAYED, F.lit("payed")).otherwise(F.lit("timeout"))
        return _decided(rows, wm, at, grace, F.lit(True), result_msg=msg, tag=tag)
    return step


def deadline_step(key: str, ts: str, is_create: str, is_pay: str, within: str, keep: str) -> Step:
    """SEQ-4: decided just after create + within."""
    within_us = duration_micros(within)

    def step(due, old, wm):
        rows = _first_times(due, old, key, ts, is_create, is_pay)
        c, p = epoch_micros(F.col("create_ts")), epoch_micros(F.col("pay_ts"))
        in_time = p <= c + F.lit(within_us)
        msg = F.when(in_time, F.lit(MSG_DEADLINE_PAYED)).otherwise(F.lit(MSG_ORDER_TIMEOUT))
        # a row that is not decided yet keeps its pay
        pay = F.when(_flag(in_time) | ~F.col("__ready"), F.col("pay_ts"))
        return _decided(rows, wm, c + F.lit(within_us + 1), keep, p.isNull() | (p >= c), result_msg=msg, pay_ts=pay)
    return step


# ------------------------------------------------------------ two-sided records
def two_sides(pays: DataFrame, receipts: DataFrame, tx_col: str, pay_ts: str, receipt_ts: str) -> DataFrame:
    """Both streams as one: ts, tx, side (0 pay, 1 receipt) and the record in ``p`` or ``r``."""
    kinds = [T.StructType([T.StructField(c, df.schema[c].dataType) for c in df.columns if c != tx_col])
             for df in (pays, receipts)]

    def side(df, ts, number):
        me = F.struct(*[F.col(c).alias(c) for c in df.columns if c != tx_col])
        p, r = (F.lit(None).cast(kind) if k != number else me for k, kind in enumerate(kinds))
        return df.select(F.col(ts).alias("ts"), F.col(tx_col).alias("tx"), F.lit(number).alias("side"),
                         p.alias("p"), r.alias("r"))

    return side(pays, pay_ts, 0).unionByName(side(receipts, receipt_ts, 1))


def reconcile_once_step(tolerance: str, pay_ts: str, receipt_ts: str, pay_seq: str, receipt_seq: str) -> Step:
    """JOIN-1, each record once, over ``two_sides``: the open record of an id,
    which is its last one if that is unmatched and not too old, is carried."""
    tol_us = duration_micros(tolerance)

    def step(due, old, wm):
        rows = _plus(due.select("tx", "p", "r"), old)
        pays = rows.filter(F.col("p").isNotNull()).select("tx", "p.*")
        receipts = rows.filter(F.col("r").isNotNull()).select("tx", "r.*")
        pay_cols, rcp_cols = pays.columns[1:], receipts.columns[1:]
        once = reconcile_once(pays, receipts, tolerance, "tx", pay_ts, receipt_ts, pay_seq, receipt_seq)
        # the later record of a row, by the operator's order: time, pays first, number
        by_receipt = F.col("tag") != TAG_UNMATCHED_PAY
        by_receipt = by_receipt & ((F.col("tag") == TAG_UNMATCHED_RECEIPT) | (F.col(receipt_ts) >= F.col(pay_ts)))
        last = F.struct(F.greatest(pay_ts, receipt_ts), by_receipt,
                        F.when(by_receipt, F.col(receipt_seq)).otherwise(F.col(pay_seq)),
                        F.when(by_receipt, F.xxhash64(*receipts.columns)).otherwise(F.xxhash64(*pays.columns)),
                        F.col("tag") != TAG_MATCHED)     # of equal records the last one is open
        at = F.when(F.col("tag") != TAG_MATCHED, epoch_micros(F.coalesce(pay_ts, receipt_ts)))
        near = F.col("tx").isNotNull() & _flag(at + F.lit(tol_us) >= wm)
        newest = F.row_number().over(Window.partitionBy(
            "tx", F.when(F.col("tx").isNull(), F.xxhash64(*once.columns))).orderBy(last.desc()))
        waits = (newest == 1) & near
        p, r = (F.struct(*[F.col(c).alias(c) for c in cols]) for cols in (pay_cols, rcp_cols))
        return once.select("tx", F.when(F.col("tag") != TAG_UNMATCHED_RECEIPT, p).alias("p"),
                           F.when(F.col("tag") != TAG_UNMATCHED_PAY, r).alias("r"), "tag",
                           (~waits).alias("__emit"), waits.alias("__carry"))
    return step


def reconcile_step(tolerance: str) -> Step:
    """JOIN-1 over ``two_sides``: every pair within the tolerance comes out in
    the epoch of its later record.  Records are carried, with a note whether they
    were matched, until the watermark is past them by the tolerance; those that
    were not come out alone then."""
    tol_us = duration_micros(tolerance)

    def step(due, old, wm):
        rows = due.select("ts", "tx", "side", "p", "r").withColumns({"__old": F.lit(False), "__met": F.lit(False)})
        if old is not None:
            rows = rows.unionByName(old.select("ts", "tx", "side", "p", "r", "__met").withColumn("__old", F.lit(True)))
        rows = rows.withColumn("__us", epoch_micros(F.col("ts")))
        usable = F.col("tx").isNotNull() & F.col("__us").isNotNull()
        alone = F.when(usable, 0).otherwise(F.xxhash64("ts", "tx", "p", "r"))
        # the nearest record of the other side, before or after, says whether there is a partner
        other = {s: F.when(F.col("side") == s, F.col("__us")) for s in (0, 1)}
        keyed = Window.partitionBy("tx", alone)
        so_far = (Window.unboundedPreceding, Window.currentRow)
        up, down = (keyed.orderBy(o).rangeBetween(*so_far) for o in (F.col("__us"), F.col("__us").desc()))
        before = F.when(F.col("side") == 0, F.max(other[1]).over(up)).otherwise(F.max(other[0]).over(up))
        after = F.when(F.col("side") == 0, F.min(other[1]).over(down)).otherwise(F.min(other[0]).over(down))
        met = usable & (_flag(F.col("__us") - before <= tol_us) | _flag(after - F.col("__us") <= tol_us))
        rows = rows.withColumn("__met", F.col("__met") | met)
        near = F.abs(F.col("a.__us") - F.col("b.__us")) <= tol_us
        a, b = (rows.filter(usable & F.col("__met") & (F.col("side") == s)).alias(n) for s, n in ((0, "a"), (1, "b")))
        pairs = (a.join(b, (F.col("a.tx") == F.col("b.tx")) & near & ~(F.col("a.__old") & F.col("b.__old")))
                 .select("a.ts", "a.tx", F.lit(None).cast("int").alias("side"), "a.p", "b.r",
                         F.lit(TAG_MATCHED).alias("tag"), F.lit(True).alias("__met"),
                         F.lit(True).alias("__emit"), F.lit(False).alias("__carry")))
        waits = usable & (F.col("__us") + F.lit(tol_us) >= wm)
        tag = F.when(F.col("side") == 0, F.lit(TAG_UNMATCHED_PAY)).otherwise(F.lit(TAG_UNMATCHED_RECEIPT))
        single = rows.select("ts", "tx", "side", "p", "r", tag.alias("tag"), "__met",
                             (~F.col("__met") & ~waits).alias("__emit"), waits.alias("__carry"))
        return pairs.unionByName(single)
    return step
