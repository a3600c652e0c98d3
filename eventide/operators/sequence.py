"""Event-sequence detection per key (SEQ-1, SEQ-1b, SEQ-1c, SEQ-2, JOIN-2,
FLT-4, WIN-2, SC-13).

The reference uses a pattern library (begin / next / followedBy / within)
and hand-written keyed state.  In batch all of them are ordered scans per
key, built on the two-level helpers of :mod:`eventide.plans.ordered`, so a
key with a large share of the events is still spread over many tasks.

* :func:`strict_next`  -- stage A immediately followed by stage B (no event
  of the key in between) with ``B.ts < A.ts + within``.  Event-time order
  ``[ts, seq]`` gives the pattern rule (SEQ-1); arrival order ``[seq]`` gives
  the hand-written rule, where a negative gap also warns (SEQ-1b).
* :func:`followed_by`  -- each A is matched with the first B at or after it
  (other events may come between); matched if the gap is < within,
  otherwise a timeout (SEQ-2).
* :func:`burst_warnings` -- anchored chunks of failures (SEQ-1c).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.time import duration_micros, epoch_micros, interval, time_bucket
from eventide.plans.ordered import keyed_lag, keyed_next_at_or_after, volume_cuts

# Messages of the reference's login and order jobs.
MSG_STRICT = "login fail!"
MSG_ARRIVAL = "login fail in 2 seconds."
MSG_BURST_PREFIX = "login fail in 2 seconds for "
MSG_BURST_SUFFIX = " times"
MSG_PAYED = "payed successfully"
MSG_TIMEOUT = "timeout"


def _seq_bucket(seq: str, width: int) -> Column:
    width = F.lit(width).cast("long")
    return F.call_function("div", F.col(seq) - F.pmod(F.col(seq), width), width)


def _by_time(d: DataFrame, keys: list, ts: str, bucket: str | None, hot_rows: int | None):
    return time_bucket(ts, bucket) if bucket else volume_cuts(d, keys, epoch_micros(ts), hot_rows)


def strict_next(df: DataFrame, keys: Sequence[str], ts: str, first: Column, then: Column,
                within: str, order: Sequence[str] | None = None, seq: str | None = None,
                bucket: str | None = None, seq_bucket: int | None = None,
                msg: str = MSG_STRICT, hot_rows: int | None = None) -> DataFrame:
    """Pairs (A, B) where B is the next event of the key after A.

    ``order`` defaults to event time ``[ts, seq]``, or is arrival order (SEQ-1b).
    Keys with more than ``hot_rows`` rows are cut by volume, unless fixed
    buckets (``bucket`` of time, ``seq_bucket`` of arrival) are asked for.
    Output: keys, first_ts, last_ts, msg.
    """
    keys = list(keys)
    order = list(order) if order else [ts] + ([seq] if seq else [])
    d = df.select(*keys, *dict.fromkeys([ts, *order]), first.alias("__a"), then.alias("__b"))
    if order[0] == ts:
        b = time_bucket(ts, bucket) if bucket else volume_cuts(d, keys, epoch_micros(ts), hot_rows)
    else:
        b = _seq_bucket(order[0], seq_bucket) if seq_bucket else volume_cuts(
            d, keys, F.col(order[0]).cast("long"), hot_rows)
    lagged = keyed_lag(d, keys, order, b, values=[ts, "__a"], prefix="__prev_")
    hit = (F.col("__b") & F.coalesce(F.col("__prev___a"), F.lit(False))
           & (F.col(ts) < F.col(f"__prev_{ts}") + interval(within)))
    return lagged.filter(hit).select(*keys, F.col(f"__prev_{ts}").alias("first_ts"),
                                     F.col(ts).alias("last_ts"), F.lit(msg).alias("msg"))


def followed_by(df: DataFrame, keys: Sequence[str], ts: str, first: Column, then: Column,
                within: str, bucket: str | None = None, matched_msg: str = MSG_PAYED,
                timeout_msg: str = MSG_TIMEOUT, hot_rows: int | None = None) -> DataFrame:
    """One row per A event: keys, start_ts, match_ts (NULL on timeout),
    result_msg, tag (``matched`` / ``timeout``).  The A and B predicates are
    meant to be disjoint; an event satisfying both would count as its own
    B."""
    keys = list(keys)
    d = df.select(*keys, ts, first.alias("__a"), then.alias("__b"))
    nxt = keyed_next_at_or_after(d, keys, ts, _by_time(d, keys, ts, bucket, hot_rows), F.col("__b"), ts, "__next")
    ok = F.col("__next").isNotNull() & (F.col("__next") < F.col(ts) + interval(within))
    return (nxt.filter(F.col("__a"))
            .select(*keys, F.col(ts).alias("start_ts"),
                    F.when(ok, F.col("__next")).alias("match_ts"),
                    F.when(ok, F.lit(matched_msg)).otherwise(F.lit(timeout_msg)).alias("result_msg"),
                    F.when(ok, F.lit("matched")).otherwise(F.lit("timeout")).alias("tag")))


def _fold_runs(batches, keys: list, within_us: int, min_count: int):
    """mapInPandas body: rows arrive sorted by (keys, __end, __t).  The chunk
    still open at the end of an Arrow batch is carried into the next one as
    three numbers, so memory is one batch however long a run is."""
    open_run, chunk = None, None        # (keys, end) and [first, last, n]

    for pdf in batches:
        if pdf.empty:
            continue
        key_cols = [pdf[k].tolist() for k in keys]
        end = pdf["__end"].tolist()
        t = pdf["__t"].to_numpy(dtype=np.int64)
        same = np.ones(len(t), dtype=bool)
        for col in [*(pdf[k] for k in keys), pdf["__end"]]:
            before = col.shift()
            same &= ((col == before) | (col.isna() & before.isna())).to_numpy(dtype=bool)
        same[0] = False
        starts = np.flatnonzero(~same)
        rows = []

        def close():
            run_keys, run_end = open_run
            # the chunk's timer fires before the success that would drop it
            if chunk[2] >= min_count and (run_end is None or run_end > chunk[0] + within_us):
                rows.append((*run_keys, *chunk))

        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(t)]):
            run = (tuple(_key(c[a]) for c in key_cols),
                   None if pd.isna(end[a]) else int(end[a]))
            if open_run is not None and run != open_run:
                close()
                chunk = None
            open_run, i = run, a
            while i < b:
                if chunk is not None and t[i] > chunk[0] + within_us:
                    close()
                    chunk = None
                first = int(t[i]) if chunk is None else chunk[0]
                j = i + int(np.searchsorted(t[i:b], first + within_us, side="right"))
                chunk = [first, int(t[j - 1]), (0 if chunk is None else chunk[2]) + j - i]
                i = j
        if rows:
            yield _chunk_rows(rows, keys)
    if open_run is not None:
        run_keys, run_end = open_run
        if chunk[2] >= min_count and (run_end is None or run_end > chunk[0] + within_us):
            yield _chunk_rows([(*run_keys, *chunk)], keys)


def _key(v):
    """A key as it was: pandas turns whole numbers beside a NULL into floats."""
    if pd.isna(v):
        return None
    return int(v) if isinstance(v, float) and v.is_integer() else v


def _chunk_rows(rows: list, keys: list) -> pd.DataFrame:
    """Keys stay objects: a NULL number must not turn into a float."""
    cols = list(zip(*rows))
    out = {k: pd.Series(c, dtype=object) for k, c in zip(keys, cols)}
    out.update({n: pd.Series(c, dtype="int64") for n, c in zip(("__first", "__last", "__n"), cols[len(keys):])})
    return pd.DataFrame(out)


def burst_warnings(df: DataFrame, keys: Sequence[str], ts: str, is_fail: Column, within: str,
                   min_count: int = 2, bucket: str | None = None,
                   msg_prefix: str = MSG_BURST_PREFIX, msg_suffix: str = MSG_BURST_SUFFIX,
                   hot_rows: int | None = None) -> DataFrame:
    """SEQ-1c: a first failure opens a chunk of length ``within`` (a failure
    exactly at the end is in); later failures join it; a success discards the
    open chunk; when the chunk's time is up it warns if it holds
    >= ``min_count`` failures.  The next failure opens a new chunk.

    Failures are grouped into runs that end at the key's next success (a
    two-level forward scan finds it).  Runs are hash-partitioned on
    (key, run end) -- a hot key's runs spread over tasks -- sorted inside
    each partition, and chunked greedily by a ``mapInPandas`` fold that holds
    one Arrow batch and the three numbers of the chunk that is open.
    """
    chunks = burst_chunks(df, keys, ts, is_fail, within, min_count, bucket, hot_rows)
    return chunks.select(*keys, "first_ts", "last_ts", burst_warning("n", msg_prefix, msg_suffix).alias("msg"))


def burst_warning(n: str, prefix: str = MSG_BURST_PREFIX, suffix: str = MSG_BURST_SUFFIX) -> Column:
    return F.concat(F.lit(prefix), F.col(n).cast("string"), F.lit(suffix))


def burst_chunks(df: DataFrame, keys: Sequence[str], ts: str, is_fail: Column, within: str, min_count: int,
                 bucket: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """The chunks behind ``burst_warnings``: keys, first_ts, last_ts, n."""
    keys = list(keys)
    d = df.select(*keys, ts, is_fail.alias("__fail"))
    nxt = keyed_next_at_or_after(d, keys, ts, _by_time(d, keys, ts, bucket, hot_rows), ~F.col("__fail"), ts,
                                 "__reset_ts")
    fails = nxt.filter(F.col("__fail")).select(
        *keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("__t"),
        F.unix_micros(F.col("__reset_ts").cast("timestamp")).alias("__end"))
    key_fields = [f for f in fails.schema.fields if f.name in keys]
    out_schema = T.StructType(key_fields + [
        T.StructField("__first", T.LongType()), T.StructField("__last", T.LongType()),
        T.StructField("__n", T.LongType())])
    within_us = duration_micros(within)
    ordered = (fails.repartition(*keys, "__end")
               .sortWithinPartitions(*keys, "__end", "__t"))
    chunks = ordered.mapInPandas(
        lambda it: _fold_runs(it, keys, within_us, min_count), out_schema)
    ts_type = df.schema[ts].dataType
    return chunks.select(*keys, F.timestamp_micros("__first").cast(ts_type).alias("first_ts"),
                         F.timestamp_micros("__last").cast(ts_type).alias("last_ts"), F.col("__n").alias("n"))


def match_sequence(df: DataFrame, keys: Sequence[str], ts: str,
                   stages: Sequence[tuple[str, Column]], within: str,
                   contiguity: str = "strict", order_by: Sequence[str] | None = None,
                   seq: str | None = None, with_timeout: bool = True, **kwargs) -> DataFrame:
    """Two-stage pattern ``begin(A).next(B)`` (strict) or
    ``begin(A).followedBy(B)`` (relaxed), both ``within`` a duration.

    strict  -> one row per matched pair (keys, first_ts, last_ts, msg);
    relaxed -> one row per A (keys, start_ts, match_ts, result_msg, tag);
               ``with_timeout=False`` keeps matched rows only.

    More stages go to ``match_pattern`` (its columns; strict: matched rows only).
    """
    if contiguity not in ("strict", "relaxed"):
        raise ValueError("contiguity is 'strict' or 'relaxed'")
    if len(stages) != 2:
        from eventide.operators.pattern import Stage, match_pattern

        strict = contiguity == "strict"
        parts = [Stage(name, when, strict and k > 0) for k, (name, when) in enumerate(stages)]
        out = match_pattern(df, keys, ts, parts, within, seq=seq, **kwargs)
        return out.filter(F.col("tag") == "matched") if strict or not with_timeout else out
    (_, first), (_, then) = stages
    if contiguity == "strict":
        return strict_next(df, keys, ts, first, then, within, order=order_by, seq=seq, **kwargs)
    out = followed_by(df, keys, ts, first, then, within, **kwargs)
    return out if with_timeout else out.filter(F.col("tag") == "matched")
