"""Event patterns of any number of stages (§2.11: begin / next / followedBy / within).

A pattern is a per-key automaton: an event that fits the first stage starts a
try, which then waits for stage 2, 3, ...  A relaxed stage takes the first later
event that fits it; a strict one takes the next event of the key, and a next
event that does not fit breaks the try.  A try has no choices, so what becomes
of it after stage k depends on the event of stage k alone.  The stages are
therefore computed from the last to the first, each one window function over the
same partitioning and order: one exchange and one sort for all of them.

Hot keys are cut by volume (``plans.ordered``).  A bucket then is a table of
"waiting for stage k -> times found, stage waited for at the bucket's end"; the
tables of a key (``CUTS`` at most) are composed from the last bucket to the
first, and a try that is still waiting at the end of its bucket looks its end up.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import epoch_micros, interval
from eventide.plans.ordered import volume_cuts

_BROKEN = -1


@dataclass(frozen=True)
class Stage:
    """``strict``: must be the very next event of the key after the stage before."""

    name: str
    when: Column
    strict: bool = False


def _state(times: Column, wait: Column | int) -> Column:
    return F.struct(times.alias("times"), (wait if isinstance(wait, Column) else F.lit(wait)).alias("wait"))


def _then(state: Column, after: Column, n: int) -> Column:
    """``state`` carried on by ``after``, the table (from stage 1 on) of what follows."""
    rest = F.get(after, state["wait"] - 1)
    return F.when(state["wait"].between(1, n - 1),
                  _state(F.concat(state["times"], rest["times"]), rest["wait"])).otherwise(state)


def match_pattern(df: DataFrame, keys: Sequence[str], ts: str, stages: Sequence[Stage], within: str,
                  seq: str | None = None, hot_rows: int | None = None) -> DataFrame:
    """One row per event that fits the first stage: keys, ``{name}_ts`` of each
    stage (NULL if not reached in time), ``n_matched`` and ``tag``.

    ``matched``: all stages less than ``within`` after the start; ``broken``: a
    strict stage met another event in that time; ``timeout``: neither.  The order
    is (``ts``, ``seq``); of events equal in it, those that fit the earlier stages
    come first.  A NULL key is a group of its own; rows without a time take no
    part; a stage that is NULL for a row does not fit it; an empty table gives no
    rows.  Keys with more than ``hot_rows`` rows are cut by volume."""
    stages, keys, n = list(stages), list(keys), len(stages)
    if n < 2 or stages[0].strict or len({s.name for s in stages}) < n:
        raise ValueError("a pattern has a first stage and later ones, with names of their own")
    fits = [f"__fit{k}" for k in range(n)]
    d = df.filter(F.col(ts).isNotNull()).select(
        *keys, F.col(ts).alias("__t"), (F.col(seq) if seq else F.lit(0)).alias("__seq"),
        *[F.coalesce(s.when, F.lit(False)).alias(f) for s, f in zip(stages, fits)])
    # equal events: the one that fits an earlier stage comes first
    d = d.withColumn("__late", sum((F.when(F.col(f), 0).otherwise(1 << (n - k)) for k, f in enumerate(fits)), F.lit(0)))
    cuts = volume_cuts(d, keys, epoch_micros("__t"), hot_rows)
    part = list(keys)
    if cuts is not None:
        d, part = cuts.number(d), [*keys, "__bucket"]
    order = ["__t", "__seq", "__late"]
    down = Window.partitionBy(*part).orderBy(*[F.col(c).desc() for c in order])
    later = down.rowsBetween(Window.unboundedPreceding, -1)
    none = F.array().cast(f"array<{df.schema[ts].dataType.simpleString()}>")

    rest = _state(none, n)                              # after the last stage all is found
    for k in range(n - 1, -1, -1):
        found = F.struct(F.struct(*order).alias("at"), _state(F.concat(F.array("__t"), rest["times"]), rest["wait"]).alias("state"))
        d = d.withColumn(f"__v{k}", F.when(F.col(fits[k]), found))
        if k == 0:
            break
        if stages[k].strict:
            d = d.withColumn("__next", F.lag(F.struct("__t", F.col(f"__v{k}.state").alias("state"))).over(down))
            broken = _state(F.array("__next.__t"), _BROKEN)
            rest = F.when(F.col("__next").isNull(), _state(none, k)).otherwise(F.coalesce("__next.state", broken))
        else:
            d = d.withColumn(f"__m{k}", F.min(f"__v{k}").over(later))
            rest = F.coalesce(F.col(f"__m{k}.state"), _state(none, k))
        d = d.withColumn(f"__rest{k}", rest)
        rest = F.col(f"__rest{k}")
    tries = d.filter(fits[0]).select(*part, F.col("__t"), F.col("__v0.state").alias("state"))
    if cuts is not None:
        tries = _across_buckets(d, tries, keys, order, stages, none, n)

    end = F.col("__t") + interval(within)
    in_time = F.filter("state.times", lambda t: t < end)
    broke = (F.col("state.wait") == _BROKEN) & (F.size(in_time) == F.size("state.times"))
    reached = F.when(broke, F.size(in_time) - 1).otherwise(F.size(in_time))
    # a breaking event is no stage, even if it is too late to break anything
    out = tries.select(*keys, in_time.alias("__times"), reached.alias("n_matched"), broke.alias("__broke"))
    return out.select(
        *keys, *[F.when(F.col("n_matched") > k, F.get("__times", F.lit(k))).alias(f"{s.name}_ts") for k, s in enumerate(stages)],
        "n_matched", F.when(F.col("n_matched") == n, "matched").when(F.col("__broke"), "broken").otherwise("timeout").alias("tag"))


def _across_buckets(d: DataFrame, tries: DataFrame, keys: list, order: list, stages: list[Stage], none: Column,
                    n: int) -> DataFrame:
    """``tries`` of the cut keys, carried on through the later buckets."""
    first = F.struct(*order)
    enter = []
    for k in range(1, n):
        if stages[k].strict:
            head = F.min_by(F.struct("__t", F.col(f"__v{k}.state").alias("state")), first)
            enter.append(F.coalesce(head["state"], _state(F.array(head["__t"]), _BROKEN)))
        else:
            enter.append(F.coalesce(F.min(f"__v{k}")["state"], _state(none, k)))
    tables = d.filter("__hot").groupBy(*keys, "__bucket").agg(F.array(*enter).alias("enter"))
    # bounded: CUTS rows a key
    per_key = tables.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct((-F.col("__bucket")).alias("b"), "enter"))).alias("down"))
    start = F.array(*[_state(none, k) for k in range(1, n)])
    empty = F.filter(F.array(F.struct(F.lit(0).alias("b"), start.alias("after"))), lambda x: F.lit(False))
    carried = F.aggregate(
        "down", F.struct(empty.alias("done"), start.alias("after")),
        lambda acc, x: F.struct(
            F.concat(acc["done"], F.array(F.struct((-x["b"]).alias("b"), acc["after"].alias("after")))).alias("done"),
            F.transform(x["enter"], lambda e: _then(e, acc["after"], n)).alias("after")))
    after = per_key.select(*[F.col(k).alias(f"__of_{k}") for k in keys], F.inline(carried["done"]))
    same = reduce(lambda x, y: x & y, [tries[k].eqNullSafe(after[f"__of_{k}"]) for k in keys])
    state = F.when(F.col("after").isNull(), F.col("state")).otherwise(_then(F.col("state"), F.col("after"), n))
    return tries.join(after, same & (F.col("__bucket") == F.col("b")), "left").select(*keys, "__t", state.alias("state"))
