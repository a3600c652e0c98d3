"""Keyed, ordered scans that stay parallel when one key is hot.

A plain ``Window.partitionBy(key)`` is the best plan while every key fits a
task: one exchange, one sort.  If one user (or ad, or order) holds a third of
the data, it sends a third of the data to one task.  So the rows per key are
measured first (``volume_cuts``, one aggregate of the keys): where no key is
hot, the helpers here are plain windows.  A hot key is cut into *buckets* of
about equal numbers of rows, at quantiles of the order, however its rows are
spread over time, and the work goes on two levels:

1. a summary of the hot keys with one row per ``(key, bucket)`` (last row, row
   count, minimum) is aggregated map-side and carried from bucket to bucket;
2. the carried rows are united with the data, sorted before it, and one
   window over ``(key, bucket)`` does the per-row work (lag, running position,
   forward minimum).  Full rows are shuffled once, and nothing but the table
   of cuts, whose size is bounded, is joined.

Results are exact and independent of the buckets.  A ``Column`` that does not
decrease with the order (e.g. a time bucket) can be given instead of cuts.  A
NULL key is a group of its own.

``row_number_within`` is the fully general exact ``row_number()`` for an
order that is not time-like (e.g. a ranking by count): it range-partitions
on ``(group, order)`` so a group can span many tasks, and adds per-partition
offsets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import checkpoint_root

#: A key with more rows than this, and than a HOT_KEYS-th of all, is cut.
HOT_ROWS = 1_000_000
#: So at most that many keys are hot, each with CUTS - 1 cuts: 2 MB of cuts at any data size.
HOT_KEYS, CUTS = 1000, 256

_B, _ROW, _HOT = "__bucket", "__is_row", "__hot"


@dataclass(frozen=True)
class Cuts:
    """Where hot keys are cut: their values, and ascending positions."""

    keys: tuple
    position: Column
    table: DataFrame

    def number(self, df: DataFrame) -> DataFrame:
        """Add the bucket (0 for a key that is not hot) and whether the key is hot."""
        cut = F.broadcast(self.table)       # HOT_KEYS * CUTS numbers at most
        same = reduce(lambda x, y: x & y, [df[k].eqNullSafe(cut[f"__cut_{k}"]) for k in self.keys])
        below = F.filter("__cuts", lambda c: c <= self.position)
        return (df.join(cut, same, "left")
                .withColumn(_HOT, F.col("__cuts").isNotNull())
                .withColumn(_B, F.when(F.col(_HOT), F.size(below)).otherwise(0))
                .select(*df.columns, _HOT, _B))


def volume_cuts(df: DataFrame, keys: Sequence[str], position: Column, hot_rows: int | None = None,
                parts: int = CUTS) -> Cuts | None:
    """Cut every hot key into ``parts`` buckets of about equal numbers of rows
    at quantiles of ``position`` (a whole number that does not decrease with
    the order; rows that are equal in it stay together).  None where no key is
    hot.  Runs an aggregate of the keys, and a second one for hot keys only."""
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    most, total = counts.agg(F.max("__n"), F.sum("__n")).first()
    limit = max(HOT_ROWS if hot_rows is None else hot_rows, (total or 0) // HOT_KEYS)
    if (most or 0) <= limit:
        return None
    names = [f"__cut_{k}" for k in keys]
    hot = counts.filter(F.col("__n") > limit).select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    same = reduce(lambda x, y: x & y, [df[k].eqNullSafe(hot[n]) for k, n in zip(keys, names)])
    share = [i / parts for i in range(1, parts)]
    cuts = (df.join(F.broadcast(hot), same).groupBy(*names)
            .agg(F.array_sort(F.array_distinct(F.percentile_approx(position, share, 100 * parts))).alias("__cuts")))
    # bounded: less than HOT_KEYS rows (or, with a small hot_rows, total / hot_rows)
    rows = [tuple(r) for r in cuts.filter(F.col("__cuts").isNotNull()).collect()]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in cuts.schema.fields])
    return Cuts(tuple(keys), position, df.sparkSession.createDataFrame(rows, schema))


def _bucketed(df: DataFrame, bucket: Column | Cuts) -> DataFrame:
    if isinstance(bucket, Cuts):
        return bucket.number(df)
    return df.withColumn(_HOT, F.lit(True)).withColumn(_B, bucket)


def _with_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Data rows and, before them, the carried row of each (key, bucket).
    Columns that one side lacks are NULL there."""
    return (rows.withColumn(_ROW, F.lit(True))
            .unionByName(carry.withColumn(_ROW, F.lit(False)), allowMissingColumns=True))


def keyed_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | Cuts | None,
              values: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Add ``prefix+v`` = value of ``v`` on the previous row of the same key,
    in ascending ``order`` (NULL on a key's first row)."""
    keys, order = list(keys), list(order)
    d = df.withColumn("__v", F.struct(*[F.col(v).alias(v) for v in values]))
    if bucket is None:
        out = d.withColumn("__prev", F.lag("__v").over(Window.partitionBy(*keys).orderBy(*order)))
    else:
        d = _bucketed(d, bucket)
        last = (d.filter(_HOT).groupBy(*keys, _B)
                .agg(F.max_by("__v", F.struct(*[F.col(o) for o in order])).alias("__v")))
        carry = (last.select(*keys, _B, F.lag("__v").over(Window.partitionBy(*keys).orderBy(_B)).alias("__v"))
                 .filter(F.col("__v").isNotNull()))
        w = Window.partitionBy(*keys, _B).orderBy(_ROW, *order)
        out = _with_carry(d, carry).withColumn("__prev", F.lag("__v").over(w)).filter(_ROW)
    return out.select(*[F.col(c) for c in df.columns],
                      *[F.col("__prev")[v].alias(prefix + v) for v in values])


def keyed_next_at_or_after(df: DataFrame, keys: Sequence[str], ts: str, bucket: Column | Cuts | None,
                           when: Column, value: str, out_col: str) -> DataFrame:
    """Add ``out_col`` = min(``value``) over rows of the same key with
    ``ts >= this row's ts`` and ``when`` true (same-time rows included).

    With ``value = ts`` this is "time of the first matching event at or after
    this one", the core of a relaxed followed-by match.  ``bucket`` must be a
    non-decreasing function of ``ts``.
    """
    keys = list(keys)
    d = df.withColumn("__cand", F.when(when, F.col(value)))
    # Descending order + growing frame = suffix minimum in one pass
    if bucket is None:
        suffix = (Window.partitionBy(*keys).orderBy(F.col(ts).desc())
                  .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        out = d.withColumn("__next", F.min("__cand").over(suffix))
    else:
        d = _bucketed(d, bucket)
        per_bucket = d.filter(_HOT).groupBy(*keys, _B).agg(F.min("__cand").alias("__cand"))
        later = (Window.partitionBy(*keys).orderBy(F.col(_B).desc())
                 .rowsBetween(Window.unboundedPreceding, -1))
        carry = (per_bucket.select(*keys, _B, F.min("__cand").over(later).alias("__cand"))
                 .filter(F.col("__cand").isNotNull()))
        # the carried minimum of all later buckets comes first
        suffix = (Window.partitionBy(*keys, _B).orderBy(F.col(_ROW), F.col(ts).desc())
                  .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        out = _with_carry(d, carry).withColumn("__next", F.min("__cand").over(suffix)).filter(_ROW)
    return out.select(*[F.col(c) for c in df.columns], F.col("__next").alias(out_col))


def keyed_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | Cuts | None,
                   out_col: str, limit: int | None = None) -> DataFrame:
    """Add ``out_col`` = 1-based position of the row within its key in
    ``order`` (``row_number``).  With ``limit``, only rows at positions
    ``<= limit`` are returned, and each task keeps at most that many rows of a
    (key, bucket) before the shuffle."""
    keys, order = list(keys), list(order)
    if bucket is None:
        out = df.withColumn(out_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        if limit is not None:
            out = out.filter(F.col(out_col) <= limit)
        return out.withColumn(out_col, F.col(out_col).cast("long"))
    d = _bucketed(df, bucket)
    counts = d.filter(_HOT).groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("__n"))
    before = (Window.partitionBy(*keys).orderBy(_B)
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = (counts.select(*keys, _B, F.sum("__n").over(before).alias("__off"))
             .filter(F.col("__off").isNotNull()))
    w = Window.partitionBy(*keys, _B).orderBy(_ROW, *order)
    # the carried row, where there is one, is the first
    out = (_with_carry(d, carry).withColumn("__rn", F.row_number().over(w))
           .withColumn("__off", F.max(F.col("__off") - 1).over(w.rowsBetween(Window.unboundedPreceding, 0))))
    if limit is not None:
        out = out.filter(F.col("__rn") <= limit + 1)
    out = out.filter(_ROW).withColumn(out_col, (F.coalesce("__off", F.lit(0)) + F.col("__rn")).cast("long"))
    if limit is not None:
        out = out.filter(F.col(out_col) <= limit)
    return out.select(*[F.col(c) for c in df.columns], out_col)


def row_number_within(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                      out_col: str, num_partitions: int | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by group order by order)`` where
    one group may be larger than a task.  ``order`` must make rows unique
    within a group (end it with a key).

    Rows are range-partitioned on (group, order) and sorted, so each task
    holds a contiguous slice of the global order; a row's number is its index
    in the slice plus the number of rows of its group in earlier slices.  The
    per-(group, slice) offset table has at most #groups + #slices rows; AQE
    broadcasts it when it is small.  The numbered slices are checkpointed,
    which costs one write of the input.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    p = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(g).asc() for g in group] + list(order)
    r = (df.repartitionByRange(p, *sort).sortWithinPartitions(*sort)
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__local", F.monotonically_increasing_id()
                     - F.spark_partition_id().cast("long") * F.lit(1 << 33)))
    # Range bounds come from sampling a shuffled input, which is not
    # repeatable; write the numbered slices once (reliable checkpoint in the
    # shared checkpoint folder) so the offsets and the rows agree, and so a
    # lost executor re-reads them instead of re-sampling.
    r = r.checkpoint(eager=True)
    stats = r.groupBy(*group, "__pid").agg(F.min("__local").alias("__first"),
                                           F.count(F.lit(1)).alias("__n"))
    before = (Window.partitionBy(*group).orderBy("__pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    stats = stats.select(*group, "__pid", "__first",
                         F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    out = r.join(stats, on=[*group, "__pid"], how="inner")
    return out.select(*[F.col(c) for c in df.columns],
                      (F.col("__before") + F.col("__local") - F.col("__first") + 1)
                      .cast("long").alias(out_col))
