"""Distinct visitors per window (UV-1, UV-2, UV-3, SNK-4).

* ``uv_exact``   -- ``count(DISTINCT user)``; Spark plans it as a two-level
  aggregate (distinct on (window, user), then count), so no window's user set
  sits in one task.
* ``uv_bitmap``  -- the reference's hash bitmap: polynomial hash of the user
  text masked to 2^29 bits, stored as Spark bitmaps of 32,768 bits per
  (window, bucket); counts = set bits.  Bitmaps are mergeable across runs
  (``bitmap_or_agg``), which is what the reference's external store was for.
* ``uv_bloom``   -- Bloom-filter estimate: k positions per user in an m-bit
  filter sized for (expected insertions, fpp), kept as Spark bitmaps and
  merged by OR; per window the number X of set bits gives
  n = -(m/k) ln(1 - X/m).  Order-free and mergeable, unlike the reference's
  sequential "count if not seen" (which can only undercount).  Unless a size
  is given, the filter is sized for the fullest window of the data; a window
  that fills every bit of its filter is an error, not a missing number.

Bitmaps are built from distinct (window, hash) pairs: the shuffle then carries
16 bytes per visitor, not a 4 KB bitmap per visitor and task.
* ``uv_hll``     -- ``approx_count_distinct`` (HyperLogLog++), the cheapest.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.hashing import (bloom_estimate, bloom_positions, bloom_size,
                                        poly_hash)
from eventide.functions.time import event_window

# The reference's preset, 10,000 expected insertions, 1 % fpp.
BLOOM_EXPECTED_INSERTIONS = 10_000
BLOOM_FPP = 0.01


def uv_exact(df: DataFrame, user_col: str = "user_id", ts: str = "ts", size: str = "1 hour",
             slide: str | None = None, out_col: str = "uv_count") -> DataFrame:
    return (df.groupBy(event_window(ts, size, slide).alias("window"))
            .agg(F.countDistinct(user_col).alias(out_col))
            .select(F.col("window.end").alias("window_end"), out_col))


def uv_hll(df: DataFrame, user_col: str = "user_id", ts: str = "ts", size: str = "1 hour",
           slide: str | None = None, rsd: float = 0.01, out_col: str = "uv_estimate") -> DataFrame:
    return (df.groupBy(event_window(ts, size, slide).alias("window"))
            .agg(F.approx_count_distinct(user_col, rsd).alias(out_col))
            .select(F.col("window.end").alias("window_end"), out_col))


def window_bitmaps(df: DataFrame, user_col: str = "user_id", ts: str = "ts",
                   size: str = "1 hour", slide: str | None = None, bits: int = 29) -> DataFrame:
    """(window_end, bucket, bitmap) rows: the mergeable UV-3 state.  ``bits``
    of the hash are used; with n visitors in a window about n / 2^(bits + 1) of
    them are lost to collisions."""
    return (df.select(event_window(ts, size, slide).end.alias("window_end"),
                      poly_hash(F.col(user_col), bits=bits).alias("h")).distinct()
            .select("window_end", F.bitmap_bucket_number("h").alias("bucket"),
                    F.bitmap_bit_position("h").alias("pos"))
            .groupBy("window_end", "bucket")
            .agg(F.bitmap_construct_agg("pos").alias("bitmap")))


def merge_bitmaps(*parts: DataFrame) -> DataFrame:
    """OR together bitmap tables from several runs (SNK-4 merge)."""
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.groupBy("window_end", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def bitmap_counts(bitmaps: DataFrame, out_col: str = "uv_count") -> DataFrame:
    return (bitmaps.groupBy("window_end")
            .agg(F.sum(F.bitmap_count("bitmap")).cast("long").alias(out_col)))


def uv_bitmap(df: DataFrame, user_col: str = "user_id", ts: str = "ts", size: str = "1 hour",
              slide: str | None = None, out_col: str = "uv_count", bits: int = 29) -> DataFrame:
    return bitmap_counts(window_bitmaps(df, user_col, ts, size, slide, bits), out_col)


def bloom_insertions(df: DataFrame, user_col: str = "user_id", ts: str = "ts", size: str = "1 hour",
                     slide: str | None = None) -> int:
    """Visitors that a filter of each window must hold: the fullest window's
    number by a sketch (one small aggregate, no shuffle of visitors), with five
    standard errors to spare, rounded up to a multiple of the preset."""
    rsd = 0.01
    seen = df.groupBy(event_window(ts, size, slide).alias("w")).agg(F.approx_count_distinct(user_col, rsd).alias("n"))
    fullest = (seen.agg(F.max("n")).first()[0] or 0) * (1 + 5 * rsd)
    return BLOOM_EXPECTED_INSERTIONS * max(1, math.ceil(fullest / BLOOM_EXPECTED_INSERTIONS))


def uv_bloom(df: DataFrame, user_col: str = "user_id", ts: str = "ts", size: str = "1 hour",
             slide: str | None = None, expected_insertions: int | None = None,
             fpp: float = BLOOM_FPP, out_col: str = "uv_estimate") -> DataFrame:
    """``expected_insertions=None`` sizes the filter for the fullest window
    (one small aggregate over the data beforehand)."""
    seen = df.select(event_window(ts, size, slide).end.alias("window_end"), F.col(user_col).alias("u"))
    if expected_insertions is None:
        expected_insertions = bloom_insertions(df, user_col, ts, size, slide)
    m, k = bloom_size(expected_insertions, fpp)
    # The filter itself is a set of Spark bitmaps (positions + 1 keep values
    # positive).  Visitors are made distinct first, so k rows are exploded per
    # visitor, not per event.
    positions = F.transform(bloom_positions(F.col("u"), m, k), lambda x: x + 1)
    filters = (seen.distinct().select("window_end", F.explode(positions).alias("p"))
               .groupBy("window_end", F.bitmap_bucket_number("p").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")))
    bits = filters.groupBy("window_end").agg(
        F.sum(F.bitmap_count("bits")).cast("long").alias("bits_set"))
    return bits.select("window_end", bloom_estimate(F.col("bits_set"), m, k).alias(out_col))
