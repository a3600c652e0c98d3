import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from eventide.operators import (bitmap_counts, merge_bitmaps, uv_bitmap, uv_bloom, uv_exact,
                                uv_hll, window_bitmaps)
from eventide.sinks import BitmapStore
from tests.fixtures import at


def _visits(spark, n_users=3000, n=12000, seed=5):
    rnd = random.Random(seed)
    rows = [(rnd.randint(1, n_users), at(rnd.randint(0, 7199))) for _ in range(n)]
    return spark.createDataFrame(rows, "user_id long, ts timestamp"), rows


def test_exact_and_bitmap_agree_with_python(spark):
    df, rows = _visits(spark)
    want = {}
    for u, t in rows:
        end = t.replace(minute=0, second=0) + timedelta(hours=1)
        want.setdefault(end, set()).add(u)
    exact = {r.window_end: r.uv_count for r in uv_exact(df, size="1 hour").collect()}
    assert exact == {k: len(v) for k, v in want.items()}
    bitmap = {r.window_end: r.uv_count for r in uv_bitmap(df, size="1 hour").collect()}
    assert bitmap == exact   # no hash collisions among these ids


def test_bloom_and_hll_estimates_are_close(spark):
    df, _ = _visits(spark, n_users=8000, n=30000)
    exact = {r.window_end: r.uv_count for r in uv_exact(df, size="2 hours").collect()}
    bloom = {r.window_end: r.uv_estimate for r in uv_bloom(df, size="2 hours").collect()}
    hll = {r.window_end: r.uv_estimate for r in uv_hll(df, size="2 hours").collect()}
    for w, n in exact.items():
        assert abs(bloom[w] - n) / n < 0.02
        assert abs(hll[w] - n) / n < 0.03


def test_bloom_is_sized_for_the_fullest_window(spark):
    for n in (20_000, 400_000):
        df = spark.range(n).select(F.col("id").alias("user_id"), F.lit(at(5)).alias("ts"))
        got = uv_bloom(df, size="1 hour").first().uv_estimate
        assert abs(got - n) / n < 0.03


@pytest.mark.parametrize("name,n", [("uv_bloom", 1_500_000), ("uv_bloom_stream", 400_000)])
def test_registered_bloom_queries_hold_full_windows(spark, tmp_path, name, n):
    import __spark_entry__ as entry

    spark.range(n).select(F.col("id").alias("event_id"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"),
                          F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, 0, 0, id % 80000)").alias("ts")) \
        .write.parquet(f"{tmp_path}/events.parquet")
    got = entry.queries()[name](spark, str(tmp_path)).collect()
    assert len(got) == 1 and abs(got[0].uv_estimate - n) / n < 0.03


def test_a_full_bloom_filter_is_an_error(spark):
    df = spark.range(400_000).select(F.col("id").alias("user_id"), F.lit(at(5)).alias("ts"))
    with pytest.raises(Exception, match="is full"):
        uv_bloom(df, size="1 hour", expected_insertions=1000).collect()


def test_bitmaps_merge_across_runs(spark, tmp_path):
    df, _ = _visits(spark)
    half1 = df.filter(F.col("ts") < at(3600))
    half2 = df.filter(F.col("ts") >= at(1800))            # overlapping runs
    merged = bitmap_counts(merge_bitmaps(window_bitmaps(half1, size="1 hour"),
                                         window_bitmaps(half2, size="1 hour")))
    full = uv_bitmap(df, size="1 hour")
    assert sorted(merged.collect()) == sorted(full.collect())

    store = BitmapStore(spark, str(tmp_path / "uv_store"))
    assert store.merge(window_bitmaps(half1, size="1 hour")) == 0
    assert store.merge(window_bitmaps(half2, size="1 hour")) == 1
    assert sorted(store.counts().collect()) == sorted(full.collect())


def test_a_streamed_store_merges_a_replayed_batch_once(spark, tmp_path):
    """The third batch fails after its merge, before the stream's commit; the
    restarted stream replays it."""
    from eventide.streaming.runner import replay_parts
    from eventide.streaming.uv_store import feed_bitmap_store

    df, _ = _visits(spark)
    stream = replay_parts(df)
    merges = []

    class Failing(BitmapStore):
        def merge(self, bitmaps, batch=None):
            done = batch is not None and self.merged(*batch)
            version = super().merge(bitmaps, batch)
            merges.append((batch[1], done))
            if len(merges) == 3:
                raise RuntimeError("lost after the merge")
            return version

    store = Failing(spark, str(tmp_path / "store"))
    query = feed_bitmap_store(stream, store, "visits", str(tmp_path / "ckpt"))
    with pytest.raises(Exception):
        query.awaitTermination()
    feed_bitmap_store(stream, store, "visits", str(tmp_path / "ckpt")).awaitTermination()
    assert merges == [(0, False), (1, False), (2, False), (2, True), (3, False)]
    assert sorted(store.counts().collect()) == sorted(uv_bitmap(df, size="1 hour").collect())


def test_merging_parts_with_equal_buckets_and_new_days(spark, tmp_path):
    rows = [(u, at(d * 86400 + u)) for d in (0, 1) for u in range(200)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp")
    parts = window_bitmaps(df.filter("user_id < 120"), size="1 hour").unionByName(
        window_bitmaps(df.filter("user_id >= 80"), size="1 hour"))
    store = BitmapStore(spark, str(tmp_path / "store"))
    store.merge(parts.filter(F.col("window_end") < F.lit(at(86400))))      # buckets twice, first day only
    store.merge(parts)                                                     # first day again, second day new
    assert sorted(store.counts().collect()) == sorted(uv_bitmap(df, size="1 hour").collect())
    assert store.merge(parts, batch=("s", 0)) == 2 and store.merge(parts, batch=("s", 0)) == 2
