"""The two-level keyed scans must equal a plain per-key scan, for any bucket
width, including when one key holds most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventide.functions.time import time_bucket
from eventide.plans.ordered import (keyed_lag, keyed_next_at_or_after, keyed_position,
                                    row_number_within, volume_cuts)


def _rows(n=400, hot_share=0.6, seed=7):
    rnd = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < hot_share else rnd.randint(1, 12)
        ts = t0 + timedelta(minutes=rnd.randint(0, 60 * 48), seconds=rnd.randint(0, 59))
        rows.append((i, key, ts, rnd.random() < 0.4))
    return rows


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(_rows(), "seq long, k long, ts timestamp, flag boolean")


def _by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        out.setdefault(r[1], []).append(r)
    return out


@pytest.mark.parametrize("width", ["10 minutes", "3 hours", "30 days"])
def test_keyed_lag(data, width):
    got = {r.seq: (r.prev_seq, r.prev_flag) for r in keyed_lag(
        data, ["k"], ["ts", "seq"], time_bucket("ts", width), ["seq", "flag"]).collect()}
    for rows in _by_key(_rows()).values():
        prev = (None, None)
        for r in rows:
            assert got[r[0]] == prev
            prev = (r[0], r[3])


@pytest.mark.parametrize("width", ["10 minutes", "1 day"])
def test_keyed_next_at_or_after(data, width):
    got = {r.seq: r.nxt for r in keyed_next_at_or_after(
        data, ["k"], "ts", time_bucket("ts", width), F.col("flag"), "ts", "nxt").collect()}
    rows = _rows()
    for r in rows:
        cands = [x[2] for x in rows if x[1] == r[1] and x[3] and x[2] >= r[2]]
        assert got[r[0]] == (min(cands) if cands else None)


@pytest.mark.parametrize("limit", [None, 5, 1000])
def test_keyed_position(data, limit):
    got = {r.seq: r.pos for r in keyed_position(
        data, ["k"], ["ts", "seq"], time_bucket("ts", "2 hours"), "pos", limit=limit).collect()}
    want = {}
    for rows in _by_key(_rows()).values():
        for i, r in enumerate(rows, 1):
            if limit is None or i <= limit:
                want[r[0]] = i
    assert got == want


def test_row_number_within_splits_a_hot_group(spark):
    rnd = random.Random(3)
    rows = [(0 if rnd.random() < 0.7 else rnd.randint(1, 5), i, rnd.randint(1, 30))
            for i in range(600)]
    df = spark.createDataFrame(rows, "g long, key long, c long")
    got = {r.key: r.rn for r in row_number_within(
        df, ["g"], [F.col("c").desc(), F.col("key").asc()], "rn", num_partitions=6).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        grp = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        for i, r in enumerate(grp, 1):
            want[r[1]] = i
    assert got == want


def test_hot_key_rows_spread_over_tasks(spark):
    """One key with half of all rows: the per-row window stage must not put
    that half into one task (a plain partitionBy(key) would)."""
    rnd = random.Random(1)
    t0 = datetime(2024, 1, 1)
    rows = [(i, 0 if i % 2 == 0 else rnd.randint(1, 50),
             t0 + timedelta(minutes=rnd.randint(0, 60 * 24 * 4)), True) for i in range(8000)]
    df = spark.createDataFrame(rows, "seq long, k long, ts timestamp, flag boolean")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # keep the 8 shuffle partitions
    try:
        lagged = keyed_lag(df, ["k"], ["ts", "seq"], time_bucket("ts", "1 hour"), ["seq"])
        # the lag itself is read, or else the window would be pruned away
        per_task = [r["n"] for r in lagged.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.max("prev_seq")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum(per_task) == 8000
    assert max(per_task) < 0.25 * 8000      # the hot half is spread, not in one task


@pytest.fixture(scope="module")
def lopsided(spark):
    """One key has a third of all rows, all within one hour; NULL is a key too."""
    rnd = random.Random(11)
    rows = [(i, 0, T1 + timedelta(milliseconds=rnd.randint(0, 3_600_000)), rnd.random() < 0.3) for i in range(600)]
    rows += [(600 + i, rnd.choice([None, 1, 2, 3]), T1 + timedelta(seconds=rnd.randint(0, 10 ** 6)), rnd.random() < 0.3)
             for i in range(1200)]
    return rows


T1 = datetime(2024, 3, 1)


def test_a_hot_key_is_cut_into_equal_parts(spark, lopsided):
    df = spark.createDataFrame(lopsided, "seq long, k long, ts timestamp, flag boolean")
    cuts = volume_cuts(df, ["k"], F.unix_micros("ts"), hot_rows=500, parts=8)
    sizes = {(r.k, r["__bucket"]): r["count"] for r in cuts.number(df).groupBy("k", "__bucket").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == 0]
    assert len(hot) == 8 and max(hot) <= 2 * 600 / 8       # though all lie within one hour
    assert sum(1 for k, _ in sizes if k != 0) == 4          # the others stay whole
    assert volume_cuts(df, ["k"], F.unix_micros("ts"), hot_rows=600) is None


def test_the_largest_task_shrinks_with_the_cuts(spark, lopsided):
    """Task sizes of the exchange that the keyed scans use."""
    df = spark.createDataFrame(lopsided, "seq long, k long, ts timestamp, flag boolean")
    cuts = volume_cuts(df, ["k"], F.unix_micros("ts"), hot_rows=500, parts=64)
    size = lambda d: max(r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect())
    whole = size(df.repartition(32, "k"))
    assert whole >= 600
    assert size(cuts.number(df).filter("k = 0").repartition(32, "k", "__bucket")) < whole / 4


@pytest.mark.parametrize("parts", [2, 7, 256])
def test_keyed_scans_over_cuts_equal_plain_windows(spark, lopsided, parts):
    df = spark.createDataFrame(lopsided, "seq long, k long, ts timestamp, flag boolean")
    cuts = volume_cuts(df, ["k"], F.unix_micros("ts"), hot_rows=200, parts=parts)
    same = lambda f: (sorted(map(str, f(cuts).collect())), sorted(map(str, f(None).collect())))
    for scan in (lambda b: keyed_lag(df, ["k"], ["ts", "seq"], b, ["seq", "flag"]),
                 lambda b: keyed_next_at_or_after(df, ["k"], "ts", b, F.col("flag"), "ts", "nxt"),
                 lambda b: keyed_position(df, ["k"], ["ts", "seq"], b, "pos"),
                 lambda b: keyed_position(df, ["k"], ["ts", "seq"], b, "pos", limit=250)):
        got, want = same(scan)
        assert got == want
