"""Changelog and refined versions of a window's top N, and SQL over streams."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventide.functions.time import event_window
from eventide.operators.topn import top_n_per_window
from eventide.streaming.ranked import (RankBorder, fold_changelog, last_versions, write_refined_rankings,
                                       write_top_n_changelog)
from eventide.streaming.runner import event_time, live, prepare_streaming, replay_stream
from eventide.streaming.views import sql_latest, stream_view, streaming_sql

T0 = datetime(2024, 1, 1)
COLS = ["window_end", "item", "n", "row_num"]


def clicks(seed=4, n=400):
    """Popularity drifts, so entries cross the rank border all the time."""
    rnd = random.Random(seed)
    rows = [(i, T0 + timedelta(minutes=i // 2), rnd.choice([None, *range(i // 60, i // 60 + 6)])) for i in range(n)]
    return rows


def counts_of(spark, rows, delay="0 seconds", arrival=None):
    prepare_streaming(spark)
    df = spark.createDataFrame(rows, "id long, ts timestamp, item long")
    ev = event_time(replay_stream(df, "ts", arrival=arrival), "ts", delay)
    return (ev.groupBy(event_window("ts", "1 hour").alias("w"), "item")
            .agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
            .select(F.col("w.end").alias("window_end"), "item", "n", "last_ts"))


def expected(spark, rows, n):
    df = spark.createDataFrame(rows, "id long, ts timestamp, item long")
    c = (df.groupBy(event_window("ts", "1 hour").alias("w"), "item").agg(F.count(F.lit(1)).alias("n"))
         .select(F.col("w.end").alias("window_end"), "item", "n"))
    return {tuple(r) for r in top_n_per_window(c, n, key_cols=["item"], count_col="n").collect()}


@pytest.fixture(scope="module")
def log(spark):
    folder = write_top_n_changelog(counts_of(spark, clicks()).drop("last_ts"), "t", 3, ["item"], "n", "1 hour")
    return spark.read.parquet(folder).cache()


def test_changelog_folds_to_the_final_top_n(spark, log):
    got = {tuple(r) for r in fold_changelog(log, COLS).collect()}
    assert got == expected(spark, clicks(), 3)


def test_changelog_takes_back_what_it_gave(log):
    """Every '-' names a row that stands at that time, and no rank is held twice."""
    rows = sorted(log.collect(), key=lambda r: (r.epoch, r.op == "+"))
    standing = defaultdict(set)
    minus = 0
    for r in rows:
        entry = (r.item, r.n, r.row_num)
        if r.op == "-":
            minus += 1
            standing[r.window_end].remove(entry)
        else:
            assert entry not in standing[r.window_end]
            standing[r.window_end].add(entry)
    assert minus > 0
    for held in standing.values():
        assert len({rank for _, _, rank in held}) == len(held) <= 3


def test_each_epoch_leaves_a_full_ranking(log):
    """After any epoch the folded log is a ranking 1..k without gaps."""
    for e in [r.epoch for r in log.select("epoch").distinct().collect()]:
        rows = fold_changelog(log.filter(F.col("epoch") <= e), COLS).collect()
        by_window = defaultdict(list)
        for r in rows:
            by_window[r.window_end].append((r.row_num, -r.n))
        for ranks in by_window.values():
            ranks.sort()
            assert [k for k, _ in ranks] == list(range(1, len(ranks) + 1))
            assert [c for _, c in ranks] == sorted(c for _, c in ranks)


def test_a_replayed_epoch_gives_the_same_rows(spark):
    border = RankBorder(spark, 2, ["item"], "n")
    batch = lambda rows: spark.createDataFrame(rows, "window_end timestamp, item long, n long")
    first = batch([(T0, 1, 5), (T0, 2, 4), (T0, 3, 3)])
    border.keep(0, border.ranked(first, border.read(border.like(first), -1)))
    second = batch([(T0, 3, 9)])
    for _ in range(2):                                     # the second time is the replay
        now = border.ranked(second, border.read(border.like(second), 0))
        border.keep(1, now)
        assert {(r.item, r.n, r.row_num) for r in border.read(border.like(second), 1).collect()} == {(3, 9, 1), (1, 5, 2)}


def late(rows, every=9, by=50):
    at = F.when(F.col("id") % every == 0, F.col("ts") + F.expr(f"INTERVAL {by} MINUTES")).otherwise(F.col("ts"))
    return at


def test_refined_versions_after_late_rows(spark):
    rows = clicks(8)
    counts = counts_of(spark, rows, "7205 seconds", late(rows))
    folder = write_refined_rankings(counts, "t", 3, ["item"], "n", "5 seconds", "2 hours", rank="row_num")
    log = spark.read.parquet(folder).cache()
    got = {tuple(r) for r in last_versions(log).select(*COLS).collect()}
    assert got == expected(spark, rows, 3)
    versions = {r.window_end: r.v for r in log.groupBy("window_end").agg(F.countDistinct("epoch").alias("v")).collect()}
    assert max(versions.values()) > 1                      # some window was ranked again
    assert min(versions.values()) == 1                     # and untouched ones were not
    firsts = log.filter("first").groupBy("window_end").agg(F.countDistinct("epoch").alias("v"))
    assert {r.v for r in firsts.collect()} == {1}
    # each version is a whole ranking
    for r in log.groupBy("window_end", "epoch").agg(F.max("row_num").alias("k"), F.count("*").alias("c")).collect():
        assert r.k == r.c


def test_rows_beyond_the_lateness_change_nothing(spark):
    rows = clicks(8)
    # the watermark is 5 s late only, so rows of closed windows are dropped
    counts = counts_of(spark, rows, "5 seconds", late(rows, by=180))
    folder = write_refined_rankings(counts, "t", 3, ["item"], "n", "5 seconds", "0 seconds", rank="row_num")
    log = spark.read.parquet(folder).cache()
    # Spark tells late rows by the watermark of one micro-batch before, no later
    span = log.groupBy("window_end").agg((F.max("epoch") - F.min("epoch")).alias("v"))
    assert span.agg(F.max("v")).first()[0] <= 1
    got = {tuple(r) for r in last_versions(log).select(*COLS).collect()}
    assert got != expected(spark, rows, 3)                 # the dropped rows are missing


def test_sql_over_a_streaming_view(spark):
    prepare_streaming(spark)
    rows = clicks(2, 100)
    df = spark.createDataFrame(rows, "id long, ts timestamp, item long")
    ev = event_time(replay_stream(df, "ts"), "ts", "0 seconds")
    stream_view(ev.filter(F.col("id").isNotNull()), "t_stream")
    got = sql_latest(spark, "SELECT item, count(*) AS n, max(id) AS last FROM t_stream GROUP BY item", "t", ["item"])
    want = df.groupBy("item").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_views_refuse_tables(spark):
    table = spark.createDataFrame([(1,)], "a long")
    with pytest.raises(ValueError):
        stream_view(table, "t_table")
    table.createOrReplaceTempView("t_table")
    with pytest.raises(ValueError):
        streaming_sql(spark, "SELECT * FROM t_table")


def test_filtered_stream_still_closes_windows(spark):
    """The flush sentinel passes a ``live`` filter, and no row of it is returned."""
    prepare_streaming(spark)
    df = spark.createDataFrame(clicks(3, 60), "id long, ts timestamp, item long")
    ev = event_time(replay_stream(df, "ts"), "ts", "0 seconds").filter(live(F.col("item") == 1))
    counts = (ev.groupBy(event_window("ts", "1 hour").alias("w"), "item").agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("w.end").alias("window_end"), "item", "n"))
    log = spark.read.parquet(write_top_n_changelog(counts, "t", 3, ["item"], "n", "1 hour"))
    assert {r.item for r in fold_changelog(log, COLS).collect()} == {1}
