from datetime import datetime

from pyspark.sql import functions as F

from eventide.operators import (hot_items, marketing_by_channel, marketing_total, page_views,
                                ranked_report, running_count, top_n_per_window, url_ranking,
                                windowed_count, words)
from tests.fixtures import at


def test_sliding_window_counts_each_row_in_size_over_slide_windows(spark):
    df = spark.createDataFrame([(1, at(0)), (1, at(7)), (2, at(12))], "k long, ts timestamp")
    got = {(r.window_end, r.k): r["count"] for r in
           windowed_count(df, "ts", "10 seconds", "5 seconds", keys=["k"]).collect()}
    assert got == {(at(5), 1): 1, (at(10), 1): 2, (at(15), 1): 1, (at(15), 2): 1, (at(20), 2): 1}


def test_top_n_breaks_ties_by_key_and_limits(spark):
    counts = spark.createDataFrame(
        [(at(10), 5, 3), (at(10), 4, 3), (at(10), 9, 1), (at(10), 7, 8), (at(20), 1, 1)],
        "window_end timestamp, item_id long, count long")
    got = [(r.window_end, r.item_id, r.row_num) for r in
           top_n_per_window(counts, 3).orderBy("window_end", "row_num").collect()]
    assert got == [(at(10), 7, 1), (at(10), 4, 2), (at(10), 5, 3), (at(20), 1, 1)]
    everything = top_n_per_window(counts, None).count()
    assert everything == 5


def test_top_n_plan_limits_before_the_shuffle(spark):
    counts = spark.range(1000).select(
        (F.lit(at(0)) + F.make_dt_interval(F.lit(0), F.col("id") % 3)).alias("window_end"),
        F.col("id").alias("item_id"), (F.col("id") % 7).alias("count"))
    plan = top_n_per_window(counts, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_items_and_report(spark):
    rows = [(u, "pv", at(s)) for u, s in [(1, 1), (1, 2), (2, 3), (3, 4), (3, 5), (3, 6), (4, 7)]]
    rows.append((9, "cart", at(8)))
    df = spark.createDataFrame(rows, "item_id long, behavior string, ts timestamp")
    top = hot_items(df, size="1 hour", slide="30 minutes", n=2)
    got = sorted((r.window_end, r.item_id, r.item_count, r.row_num) for r in top.collect())
    w1, w2 = datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 1, 1, 0)
    assert got == [(w1, 1, 2, 2), (w1, 3, 3, 1), (w2, 1, 2, 2), (w2, 3, 3, 1)]
    rep = {r.window_end: r.report for r in ranked_report(top, "item_id", "item_count", 2).collect()}
    assert rep[w2] == ("时间：2024-01-01 00:59:59.999\nNo1: 商品ID=3 浏览量=3\n"
                       "No2: 商品ID=1 浏览量=2\n" + "=" * 34)


def test_url_ranking_as_coded_ranks_everything(spark):
    df = spark.createDataFrame([(f"/u{i % 7}", at(i)) for i in range(40)], "url string, ts timestamp")
    assert url_ranking(df, size="1 hour", slide="1 hour", n=None).count() == 7
    assert url_ranking(df, size="1 hour", slide="1 hour", n=5).count() == 5


def test_page_views_and_marketing(spark):
    df = spark.createDataFrame([("pv", "wechat", at(1)), ("pv", "wechat", at(11)),
                                ("Uninstall", "wechat", at(2)), ("Click", "twitter", at(3))],
                               "behavior string, channel string, ts timestamp")
    pv = {r.window_end: r.pv for r in page_views(df, size="10 seconds").collect()}
    assert pv == {at(10): 1, at(20): 1}
    tot = {r.window_end: r["count"] for r in marketing_total(df, "ts", "10 seconds", "5 seconds").collect()}
    assert tot == {at(5): 2, at(10): 2, at(15): 1, at(20): 1}
    row = marketing_total(df, "ts", "10 seconds", "5 seconds").orderBy("window_end").first()
    assert (row.channel, row.behavior, row.window_start_text) == \
        ("app marketing", "total", "2023-12-31 23:59:55.0")
    by = marketing_by_channel(df, "ts", "10 seconds", "5 seconds")
    assert by.filter(F.col("behavior") == "Uninstall").count() == 0


def test_running_word_count_uses_whole_texts(spark):
    text = "the cat  the\thot\ncat " * 50 + "tail"
    df = spark.createDataFrame([(text,)], "text string")
    got = {r.word: r["count"] for r in running_count(words(df), "word").collect()}
    assert got == {"the": 100, "cat": 100, "hot": 50, "tail": 1}


def test_pane_counts_equal_plain_sliding_windows(spark):
    import random
    from eventide.functions.time import event_window
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.randint(1, 5), at(rnd.randint(0, 20000))) for _ in range(3000)],
                               "k long, ts timestamp")
    for keys in ([], ["k"]):
        got = windowed_count(df, "ts", "1 hour", "5 minutes", keys=keys, with_start=True)
        plain = (df.groupBy(event_window("ts", "1 hour", "5 minutes").alias("w"), *keys)
                 .agg(F.count(F.lit(1)).alias("count"))
                 .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         *keys, "count"))
        assert sorted(got.collect()) == sorted(plain.select(got.columns).collect())
