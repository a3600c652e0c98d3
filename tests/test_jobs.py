"""The command-line jobs on small files built from the boundary rows."""

import os
import time

from pyspark.sql import functions as F

from eventide.jobs import JOBS, main, run_job
from tests.fixtures import LOGIN_KEY_LINES, ORDER_KEY_LINES, TX_PAIRS, epoch


def _write(path, lines):
    path.write_text("\n".join(lines))
    return str(path)


def test_every_job_has_an_input_layout():
    assert {"hot_items", "url_ranking", "ad_gate", "login_fail_cep", "order_timeout",
            "tx_match", "word_count"} <= set(JOBS)


def test_batch_jobs(spark, tmp_path):
    ub = _write(tmp_path / "ub.csv", [f"{u},{i},1,pv,{1511658000 + s}" for u, i, s in
                                      [(1, 10, 0), (2, 10, 5), (3, 11, 9), (4, 12, 20)]])
    top = run_job(spark, "hot_items", ub).collect()
    assert {(r.item_id, r.item_count, r.row_num) for r in top} >= {(10, 2, 1)}

    login = _write(tmp_path / "login.csv", LOGIN_KEY_LINES)
    assert run_job(spark, "login_fail_cep", login).count() == 1
    assert run_job(spark, "login_fail", login).count() == 0

    orders = _write(tmp_path / "orders.csv", ORDER_KEY_LINES)
    res = {r.order_id: r.result_msg for r in run_job(spark, "order_timeout", orders).collect()}
    assert res[34768] == "already payed but not found create log"

    rcpts = _write(tmp_path / "rcpt.csv", [f"{tx},wechat,{r}" for _, tx, _, r in TX_PAIRS])
    out = str(tmp_path / "tx_out")
    main(["tx_match", "--input", orders, "--input2", rcpts, "--output", out])
    tags = {r.tag for r in spark.read.parquet(out).collect()}
    assert "matched" in tags and "unmatched_receipt" in tags


def test_streaming_page_views_job(spark, tmp_path):
    folder = tmp_path / "ub"
    folder.mkdir()
    _write(folder / "a.csv", [f"{u},1,1,pv,{1511658000 + s}" for u, s in [(1, 0), (2, 3), (3, 12)]])
    _write(folder / "b.csv", ["9,1,1,pv,1511659000"])      # moves the watermark past both windows
    os.utime(folder / "b.csv", (time.time() + 5, time.time() + 5))
    out = str(tmp_path / "pv_out")
    q = run_job(spark, "page_views", str(folder), out, stream=True)
    q.processAllAvailable()
    q.stop()
    got = {r.window_end: r.pv for r in spark.read.parquet(out).collect()}
    assert got[epoch(1511658010)] == 2 and got[epoch(1511658020)] == 1


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    folder = tmp_path / "ub"
    folder.mkdir()
    out = str(tmp_path / "pv_out")
    now = time.time()
    for k, (name, rows) in enumerate([("a", [(1, 0), (2, 3)]), ("b", [(3, 12), (4, 14)]), ("c", [(9, 1000)])]):
        _write(folder / f"{name}.csv", [f"{u},1,1,pv,{1511658000 + s}" for u, s in rows])
        os.utime(folder / f"{name}.csv", (now + 5 * k, now + 5 * k))
        q = run_job(spark, "page_views", str(folder), out, stream=True)     # a new start each time
        q.processAllAvailable()
        q.stop()
    got = {r.window_end: r.pv for r in spark.read.parquet(out).collect()}
    assert got == {epoch(1511658010): 2, epoch(1511658020): 2}


def test_word_count_stream_is_a_log_of_refinements(spark, tmp_path):
    from eventide.streaming.upsert import latest

    folder = tmp_path / "lines"
    folder.mkdir()
    out = str(tmp_path / "words")
    for k, text in enumerate(["a\nb\na", "b\nc"]):
        _write(folder / f"{k}.txt", [text])
        q = run_job(spark, "word_count", str(folder), out, stream=True)
        q.processAllAvailable()
        q.stop()
    got = {r["word"]: r["count"] for r in latest(spark.read.parquet(out), ["word"]).collect()}
    assert got == {"a": 2, "b": 2, "c": 1}


def test_arrival_order_is_that_of_files_not_of_tasks(spark, tmp_path):
    folder = tmp_path / "login"
    folder.mkdir()
    now = time.time()
    pad = [f"77,83.149.11.{i % 99},success,{1558430000 + i}" for i in range(500)]   # the later file is the larger
    _write(folder / "a.csv", ["5,83.149.11.1,fail,100"])
    _write(folder / "b.csv", ["5,83.149.11.1,fail,101", *pad])
    os.utime(folder / "a.csv", (now - 50, now - 50))
    os.utime(folder / "b.csv", (now - 10, now - 10))
    assert run_job(spark, "login_fail", str(folder)).count() == 1
    os.utime(folder / "a.csv", (now, now))      # now 101 came first: a negative gap also warns
    r = run_job(spark, "login_fail", str(folder)).collect()
    assert len(r) == 1 and r[0].first_ts > r[0].last_ts


def test_marketing_jobs_batch_and_stream(spark, tmp_path):
    base = 1511658000000
    lines = [f"u{i},{b},{c},{base + ms}" for i, (b, c, ms) in enumerate(
        [("Click", "wechat", 0), ("Install", "wechat", 3000), ("Uninstall", "twitter", 4000),
         ("Download", "twitter", 7000), ("Click", "wechat", 12000)])]
    path = _write(tmp_path / "mkt.csv", lines)
    total = {r.window_end: r["count"] for r in run_job(spark, "app_marketing", path).collect()}
    assert total[epoch(1511658005)] == 2 and total[epoch(1511658010)] == 3
    by = run_job(spark, "app_marketing_by_channel", path)
    assert by.filter("behavior = 'Uninstall'").count() == 0

    folder = tmp_path / "mkt_stream"
    folder.mkdir()
    _write(folder / "a.csv", lines + [f"u9,Click,wechat,{base + 60000}"])   # moves the watermark
    q = run_job(spark, "app_marketing", str(folder), str(tmp_path / "mkt_out"), stream=True)
    q.processAllAvailable()
    q.stop()
    streamed = {r.window_end: r["count"] for r in spark.read.parquet(str(tmp_path / "mkt_out")).collect()}
    assert streamed[epoch(1511658010)] == 3


def test_streaming_hot_items_job(spark, tmp_path):
    folder = tmp_path / "ub_stream"
    folder.mkdir()
    rows = [(1, 10, 0), (2, 10, 60), (3, 11, 120), (4, 12, 200), (5, 10, 250)]
    _write(folder / "a.csv", [f"{u},{i},1,pv,{1511658000 + s}" for u, i, s in rows])
    _write(folder / "b.csv", ["9,99,1,pv,1511670000"])        # closes the early windows
    os.utime(folder / "b.csv", (time.time() + 5, time.time() + 5))
    out = str(tmp_path / "hot_out")
    q = run_job(spark, "hot_items", str(folder), out, stream=True)
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(out)
    first = got.filter("row_num = 1").orderBy("window_end").first()
    assert (first.item_id, first.item_count) == (10, 3)
    assert got.agg(F.max("row_num")).first()[0] <= 3


def test_streaming_url_ranking_job(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    lines = [f"10.0.0.{i} - - 17/05/2015:10:05:{s:02d} +0000 GET {u}" for i, (s, u) in
             enumerate([(1, "/a"), (2, "/a"), (3, "/b"), (6, "/a"), (7, "/c")])]
    _write(folder / "a.log", lines)
    _write(folder / "b.log", ["10.0.0.9 - - 17/05/2015:10:20:00 +0000 GET /z"])   # closes windows
    os.utime(folder / "b.log", (time.time() + 5, time.time() + 5))
    out = str(tmp_path / "url_out")
    q = run_job(spark, "url_ranking", str(folder), out, stream=True)
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(out)
    top = got.filter("rank = 1").orderBy("window_end").first()
    assert (top.url, top.views) == ("/a", 2)
    assert got.agg(F.max("rank")).first()[0] <= 5
