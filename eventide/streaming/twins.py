"""Streaming forms of the registered queries (stream = batch).

Each twin streams the same parquet table (``readStream``), runs the
streaming form of the operator with a watermark, writes its results through
``foreachBatch`` into the checkpoint folder, and returns them as a batch
DataFrame.  Every twin must equal its batch query, so it shares that
query's DuckDB oracle (``STREAM_ORACLE_OF``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.hashing import bloom_estimate, bloom_positions, bloom_size, poly_hash
from eventide.functions.time import (duration_micros, epoch_millis_text, event_window,
                                    format_java_ts)
from eventide.operators import distinct as distinct_ops
from eventide.operators import gate as gate_ops
from eventide.operators import sequence as seq_ops
from eventide.operators.distinct import bitmap_counts
from eventide.operators.topn import top_n_per_window
from eventide.operators.windows import words
from eventide.plans import catalog as C
from eventide.session import scratch_path
from eventide.sinks.bitmap_store import BitmapStore
from eventide.streaming.carried import (burst_step, deadline_step, followed_by_step, gate_step, outcome_step,
                                        reconcile_once_step, reconcile_step, run_carried, strict_next_step,
                                        two_sides, window_count_step)
from eventide.streaming.processors import ArrivalPairs
from eventide.streaming.ranked import (fold_changelog, last_versions, write_refined_rankings,
                                       write_top_n_changelog)
from eventide.streaming.runner import (before_flush, event_time, live,
                                       prepare_streaming, replay_parts, replay_stream, run_and_read,
                                       time_bounds)
from eventide.streaming.upsert import latest, write_update_log
from eventide.streaming.uv_store import feed_bitmap_store
from eventide.streaming.views import sql_appended, sql_latest, stream_view, streaming_sql

NTZ = T.TimestampNTZType()
#: Longer than any time between two rows of one order in the driver tables.
ORDER_SPAN = "3000 days"


def _events(spark: SparkSession, sf: str, delay: str = "0 seconds") -> DataFrame:
    prepare_streaming(spark)
    return event_time(replay_stream(C._read(spark, sf, "events"), "ts"), "ts", delay)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast(NTZ))
    return df


# --------------------------------------------------------------- aggregates
def s_hot_items_topn(spark, sf):
    """TOP-1 on a stream: per-item counts close with their window (append),
    so each micro-batch holds whole windows and is ranked as a batch."""
    ev = _events(spark, sf).filter(live(F.col("event_type") == C.PV))
    counts = (ev.groupBy(event_window("ts", C.HOT_SIZE, C.HOT_SLIDE).alias("w"),
                         F.col("user_id").alias("item_id"))
              .agg(F.count(F.lit(1)).alias("item_count"))
              .select(F.col("w.end").alias("window_end"), "item_id", "item_count"))

    def rank(batch: DataFrame) -> DataFrame:
        top = top_n_per_window(batch, C.HOT_N, key_cols=["item_id"], count_col="item_count")
        return _ntz(top, "window_end").select("window_end", "item_id", "item_count", "row_num")

    return run_and_read(counts, "hot_items_topn", transform=rank)


def s_url_rank(spark, sf):
    """TOP-3 with the 65 s watermark (5 s disorder + 60 s lateness), final
    counts in append mode, top 5 per window."""
    ev = _events(spark, sf, delay="65 seconds")
    counts = (ev.groupBy(event_window("ts", C.URL_SIZE, C.URL_SLIDE).alias("w"),
                         F.concat(F.lit("/user/"), F.col("user_id")).alias("url"))
              .agg(F.count(F.lit(1)).alias("views"))
              .select(F.col("w.end").alias("window_end"), "url", "views"))

    def rank(batch: DataFrame) -> DataFrame:
        top = top_n_per_window(batch, C.URL_N, key_cols=["url"], count_col="views",
                               rank_col="rank")
        return _ntz(top, "window_end").select("window_end", "url", "views", "rank")

    return run_and_read(counts, "url_rank", transform=rank)


def s_hot_items_changelog(spark, sf):
    """TOP-2, CHG-1: the counts are SQL over a streaming view, the top n of
    every window is kept as a changelog; folded, it is the SQL's result."""
    ev = _events(spark, sf).filter(live(F.col("event_type") == C.PV))
    view = stream_view(ev.select(F.col("user_id").alias("item_id"), "ts"), "eventide_hot_items_stream")
    counts = streaming_sql(spark, f"""
        SELECT window(ts, '{C.HOT_SIZE}', '{C.HOT_SLIDE}').end AS window_end, item_id, COUNT(item_id) AS item_count
        FROM {view} GROUP BY window(ts, '{C.HOT_SIZE}', '{C.HOT_SLIDE}'), item_id""")
    log = write_top_n_changelog(counts, "hot_items", C.HOT_N, ["item_id"], "item_count", C.HOT_SIZE)
    cols = ["window_end", "item_id", "item_count", "row_num"]
    return _ntz(fold_changelog(spark.read.parquet(log), cols), "window_end")


#: Every 50th click comes an hour after its event time, still within the lateness.
LATE_EVERY, LATE_BY, URL_LATENESS = 50, "1 hour", "2 hours"


def refined_url_rankings(spark, sf) -> str:
    """STR-3, TOP-3: late rows rank their windows again; folder of all versions."""
    prepare_streaming(spark)
    events = C._read(spark, sf, "events")
    late = F.when(F.col("event_id") % LATE_EVERY == 0, F.col("ts") + F.expr(f"INTERVAL {LATE_BY}"))
    ev = event_time(replay_stream(events, "ts", arrival=F.coalesce(late, F.col("ts"))), "ts",
                    f"{duration_micros(URL_LATENESS) // 1_000_000 + 5} seconds")
    counts = (ev.groupBy(event_window("ts", C.URL_SIZE, C.URL_SLIDE).alias("w"),
                         F.concat(F.lit("/user/"), F.col("user_id")).alias("url"))
              .agg(F.count(F.lit(1)).alias("views"), F.max("ts").alias("last_ts"))
              .select(F.col("w.end").alias("window_end"), "url", "views", "last_ts"))
    return write_refined_rankings(counts, "url_rank", C.URL_N, ["url"], "views", "5 seconds", URL_LATENESS)


def s_url_rank_refined(spark, sf):
    versions = spark.read.parquet(refined_url_rankings(spark, sf))
    return _ntz(last_versions(versions), "window_end").select("window_end", "url", "views", "rank")


def s_select_star(spark, sf):
    """PRJ-5, PRJ-6: ``select *`` over a streaming view."""
    ev = _events(spark, sf)
    view = stream_view(ev.select("event_id", "user_id", F.col("user_id").alias("item_id"),
                                 F.col("event_type").alias("behavior"), "ts"), "eventide_user_behavior_stream")
    return sql_appended(spark, f"SELECT * FROM {view}", "select_star", lambda b: _ntz(before_flush(b, "ts"), "ts"))


def s_running_count_sql(spark, sf):
    """AGG-8 in SQL: word counts over a streaming view in update mode."""
    prepare_streaming(spark)
    view = stream_view(words(replay_parts(C._read(spark, sf, "documents").select("text"))), "eventide_words_stream")
    return sql_latest(spark, f"SELECT word, COUNT(*) AS count FROM {view} GROUP BY word", "running_count_sql", ["word"])


def s_page_views(spark, sf):
    ev = _events(spark, sf, delay="5 seconds").filter(live(F.col("event_type") == C.PV))
    pv = (ev.groupBy(event_window("ts", C.PV_SIZE).alias("w")).agg(F.count(F.lit(1)).alias("pv"))
          .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "pv"))
    return run_and_read(pv, "page_views", transform=lambda b: _ntz(b, "window_start", "window_end"))


def s_marketing_by_channel(spark, sf):
    """AGG-5: per (channel, behaviour) sliding-window count; the reference
    buffers whole windows, a streaming count keeps one number per group."""
    ev = _events(spark, sf).filter(live(F.col("event_type") != C.SIGNUP))
    ch = F.element_at(F.array(*[F.lit(c) for c in C.CHANNELS]),
                      (F.col("user_id") % len(C.CHANNELS) + 1).cast("int"))
    counts = (ev.groupBy(event_window("ts", C.MKT_SIZE, C.MKT_SLIDE).alias("w"),
                         ch.alias("channel"), F.col("event_type").alias("behavior"))
              .agg(F.count(F.lit(1)).alias("count"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "channel", "behavior", "count"))

    def finish(batch: DataFrame) -> DataFrame:
        b = _ntz(before_flush(batch, "window_start"), "window_start", "window_end")
        return b.select("window_start", "window_end",
                        format_java_ts("window_start").alias("window_start_text"),
                        format_java_ts("window_end").alias("window_end_text"),
                        "channel", "behavior", "count")

    return run_and_read(counts, "marketing_by_channel", transform=finish)


def s_uv_exact(spark, sf):
    """UV-1: countDistinct is not allowed on streams; two chained
    aggregates are: distinct (window, user), then count per window."""
    ev = _events(spark, sf).filter(live(F.col("event_type") == C.PV))
    per_user = ev.groupBy(event_window("ts", C.UV_SIZE).alias("w"), "user_id").count()
    uv = (per_user.groupBy(event_window(F.window_time("w"), C.UV_SIZE).alias("w2"))
          .agg(F.count(F.lit(1)).alias("uv_count"))
          .select(F.col("w2.end").alias("window_end"), "uv_count"))
    return run_and_read(uv, "uv_exact", transform=lambda b: _ntz(b, "window_end"))


def s_uv_bitmap(spark, sf):
    """UV-3 on a stream: per (window, 32k-bit bucket) bitmaps are a watermark
    aggregate (mergeable state, a few KB per bucket); each closed window's
    set bits are summed in the micro-batch that emits it."""
    ev = _events(spark, sf).filter(live(F.col("event_type") == C.PV))
    h = poly_hash(F.col("user_id"))
    bitmaps = (ev.groupBy(event_window("ts", C.UV_SIZE).alias("w"),
                          F.bitmap_bucket_number(h).alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias("bitmap"))
               .select(F.col("w.end").alias("window_end"), "bucket", "bitmap"))

    def count(batch: DataFrame) -> DataFrame:
        return _ntz(bitmap_counts(before_flush(batch, "window_end")), "window_end")

    return run_and_read(bitmaps, "uv_bitmap", transform=count)


def s_uv_bitmap_store(spark, sf):
    """UV-3, SNK-4: four micro-batches ORed into the persisted store."""
    prepare_streaming(spark)
    store = BitmapStore(spark, scratch_path(spark, "uv-store"))
    views = replay_parts(C._views(spark, sf).select("user_id", "ts"))
    query = feed_bitmap_store(views, store, "views", scratch_path(spark, "uv-store-ckpt"), size=C.UV_SIZE)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return store.counts()


def s_uv_bloom(spark, sf):
    """UV-2 on a stream: the Bloom filter of each window is the same OR-merged
    bitmaps, kept as watermark-aggregate state; the estimate is computed per
    closed window.  The filter has the size of the batch form's."""
    m, k = bloom_size(distinct_ops.bloom_insertions(C._views(spark, sf), size=C.UV_SIZE), distinct_ops.BLOOM_FPP)
    ev = _events(spark, sf).filter(live(F.col("event_type") == C.PV))
    positions = F.transform(bloom_positions(F.col("user_id"), m, k), lambda x: x + 1)
    filters = (ev.select("ts", F.explode(positions).alias("p"))
               .groupBy(event_window("ts", C.UV_SIZE).alias("w"),
                        F.bitmap_bucket_number("p").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
               .select(F.col("w.end").alias("window_end"), "bucket", "bits"))

    def estimate(batch: DataFrame) -> DataFrame:
        bits = (before_flush(batch, "window_end").groupBy("window_end")
                .agg(F.sum(F.bitmap_count("bits")).cast("long").alias("bits_set")))
        return _ntz(bits.select("window_end", bloom_estimate(F.col("bits_set"), m, k)
                                .alias("uv_estimate")), "window_end")

    return run_and_read(filters, "uv_bloom", transform=estimate)


def s_running_count(spark, sf):
    """AGG-8: running word count over several micro-batches; the last version
    of a word's count is the result (``eventide.streaming.changelog`` gives the
    -/+ rows)."""
    prepare_streaming(spark)
    docs = replay_parts(C._read(spark, sf, "documents").select("text"))
    counts = words(docs).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return latest(spark.read.parquet(write_update_log(counts, "running_count")), ["word"])


# ------------------------------------------------------------------- joins
def _two_sides(pays: DataFrame, receipts: DataFrame) -> DataFrame:
    """Both sides as one stream, in the same time slices."""
    bounds = time_bounds(pays, "pay_ts", 4)
    return two_sides(replay_stream(pays, "pay_ts", bounds=bounds),
                     replay_stream(receipts, "receipt_ts", bounds=bounds), "tx_id", "pay_ts", "receipt_ts")


def s_tx_reconcile(spark, sf):
    """JOIN-1 as a stream-stream full outer interval join.  Both inputs are
    streamed from tables Spark derives from orders / lineitem (first ship
    date per order); rows without a partner appear once the watermark has
    passed them by the tolerance."""
    prepare_streaming(spark)
    pays = C._read(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("tx_id"), F.col("o_orderdate").alias("pay_ts"))
    rcps = (C._read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("receipt_ts"))
            .select(F.col("l_orderkey").cast("string").alias("tx_id"), "receipt_ts"))
    # written once: the replay reads it several times
    folder = scratch_path(spark, "first-receipts")
    rcps.write.parquet(folder)
    rcps = spark.read.schema(rcps.schema).parquet(folder)
    found = run_carried(_two_sides(pays, rcps), "tx_reconcile", [reconcile_step(C.TX_TOLERANCE)])
    # as in Spark's own outer join of streams, a record without a time does not come out
    return (found.select(F.col("tx").alias("tx_id"), "p.pay_ts", "r.receipt_ts", "tag")
            .filter(F.coalesce("pay_ts", "receipt_ts").isNotNull()))


def s_tx_reconcile_once(spark, sf):
    """JOIN-1, each record once: one open record per id is carried."""
    prepare_streaming(spark)
    step = reconcile_once_step(C.ONCE_TOLERANCE, "pay_ts", "receipt_ts", "pay_no", "receipt_no")
    once = run_carried(_two_sides(*C._reused_ids(spark, sf)), "tx_reconcile_once", [step])
    return once.select(F.col("tx").alias("tx_id"), "p.pay_ts", F.col("p.pay_no").cast("string").alias("pay_no"),
                       "r.receipt_ts", F.col("r.receipt_no").cast("string").alias("receipt_no"), "tag")


# ------------------------------------------------------- stateful rules
def _replayed(spark: SparkSession, sf: str) -> DataFrame:
    prepare_streaming(spark)
    return replay_stream(C._read(spark, sf, "events"), "ts")


def s_login_fail_strict(spark, sf):
    fail = F.col("event_type") == C.ERROR
    rows = _replayed(spark, sf).select("user_id", "ts", "event_id", fail.alias("fail"))
    step = strict_next_step(["user_id"], "ts", "event_id", "fail", "fail", C.LOGIN_WITHIN, seq_ops.MSG_STRICT)
    return run_carried(rows, "login_fail_strict", [step], delay="5 seconds") \
        .select("user_id", "first_ts", "last_ts", "msg")


_WARNING = T.StructType([T.StructField("user_id", T.LongType()),
                         T.StructField("first_ts", T.TimestampType()),
                         T.StructField("last_ts", T.TimestampType()),
                         T.StructField("msg", T.StringType())])


def s_login_fail_arrival(spark, sf):
    """SEQ-1b: arrival order, processed as rows come (no watermark wait)."""
    ev = _events(spark, sf)
    fail = F.col("event_type") == C.ERROR
    rows = ev.select("user_id", "ts", F.col("event_id").alias("seq"), fail.alias("a"),
                     fail.alias("b"))
    stream = rows.groupBy("user_id").transformWithState(
        ArrivalPairs(duration_micros(C.LOGIN_WITHIN), seq_ops.MSG_ARRIVAL), _WARNING,
        "Append", "None")
    return run_and_read(stream, "login_fail_arrival", schema=T.StructType(
        [T.StructField(f.name, NTZ if f.name.endswith("_ts") else f.dataType)
         for f in _WARNING.fields]),
        transform=lambda b: _ntz(before_flush(b, "first_ts"), "first_ts", "last_ts"))


def s_login_fail_burst(spark, sf):
    rows = _replayed(spark, sf).select("user_id", "ts", (F.col("event_type") == C.ERROR).alias("fail"))
    step = burst_step(["user_id"], "ts", "fail", C.BURST_WITHIN, 2)
    return run_carried(rows, "login_fail_burst", [step]).select("user_id", "first_ts", "last_ts", "msg")


def _order_log_stream(spark, sf):
    creates = C._read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("ts"),
        F.lit(True).alias("is_create"), F.lit(False).alias("is_pay"))
    pays = C._read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("ts"),
        F.lit(False).alias("is_create"), F.lit(True).alias("is_pay"))
    bounds = time_bounds(creates, "ts", 4)
    return replay_stream(creates, "ts", bounds=bounds).unionByName(replay_stream(pays, "ts", bounds=bounds))


def s_order_deadline(spark, sf):
    prepare_streaming(spark)
    step = deadline_step("order_id", "ts", "is_create", "is_pay", C.OUTCOME_WITHIN, keep=ORDER_SPAN)
    return run_carried(_order_log_stream(spark, sf), "order_deadline", [step]) \
        .select("order_id", "create_ts", "pay_ts", "result_msg")


def s_ad_gate_daily(spark, sf):
    rows = _replayed(spark, sf).select("event_id", "user_id", F.col("event_type").alias("ad_id"), "ts")
    step = gate_step(["user_id", "ad_id"], "ts", "event_id", C.GATE_DAILY_MAX, "1 day")
    return run_carried(rows, "ad_gate", [step], delay="5 seconds")


def s_ad_by_geo(spark, sf):
    """GATE-1 then AGG-3, chained on one stream as in the reference: the
    gate's passed rows of a micro-batch go to the sliding-window count."""
    rows = _replayed(spark, sf).select("event_id", "user_id", F.col("event_type").alias("ad_id"), "ts")
    gate = gate_step(["user_id", "ad_id"], "ts", "event_id", C.GATE_MAX)
    count = window_count_step("ts", C.GEO_SIZE, C.GEO_SLIDE, "province")
    counts = run_carried(rows, "ad_by_geo", [
        gate, lambda due, old, wm: count(gate_ops.gate_passed(due).withColumnRenamed("ad_id", "province"), old, wm)],
        delay="5 seconds")
    return counts.select("window_end", epoch_millis_text("window_end").alias("window_end_ms"), "province", "count")


def s_order_timeout(spark, sf):
    rows = _replayed(spark, sf).select(F.col("user_id").alias("order_id"), "ts",
                                       (F.col("event_type") == C.SIGNUP).alias("created"),
                                       (F.col("event_type") == C.PURCHASE).alias("payed"))
    return run_carried(rows, "order_timeout", [
        followed_by_step(["order_id"], "ts", "created", "payed", C.ORDER_WITHIN)])


def s_order_outcomes(spark, sf, grace: str = ORDER_SPAN):
    """SEQ-3 on a stream of creates (orders) and pays (lineitem).  ``grace``
    is how long the other side may still arrive; the driver tables put years
    between an order and its shipping, so the twin needs as much."""
    prepare_streaming(spark)
    step = outcome_step("order_id", "ts", "is_create", "is_pay", C.OUTCOME_WITHIN, grace)
    return run_carried(_order_log_stream(spark, sf), "order_outcomes", [step]) \
        .select("order_id", "create_ts", "pay_ts", "result_msg", "tag")


STREAM_QUERIES = {
    "hot_items_topn_stream": s_hot_items_topn,
    "hot_items_changelog_stream": s_hot_items_changelog,
    "url_rank_stream": s_url_rank,
    "url_rank_refined_stream": s_url_rank_refined,
    "select_star_stream": s_select_star,
    "running_count_sql_stream": s_running_count_sql,
    "page_views_stream": s_page_views,
    "uv_exact_stream": s_uv_exact,
    "uv_bitmap_stream": s_uv_bitmap,
    "uv_bitmap_store_stream": s_uv_bitmap_store,
    "uv_bloom_stream": s_uv_bloom,
    "marketing_by_channel_stream": s_marketing_by_channel,
    "running_count_stream": s_running_count,
    "tx_reconcile_stream": s_tx_reconcile,
    "tx_reconcile_once_stream": s_tx_reconcile_once,
    "login_fail_strict_stream": s_login_fail_strict,
    "login_fail_arrival_stream": s_login_fail_arrival,
    "login_fail_burst_stream": s_login_fail_burst,
    "order_deadline_stream": s_order_deadline,
    "ad_gate_stream": s_ad_gate_daily,
    "ad_by_geo_stream": s_ad_by_geo,
    "order_timeout_stream": s_order_timeout,
    "order_outcomes_stream": s_order_outcomes,
}

STREAM_ORACLE_OF = {
    "hot_items_topn_stream": "hot_items_topn",
    "hot_items_changelog_stream": "hot_items_sql",
    "url_rank_stream": "url_rank_top5",
    "url_rank_refined_stream": "url_rank_top5",
    "select_star_stream": "select_star",
    "running_count_sql_stream": "running_count",
    "page_views_stream": "page_views",
    "uv_exact_stream": "uv_exact",
    "uv_bitmap_stream": "uv_bitmap",
    "uv_bitmap_store_stream": "uv_bitmap",
    "uv_bloom_stream": "uv_bloom",
    "marketing_by_channel_stream": "marketing_by_channel",
    "running_count_stream": "running_count",
    "tx_reconcile_stream": "tx_reconcile",
    "tx_reconcile_once_stream": "tx_reconcile_once",
    "login_fail_strict_stream": "login_fail_strict",
    "login_fail_arrival_stream": "login_fail_arrival",
    "login_fail_burst_stream": "login_fail_burst",
    "order_deadline_stream": "order_deadline",
    "ad_gate_stream": "ad_gate_daily",
    "ad_by_geo_stream": "ad_by_geo",
    "order_timeout_stream": "order_timeout_cep",
    "order_outcomes_stream": "order_outcomes",
}
