"""Registered queries over the driver's tables, with their DuckDB oracles.

Mapping of the reference's records onto the given tables (SURVEY §7.3):
``events.user_id`` is the user / item / url, ``event_type`` the behaviour,
``ts`` the event time and ``event_id`` the arrival order.  Windows are scaled
from seconds to hours/days because events are minutes apart.  Orders and
payments come from ``orders`` (create = order date) and ``lineitem``
(pay = ship date).  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.hashing import (BITMAP_HASH_SEED, MERSENNE_31, bloom_coefficients,
                                        bloom_size)
from eventide.functions.time import duration_micros
from eventide.operators import distinct, gate, orders, pattern, reconciliation, sequence, topn, windows
from eventide.session import scratch_path, use_runtime_conf
from eventide.sinks.bitmap_store import BitmapStore
from eventide.sources.access_log import format_access_log, parse_access_log
from eventide.sources.delimited import format_lines, parse_lines, read_delimited

# ---------------------------------------------------------------- parameters
HOT_SIZE, HOT_SLIDE, HOT_N = "1 day", "6 hours", 3           # AGG-1/TOP-1 (1 h / 5 min)
URL_SIZE, URL_SLIDE, URL_N = "2 hours", "1 hour", 5          # AGG-2/TOP-3 (10 s / 5 s)
PV_SIZE = "1 hour"                                           # AGG-6 (10 s)
UV_SIZE = "1 day"                                            # UV-1..3 (10 s / 2 min)
MKT_SIZE, MKT_SLIDE = "1 day", "6 hours"                     # AGG-4/5 (10 s / 5 s)
GEO_SIZE, GEO_SLIDE = "1 day", "6 hours"                     # AGG-3 (10 s / 5 s)
GATE_MAX, GATE_DAILY_MAX = 10, 1                             # GATE-1 (100 per day)
PAIR_WITHIN, TRIPLE_WITHIN = "12 hours", "3 days"            # patterns of 2 and 3 stages (2 s, 15 min)
LOGIN_WITHIN, BURST_WITHIN = "6 hours", "12 hours"           # SEQ-1 (2 s)
ORDER_WITHIN = "6 hours"                                     # SEQ-2 (15 min)
OUTCOME_WITHIN = "365 days"                                  # SEQ-3/4 on orders
ONCE_TOLERANCE = "20 days"                                   # JOIN-1, each record once (5 s)
TX_TOLERANCE = "365 days"                                    # JOIN-1 (5 s)
INCREMENTAL_CUT = "2024-01-16 12:00:00"                      # run 1 / run 2 of UV-3

PV, SIGNUP, PURCHASE, ERROR = "view", "signup", "purchase", "error"
CHANNELS = ["wechat", "facebook", "twitter", "instagram"]    # marketing channels


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_runtime_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark, sf_dir):
    return _read(spark, sf_dir, "events")


def user_behavior(spark, sf_dir) -> DataFrame:
    """events as the reference's behaviour record (item = user, as in §7.3)."""
    return events(spark, sf_dir).select(
        "event_id", "user_id", F.col("user_id").alias("item_id"),
        F.col("event_type").alias("behavior"), "ts")


# ------------------------------------------------------------------ queries
def q_hot_items_topn(spark, sf):
    return topn.hot_items(user_behavior(spark, sf), size=HOT_SIZE, slide=HOT_SLIDE, n=HOT_N,
                          behavior=PV).select("window_end", "item_id", "item_count", "row_num")


def q_hot_items_sql(spark, sf):
    user_behavior(spark, sf).filter(F.col("behavior") == PV) \
        .select("item_id", "ts").createOrReplaceTempView("eventide_hot_items_t")
    return spark.sql(f"""
        SELECT window_end, item_id, item_count, CAST(row_num AS BIGINT) AS row_num FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY window_end
                                       ORDER BY item_count DESC, item_id) AS row_num
          FROM (SELECT item_id, COUNT(item_id) AS item_count,
                       window(ts, '{HOT_SIZE}', '{HOT_SLIDE}').end AS window_end
                FROM eventide_hot_items_t
                GROUP BY window(ts, '{HOT_SIZE}', '{HOT_SLIDE}'), item_id))
        WHERE row_num <= {HOT_N}""")


def _urls(spark, sf):
    return events(spark, sf).select(F.concat(F.lit("/user/"), F.col("user_id")).alias("url"), "ts")


def q_url_rank_all(spark, sf):
    return topn.url_ranking(_urls(spark, sf), size=URL_SIZE, slide=URL_SLIDE, n=None) \
        .select("window_end", "url", "views", "rank")


def q_url_rank_top5(spark, sf):
    return topn.url_ranking(_urls(spark, sf), size=URL_SIZE, slide=URL_SLIDE, n=URL_N) \
        .select("window_end", "url", "views", "rank")


def q_page_views(spark, sf):
    return windows.page_views(user_behavior(spark, sf), size=PV_SIZE, behavior=PV)


def _views(spark, sf):
    return user_behavior(spark, sf).filter(F.col("behavior") == PV)


def q_uv_exact(spark, sf):
    return distinct.uv_exact(_views(spark, sf), size=UV_SIZE)


def q_uv_bitmap(spark, sf):
    return distinct.uv_bitmap(_views(spark, sf), size=UV_SIZE)


def q_uv_bitmap_incremental(spark, sf):
    v = _views(spark, sf)
    cut = F.lit(INCREMENTAL_CUT).cast("timestamp_ntz")
    run1 = distinct.window_bitmaps(v.filter(F.col("ts") < cut), size=UV_SIZE)
    run2 = distinct.window_bitmaps(v.filter(F.col("ts") >= cut), size=UV_SIZE)
    store = BitmapStore(spark, scratch_path(spark, "uv-store"))
    store.merge(run1)
    store.merge(run2)
    return store.counts()


def q_uv_bloom(spark, sf):
    return distinct.uv_bloom(_views(spark, sf), size=UV_SIZE)


def q_uv_hll(spark, sf):
    """The sketch is Spark's own, so the estimate is held against the exact
    count: within five standard errors or not."""
    v, rsd = _views(spark, sf), 0.01
    both = distinct.uv_hll(v, size=UV_SIZE, rsd=rsd).join(distinct.uv_exact(v, size=UV_SIZE), "window_end")
    return both.select("window_end", "uv_count", (
        F.abs(F.col("uv_estimate") - F.col("uv_count")) <= F.greatest(F.lit(1.0), 5 * rsd * F.col("uv_count")))
        .alias("within_tolerance"))


def _marketing(spark, sf):
    ch = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]),
                      (F.col("user_id") % len(CHANNELS) + 1).cast("int"))
    return events(spark, sf).select(F.col("user_id"), F.col("event_type").alias("behavior"),
                                    ch.alias("channel"), "ts")


def q_marketing_total(spark, sf):
    return windows.marketing_total(_marketing(spark, sf), "ts", MKT_SIZE, MKT_SLIDE,
                                   exclude=SIGNUP)


def q_marketing_by_channel(spark, sf):
    return windows.marketing_by_channel(_marketing(spark, sf), "ts", MKT_SIZE, MKT_SLIDE,
                                        exclude=SIGNUP)


def _clicks(spark, sf):
    return events(spark, sf).select("event_id", "user_id", F.col("event_type").alias("ad_id"),
                                    "ts")


def _gated(spark, sf):
    return gate.click_gate(_clicks(spark, sf), keys=["user_id", "ad_id"], max_count=GATE_MAX,
                           period=None, seq="event_id")


def q_ad_gate_pass(spark, sf):
    return gate.gate_passed(_gated(spark, sf))


def q_ad_gate_warn(spark, sf):
    return gate.gate_warnings(_gated(spark, sf))


def q_ad_gate_daily(spark, sf):
    return gate.click_gate(_clicks(spark, sf), keys=["user_id", "ad_id"],
                           max_count=GATE_DAILY_MAX, period="1 day", seq="event_id")


def q_ad_by_geo(spark, sf):
    passed = gate.gate_passed(_gated(spark, sf)).withColumnRenamed("ad_id", "province")
    return windows.count_by_key_per_window(passed, "ts", GEO_SIZE, GEO_SLIDE, "province")


def _logins(spark, sf):
    return events(spark, sf).select("event_id", "user_id", "event_type", "ts")


def q_login_fail_strict(spark, sf):
    is_fail = F.col("event_type") == ERROR
    return sequence.strict_next(_logins(spark, sf), ["user_id"], "ts", is_fail, is_fail,
                                LOGIN_WITHIN, seq="event_id", msg=sequence.MSG_STRICT)


def q_login_fail_arrival(spark, sf):
    is_fail = F.col("event_type") == ERROR
    return sequence.strict_next(_logins(spark, sf), ["user_id"], "ts", is_fail, is_fail,
                                LOGIN_WITHIN, order=["event_id"], msg=sequence.MSG_ARRIVAL)


def q_login_fail_burst(spark, sf):
    return sequence.burst_warnings(_logins(spark, sf), ["user_id"], "ts",
                                   F.col("event_type") == ERROR, BURST_WITHIN, min_count=2)


def q_order_timeout_cep(spark, sf):
    ev = events(spark, sf).select(F.col("user_id").alias("order_id"), "event_type", "ts")
    return sequence.followed_by(ev, ["order_id"], "ts", F.col("event_type") == SIGNUP,
                                F.col("event_type") == PURCHASE, ORDER_WITHIN)


def q_pattern_two_stages(spark, sf):
    """An error and, some time later, a purchase."""
    kind = F.col("event_type")
    return pattern.match_pattern(events(spark, sf), ["user_id"], "ts", [
        pattern.Stage("error", kind == ERROR), pattern.Stage("purchase", kind == PURCHASE)], PAIR_WITHIN, seq="event_id")


def q_pattern_three_stages(spark, sf):
    """A signup, the first view after it, and a purchase as the very next event."""
    kind = F.col("event_type")
    return pattern.match_pattern(events(spark, sf), ["user_id"], "ts", [
        pattern.Stage("signup", kind == SIGNUP), pattern.Stage("view", kind == PV),
        pattern.Stage("purchase", kind == PURCHASE, strict=True)], TRIPLE_WITHIN, seq="event_id")


def order_log(spark, sf) -> DataFrame:
    """create = order date, pay = each line's ship date (first one counts)."""
    creates = _read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.lit("create").alias("event_type"),
        F.col("o_orderdate").alias("ts"))
    pays = _read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.lit("pay").alias("event_type"),
        F.col("l_shipdate").alias("ts"))
    return creates.unionByName(pays)


def q_order_outcomes(spark, sf):
    return orders.order_outcomes(order_log(spark, sf), within=OUTCOME_WITHIN)


def q_order_deadline(spark, sf):
    return orders.decide_at_deadline(order_log(spark, sf), within=OUTCOME_WITHIN)


def q_tx_reconcile(spark, sf):
    pays = reconciliation.with_tx(_read(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("tx_id"), F.col("o_orderdate").alias("pay_ts")))
    receipts = (_read(spark, sf, "lineitem").groupBy("l_orderkey")
                .agg(F.min("l_shipdate").alias("receipt_ts"))
                .select(F.col("l_orderkey").cast("string").alias("tx_id"), "receipt_ts"))
    return reconciliation.reconcile(pays, receipts, TX_TOLERANCE)


def _reused_ids(spark, sf):
    """Ids that are used again and again: customers on the one side, parts on
    the other, by number."""
    pays = _read(spark, sf, "orders").select(
        F.col("o_custkey").alias("tx_id"), F.col("o_orderdate").alias("pay_ts"), F.col("o_orderkey").alias("pay_no"))
    receipts = _read(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("tx_id"), F.col("l_shipdate").alias("receipt_ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("receipt_no"))
    return pays, receipts


def q_tx_reconcile_once(spark, sf):
    pays, receipts = _reused_ids(spark, sf)
    once = reconciliation.reconcile_once(pays, receipts, ONCE_TOLERANCE, pay_seq="pay_no", receipt_seq="receipt_no")
    return once.withColumns({c: F.col(c).cast("string") for c in ("pay_no", "receipt_no")})


def q_running_count(spark, sf):
    docs = _read(spark, sf, "documents").select("text")
    return windows.running_count(windows.words(docs), "word")


def q_select_star(spark, sf):
    user_behavior(spark, sf).createOrReplaceTempView("user_behavior")
    return spark.sql("select * from user_behavior")


def q_access_log_parse(spark, sf):
    ev = events(spark, sf).select(
        F.concat(F.lit("10.0.0."), F.col("user_id")).alias("ip"),
        F.col("user_id").cast("string").alias("user_id"), "ts", F.lit("GET").alias("method"),
        F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("event_id")).alias("url"))
    parsed = parse_access_log(format_access_log(ev))
    return parsed.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_csv_roundtrip(spark, sf):
    ev = events(spark, sf)
    lines = format_lines(ev, [F.concat(F.lit(" "), F.col("user_id").cast("string")),
                              F.col("event_id"), F.lit(1), F.col("event_type"),
                              F.concat(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"),
                                       F.lit(" "))])
    parsed = parse_lines(lines, "user_behavior")
    return parsed.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _seconds(col: str = "ts"):
    return F.unix_seconds(F.col(col).cast("timestamp"))


def _scanned(spark, rows: DataFrame, columns: list, kind: str) -> DataFrame:
    """``rows`` written as headerless delimited files, and read from there."""
    path = scratch_path(spark, f"files-{kind}")
    format_lines(rows, columns).write.text(path)
    return read_delimited(spark, path, kind).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_file_hot_items(spark, sf):
    rows = _scanned(spark, events(spark, sf), ["user_id", "user_id", F.lit("1"), "event_type", _seconds().cast("string")],
                    "user_behavior")
    return topn.hot_items(rows, size=HOT_SIZE, slide=HOT_SLIDE, n=HOT_N,
                          behavior=PV).select("window_end", "item_id", "item_count", "row_num")


def q_file_ad_clicks(spark, sf):
    return _scanned(spark, events(spark, sf), ["user_id", "event_id", "event_type", F.concat(F.lit(" city "), F.col("event_type")),
                                               _seconds().cast("string")], "ad_click")


def q_file_logins(spark, sf):
    return _scanned(spark, events(spark, sf), ["user_id", F.concat(F.lit("10.0.0."), F.col("event_id")), "event_type",
                                               _seconds().cast("string")], "login")


def q_file_orders(spark, sf):
    creates = _read(spark, sf, "orders").select("o_orderkey", F.lit("create").alias("kind"), F.lit("").alias("tx"),
                                                F.col("o_orderdate").alias("ts"))
    pays = _read(spark, sf, "lineitem").select(
        "l_orderkey", F.lit("pay"), F.concat(F.lit("tx"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")),
        F.col("l_shipdate"))
    return _scanned(spark, creates.union(pays), ["o_orderkey", "kind", "tx", _seconds().cast("string")], "order")


def q_file_receipts(spark, sf):
    rows = _read(spark, sf, "lineitem")
    return _scanned(spark, rows, [F.concat(F.lit("tx"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")), "l_returnflag",
                                  _seconds("l_shipdate").cast("string")], "receipt")


def q_file_marketing(spark, sf):
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return _scanned(spark, events(spark, sf), [F.concat(F.lit("u-"), F.col("user_id")), "event_type", F.lit("wechat"), ms],
                    "marketing")


def q_report_text(spark, sf):
    ranked = q_hot_items_topn(spark, sf)
    return topn.ranked_report(ranked, "item_id", "item_count", HOT_N, style="items")


def q_url_report_text(spark, sf):
    ranked = q_url_rank_top5(spark, sf)
    return topn.ranked_report(ranked, "url", "views", URL_N, rank_col="rank", style="urls")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hot_items_topn": q_hot_items_topn,
    "hot_items_sql": q_hot_items_sql,
    "url_rank_all": q_url_rank_all,
    "url_rank_top5": q_url_rank_top5,
    "page_views": q_page_views,
    "uv_exact": q_uv_exact,
    "uv_bitmap": q_uv_bitmap,
    "uv_bitmap_incremental": q_uv_bitmap_incremental,
    "uv_bloom": q_uv_bloom,
    "uv_hll": q_uv_hll,
    "marketing_total": q_marketing_total,
    "marketing_by_channel": q_marketing_by_channel,
    "ad_gate_pass": q_ad_gate_pass,
    "ad_gate_warn": q_ad_gate_warn,
    "ad_gate_daily": q_ad_gate_daily,
    "ad_by_geo": q_ad_by_geo,
    "login_fail_strict": q_login_fail_strict,
    "login_fail_arrival": q_login_fail_arrival,
    "login_fail_burst": q_login_fail_burst,
    "order_timeout_cep": q_order_timeout_cep,
    "order_outcomes": q_order_outcomes,
    "order_deadline": q_order_deadline,
    "tx_reconcile": q_tx_reconcile,
    "tx_reconcile_once": q_tx_reconcile_once,
    "running_count": q_running_count,
    "select_star": q_select_star,
    "access_log_parse": q_access_log_parse,
    "csv_roundtrip": q_csv_roundtrip,
    "pattern_two_stages": q_pattern_two_stages,
    "pattern_three_stages": q_pattern_three_stages,
    "file_hot_items": q_file_hot_items,
    "file_ad_clicks": q_file_ad_clicks,
    "file_logins": q_file_logins,
    "file_orders": q_file_orders,
    "file_receipts": q_file_receipts,
    "file_marketing": q_file_marketing,
    "report_text": q_report_text,
    "url_report_text": q_url_report_text,
}


# ------------------------------------------------------------- DuckDB oracles
def _us(d) -> int:
    return duration_micros(d)


def _sliding(ts: str, size: str, slide: str) -> tuple[str, str]:
    """(select-list items, window_end expr) for epoch-aligned sliding windows:
    one row per window containing ``ts``; needs ``k`` from the unnest."""
    sz, sl = _us(size), _us(slide)
    n = sz // sl
    start = f"make_timestamp(epoch_us({ts}) // {sl} * {sl} - k * {sl})"
    return f"unnest(range(0, {n})) AS k", start


def _tumble_start(ts: str, size: str) -> str:
    s = _us(size)
    return f"make_timestamp(epoch_us({ts}) // {s} * {s})"


def _java_ts(t: str) -> str:
    frac = f"rtrim(lpad(CAST(microsecond({t}) % 1000000 AS VARCHAR), 6, '0'), '0')"
    return (f"(strftime({t}, '%Y-%m-%d %H:%M:%S') || '.' || "
            f"CASE WHEN {frac} = '' THEN '0' ELSE {frac} END)")


def _poly(col: str, bits: int) -> str:
    mask = (1 << bits) - 1
    return (f"list_reduce(string_split(CAST({col} AS VARCHAR), ''), "
            f"lambda a, c: (a * {BITMAP_HASH_SEED} + ascii(c)) & {mask}, 0::BIGINT)")


def _hot_items_sql() -> str:
    k, start = _sliding("ts", HOT_SIZE, HOT_SLIDE)
    return f"""
      WITH w AS (SELECT user_id AS item_id, ts, {k} FROM events WHERE event_type = '{PV}'),
      c AS (SELECT {start} + INTERVAL '{HOT_SIZE}' AS window_end, item_id, count(*) AS item_count
            FROM w GROUP BY 1, 2),
      r AS (SELECT *, row_number() OVER (PARTITION BY window_end
                                         ORDER BY item_count DESC, item_id) AS row_num FROM c)
      SELECT window_end, item_id, item_count, row_num FROM r WHERE row_num <= {HOT_N}"""


def _url_rank_sql(limit: int | None) -> str:
    k, start = _sliding("ts", URL_SIZE, URL_SLIDE)
    where = f"WHERE rank <= {limit}" if limit else ""
    return f"""
      WITH w AS (SELECT '/user/' || user_id AS url, ts, {k} FROM events),
      c AS (SELECT {start} + INTERVAL '{URL_SIZE}' AS window_end, url, count(*) AS views
            FROM w GROUP BY 1, 2),
      r AS (SELECT *, row_number() OVER (PARTITION BY window_end
                                         ORDER BY views DESC, url) AS rank FROM c)
      SELECT window_end, url, views, rank FROM r {where}"""


def _uv_day(expr: str, where: str = "") -> str:
    start = _tumble_start("ts", UV_SIZE)
    return f"""SELECT {start} + INTERVAL '{UV_SIZE}' AS window_end, {expr}
               FROM events WHERE event_type = '{PV}' {where} GROUP BY 1"""


def _bloom_sql() -> str:
    m, k = bloom_size(distinct.BLOOM_EXPECTED_INSERTIONS, distinct.BLOOM_FPP)
    P = MERSENNE_31
    poss = ", ".join(f"(((x * x) % {P} * {a}) % {P} + (x * {b}) % {P} + {a}) % {P} % {m}"
                     for a, b in bloom_coefficients(k))
    start = _tumble_start("ts", UV_SIZE)
    return f"""
      WITH h AS (SELECT {start} + INTERVAL '{UV_SIZE}' AS window_end, {_poly('user_id', 31)} AS x
                 FROM events WHERE event_type = '{PV}'),
      p AS (SELECT window_end, unnest([{poss}]) AS pos FROM h)
      SELECT window_end,
             CAST(round(-({m}.0 / {k}) * ln(1 - CAST(count(DISTINCT pos) AS DOUBLE) / {m}))
                  AS BIGINT) AS uv_estimate
      FROM p GROUP BY 1"""


def _marketing_sql(by_channel: bool) -> str:
    k, start = _sliding("ts", MKT_SIZE, MKT_SLIDE)
    chans = ", ".join(f"'{c}'" for c in CHANNELS)
    channel = f"[{chans}][user_id % {len(CHANNELS)} + 1]" if by_channel else "'app marketing'"
    behavior = "event_type" if by_channel else "'total'"
    return f"""
      WITH w AS (SELECT {channel} AS channel, {behavior} AS behavior, ts, {k}
                 FROM events WHERE event_type <> '{SIGNUP}'),
      c AS (SELECT {start} AS window_start, channel, behavior, count(*) AS count
            FROM w GROUP BY 1, 2, 3)
      SELECT window_start, window_start + INTERVAL '{MKT_SIZE}' AS window_end,
             {_java_ts('window_start')} AS window_start_text,
             {_java_ts("window_start + INTERVAL '" + MKT_SIZE + "'")} AS window_end_text,
             channel, behavior, count FROM c"""


_GATE_RN = """(SELECT event_id, user_id, event_type AS ad_id, ts,
                 row_number() OVER (PARTITION BY user_id, event_type{part}
                                    ORDER BY ts, event_id) AS rn FROM events)"""


def _lag_sql(order: str, msg: str) -> str:
    w = _us(LOGIN_WITHIN)
    return f"""
      WITH l AS (SELECT user_id, ts, event_type = '{ERROR}' AS fail,
                        lag(ts) OVER (PARTITION BY user_id ORDER BY {order}) AS pts,
                        lag(event_type = '{ERROR}') OVER (PARTITION BY user_id ORDER BY {order}) AS pfail
                 FROM events)
      SELECT user_id, pts AS first_ts, ts AS last_ts, '{msg}' AS msg FROM l
      WHERE fail AND pfail AND epoch_us(ts) < epoch_us(pts) + {w}"""


def _burst_sql() -> str:
    w = _us(BURST_WITHIN)
    closes = f"(w.cs IS NOT NULL AND epoch_us(e.ts) > epoch_us(w.cs) + {w})"
    msg = f"'{sequence.MSG_BURST_PREFIX}' || CAST({{n}} AS VARCHAR) || '{sequence.MSG_BURST_SUFFIX}'"
    return f"""
      WITH RECURSIVE ev AS (
        SELECT user_id, ts, event_type = '{ERROR}' AS fail,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
      walk AS (
        SELECT user_id, rn, CASE WHEN fail THEN ts END AS cs, CASE WHEN fail THEN 1 ELSE 0 END AS cnt,
               CASE WHEN fail THEN ts END AS lastf, NULL::TIMESTAMP AS ef, NULL::TIMESTAMP AS el,
               NULL::BIGINT AS en
        FROM ev WHERE rn = 1
        UNION ALL
        SELECT e.user_id, e.rn,
               CASE WHEN e.fail THEN CASE WHEN w.cs IS NULL OR {closes} THEN e.ts ELSE w.cs END END,
               CASE WHEN e.fail THEN CASE WHEN w.cs IS NULL OR {closes} THEN 1 ELSE w.cnt + 1 END
                    ELSE 0 END,
               CASE WHEN e.fail THEN e.ts END,
               CASE WHEN {closes} AND w.cnt >= 2 THEN w.cs END,
               CASE WHEN {closes} AND w.cnt >= 2 THEN w.lastf END,
               CASE WHEN {closes} AND w.cnt >= 2 THEN w.cnt END
        FROM walk w JOIN ev e ON e.user_id = w.user_id AND e.rn = w.rn + 1)
      SELECT user_id, ef AS first_ts, el AS last_ts, {msg.format(n='en')} AS msg
      FROM walk WHERE ef IS NOT NULL
      UNION ALL
      SELECT w.user_id, w.cs, w.lastf, {msg.format(n='w.cnt')}
      FROM walk w JOIN (SELECT user_id, max(rn) AS mx FROM ev GROUP BY 1) m
        ON w.user_id = m.user_id AND w.rn = m.mx
      WHERE w.cs IS NOT NULL AND w.cnt >= 2"""


def _order_times_sql() -> str:
    return """
      (SELECT order_id, min(CASE WHEN t = 'create' THEN ts END) AS create_ts,
              min(CASE WHEN t = 'pay' THEN ts END) AS pay_ts
       FROM (SELECT o_orderkey AS order_id, 'create' AS t, o_orderdate AS ts FROM orders
             UNION ALL SELECT l_orderkey, 'pay', l_shipdate FROM lineitem) GROUP BY 1)"""


def _outcomes_sql() -> str:
    w = _us(OUTCOME_WITHIN)
    return f"""
      SELECT order_id, create_ts, pay_ts, result_msg,
             CASE WHEN result_msg = '{orders.MSG_PAYED}' THEN 'payed' ELSE 'timeout' END AS tag
      FROM (SELECT *, CASE
              WHEN create_ts IS NOT NULL AND pay_ts IS NOT NULL
                   AND epoch_us(pay_ts) < epoch_us(create_ts) + {w} THEN '{orders.MSG_PAYED}'
              WHEN create_ts IS NOT NULL AND pay_ts IS NOT NULL THEN '{orders.MSG_PAYED_LATE}'
              WHEN create_ts IS NOT NULL THEN '{orders.MSG_ORDER_TIMEOUT}'
              ELSE '{orders.MSG_PAY_NO_CREATE}' END AS result_msg
            FROM {_order_times_sql()})"""


def _deadline_sql() -> str:
    w = _us(OUTCOME_WITHIN)
    return f"""
      SELECT order_id, create_ts,
             CASE WHEN epoch_us(pay_ts) <= epoch_us(create_ts) + {w} THEN pay_ts END AS pay_ts,
             CASE WHEN pay_ts IS NOT NULL AND epoch_us(pay_ts) <= epoch_us(create_ts) + {w}
                  THEN '{orders.MSG_DEADLINE_PAYED}' ELSE '{orders.MSG_ORDER_TIMEOUT}' END AS result_msg
      FROM {_order_times_sql()}
      WHERE create_ts IS NOT NULL AND (pay_ts IS NULL OR pay_ts >= create_ts)"""


def _report_sql() -> str:
    hdr = _java_ts("window_end - INTERVAL 1 MILLISECOND")
    return f"""
      WITH r AS ({_hot_items_sql()})
      SELECT window_end,
             '时间：' || {hdr} || chr(10) ||
             string_agg('No' || row_num || ':' || ' 商品ID=' || item_id || ' 浏览量=' || item_count
                        || chr(10), '' ORDER BY row_num) ||
             '{'=' * 34}' AS report
      FROM r GROUP BY window_end"""


def _url_report_sql() -> str:
    return f"""
      WITH r AS ({_url_rank_sql(URL_N)})
      SELECT window_end,
             'time: ' || {_java_ts('window_end')} || chr(10) ||
             string_agg('No' || rank || ':' || ' URL = ' || url || ' views = ' || views
                        || chr(10), '' ORDER BY rank) ||
             '{'*' * 30}' AS report
      FROM r GROUP BY window_end"""


def _oracles() -> dict[str, str]:
    pv_start = _tumble_start("ts", PV_SIZE)
    gk, gstart = _sliding("ts", GEO_SIZE, GEO_SLIDE)
    tol = _us(TX_TOLERANCE)
    ow = _us(ORDER_WITHIN)
    return {
        "hot_items_topn": _hot_items_sql(),
        "hot_items_sql": _hot_items_sql(),
        "file_hot_items": _hot_items_sql(),
        "url_rank_all": _url_rank_sql(None),
        "url_rank_top5": _url_rank_sql(URL_N),
        "page_views": f"""
          SELECT {pv_start} AS window_start, {pv_start} + INTERVAL '{PV_SIZE}' AS window_end,
                 count(*) AS pv
          FROM events WHERE event_type = '{PV}' GROUP BY 1""",
        "uv_exact": _uv_day("count(DISTINCT user_id) AS uv_count"),
        "uv_bitmap": _uv_day(f"count(DISTINCT {_poly('user_id', 29)}) AS uv_count"),
        "uv_bitmap_incremental": _uv_day(f"count(DISTINCT {_poly('user_id', 29)}) AS uv_count"),
        "uv_bloom": _bloom_sql(),
        "uv_hll": _uv_day("count(DISTINCT user_id) AS uv_count, true AS within_tolerance"),
        "marketing_total": _marketing_sql(False),
        "marketing_by_channel": _marketing_sql(True),
        "ad_gate_pass": f"""SELECT event_id, user_id, ad_id, ts FROM {_GATE_RN.format(part='')}
                            WHERE rn <= {GATE_MAX + 1}""",
        "ad_gate_warn": f"""SELECT user_id, ad_id, ts, '{gate.gate_message(GATE_MAX)}' AS msg
                            FROM {_GATE_RN.format(part='')} WHERE rn = {GATE_MAX + 2}""",
        "ad_gate_daily": f"""
          SELECT event_id, user_id, ad_id, ts,
                 CASE WHEN rn <= {GATE_DAILY_MAX + 1} THEN 'pass' ELSE 'blacklist' END AS tag,
                 CASE WHEN rn = {GATE_DAILY_MAX + 2}
                      THEN '{gate.gate_message(GATE_DAILY_MAX)}' END AS msg
          FROM {_GATE_RN.format(part=", date_trunc('day', ts)")} WHERE rn <= {GATE_DAILY_MAX + 2}""",
        "ad_by_geo": f"""
          WITH p AS (SELECT ad_id AS province, ts, {gk}
                     FROM {_GATE_RN.format(part='')} WHERE rn <= {GATE_MAX + 1}),
          c AS (SELECT {gstart} + INTERVAL '{GEO_SIZE}' AS window_end, province, count(*) AS count
                FROM p GROUP BY 1, 2)
          SELECT window_end, CAST(epoch_ms(window_end) AS VARCHAR) AS window_end_ms, province, count
          FROM c""",
        "login_fail_strict": _lag_sql("ts, event_id", sequence.MSG_STRICT),
        "login_fail_arrival": _lag_sql("event_id", sequence.MSG_ARRIVAL),
        "login_fail_burst": _burst_sql(),
        "order_timeout_cep": f"""
          WITH s AS (SELECT user_id AS order_id, ts AS start_ts,
                            (SELECT min(p.ts) FROM events p WHERE p.user_id = e.user_id
                               AND p.event_type = '{PURCHASE}' AND p.ts >= e.ts) AS nxt
                     FROM events e WHERE e.event_type = '{SIGNUP}')
          SELECT order_id, start_ts,
                 CASE WHEN epoch_us(nxt) < epoch_us(start_ts) + {ow} THEN nxt END AS match_ts,
                 CASE WHEN epoch_us(nxt) < epoch_us(start_ts) + {ow}
                      THEN '{sequence.MSG_PAYED}' ELSE '{sequence.MSG_TIMEOUT}' END AS result_msg,
                 CASE WHEN epoch_us(nxt) < epoch_us(start_ts) + {ow}
                      THEN 'matched' ELSE 'timeout' END AS tag
          FROM s""",
        "order_outcomes": _outcomes_sql(),
        "order_deadline": _deadline_sql(),
        "tx_reconcile": f"""
          WITH p AS (SELECT CAST(o_orderkey AS VARCHAR) AS tx_id, o_orderdate AS pay_ts FROM orders),
          r AS (SELECT CAST(l_orderkey AS VARCHAR) AS tx_id, min(l_shipdate) AS receipt_ts
                FROM lineitem GROUP BY l_orderkey)
          SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, p.pay_ts, r.receipt_ts,
                 CASE WHEN p.tx_id IS NOT NULL AND r.tx_id IS NOT NULL THEN 'matched'
                      WHEN p.tx_id IS NOT NULL THEN 'unmatched_pay'
                      ELSE 'unmatched_receipt' END AS tag
          FROM p FULL OUTER JOIN r ON p.tx_id = r.tx_id
               AND abs(epoch_us(p.pay_ts) - epoch_us(r.receipt_ts)) <= {tol}""",
        "tx_reconcile_once": f"""
          WITH RECURSIVE e AS (
            SELECT *, row_number() OVER (PARTITION BY tx ORDER BY ts, side, no) AS rn FROM (
              SELECT o_custkey AS tx, o_orderdate AS ts, 0 AS side, o_orderkey AS no FROM orders
              UNION ALL
              SELECT l_partkey, l_shipdate, 1, l_orderkey * 10 + l_linenumber FROM lineitem)),
          w AS (
            SELECT tx, rn, ts, side, no, true AS is_open, false AS took FROM e WHERE rn = 1
            UNION ALL
            SELECT e.tx, e.rn, e.ts, e.side, e.no, NOT m.took, m.took
            FROM w JOIN e ON e.tx = w.tx AND e.rn = w.rn + 1,
            LATERAL (SELECT w.is_open AND w.side <> e.side
                            AND epoch_us(e.ts) - epoch_us(w.ts) <= {duration_micros(ONCE_TOLERANCE)} AS took) m),
          n AS (SELECT *, lead(took) OVER x AS given, lag(ts) OVER x AS ts0, lag(no) OVER x AS no0
                FROM w WINDOW x AS (PARTITION BY tx ORDER BY rn))
          SELECT tx AS tx_id, CASE WHEN side = 0 THEN ts WHEN took THEN ts0 END AS pay_ts,
                 CAST(CASE WHEN side = 0 THEN no WHEN took THEN no0 END AS VARCHAR) AS pay_no,
                 CASE WHEN side = 1 THEN ts WHEN took THEN ts0 END AS receipt_ts,
                 CAST(CASE WHEN side = 1 THEN no WHEN took THEN no0 END AS VARCHAR) AS receipt_no,
                 CASE WHEN took THEN 'matched' WHEN side = 0 THEN 'unmatched_pay'
                      ELSE 'unmatched_receipt' END AS tag
          FROM n WHERE took OR (is_open AND NOT coalesce(given, false))""",
        "running_count": r"""
          SELECT word, count(*) AS count FROM (
            SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f]+')) AS word FROM documents)
          WHERE word <> '' GROUP BY word""",
        "select_star": """SELECT event_id, user_id, user_id AS item_id, event_type AS behavior, ts
                          FROM events""",
        "access_log_parse": """
          SELECT '10.0.0.' || user_id AS ip, CAST(user_id AS VARCHAR) AS user_id,
                 date_trunc('second', ts) AS ts, 'GET' AS method,
                 '/' || event_type || '/' || event_id AS url FROM events""",
        "csv_roundtrip": """
          SELECT user_id, event_id AS item_id, 1 AS category_id, event_type AS behavior,
                 date_trunc('second', ts) AS ts FROM events""",
        "pattern_two_stages": f"""
          WITH w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
          s AS (SELECT *, min(CASE WHEN event_type = '{PURCHASE}' THEN ts END) OVER
                  (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS p FROM w),
          m AS (SELECT user_id, ts, CASE WHEN epoch_us(p) - epoch_us(ts) < {_us(PAIR_WITHIN)} THEN p END AS p
                FROM s WHERE event_type = '{ERROR}')
          SELECT user_id, ts AS error_ts, p AS purchase_ts, CASE WHEN p IS NULL THEN 1 ELSE 2 END AS n_matched,
                 CASE WHEN p IS NULL THEN 'timeout' ELSE 'matched' END AS tag FROM m""",
        "pattern_three_stages": f"""
          WITH w AS (SELECT *, row_number() OVER x AS rn, lead(event_type) OVER x AS next_type, lead(ts) OVER x AS next_ts
                     FROM events WINDOW x AS (PARTITION BY user_id ORDER BY ts, event_id)),
          s AS (SELECT *, min(CASE WHEN event_type = '{PV}' THEN rn END) OVER
                  (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS vrn FROM w),
          m AS (SELECT s.user_id, s.ts, v.next_type, CASE WHEN epoch_us(v.ts) - epoch_us(s.ts) < {_us(TRIPLE_WITHIN)} THEN v.ts END AS v,
                       CASE WHEN epoch_us(v.next_ts) - epoch_us(s.ts) < {_us(TRIPLE_WITHIN)} THEN v.next_ts END AS x
                FROM s LEFT JOIN w v ON v.user_id = s.user_id AND v.rn = s.vrn WHERE s.event_type = '{SIGNUP}'),
          t AS (SELECT *, CASE WHEN x IS NULL THEN 'timeout' WHEN next_type = '{PURCHASE}' THEN 'matched' ELSE 'broken' END AS tag
                FROM m)
          SELECT user_id, ts AS signup_ts, v AS view_ts, CASE WHEN tag = 'matched' THEN x END AS purchase_ts,
                 CASE WHEN tag = 'matched' THEN 3 WHEN v IS NOT NULL THEN 2 ELSE 1 END AS n_matched, tag FROM t""",
        "file_ad_clicks": """
          SELECT user_id, event_id AS ad_id, event_type AS province, 'city ' || event_type AS city,
                 date_trunc('second', ts) AS ts FROM events""",
        "file_logins": """
          SELECT user_id, '10.0.0.' || event_id AS ip, event_type, date_trunc('second', ts) AS ts FROM events""",
        "file_orders": """
          SELECT o_orderkey AS order_id, 'create' AS event_type, '' AS tx_id, CAST(o_orderdate AS TIMESTAMP) AS ts FROM orders
          UNION ALL SELECT l_orderkey, 'pay', 'tx' || l_orderkey || '-' || l_linenumber, CAST(l_shipdate AS TIMESTAMP)
          FROM lineitem""",
        "file_receipts": """
          SELECT 'tx' || l_orderkey || '-' || l_linenumber AS tx_id, l_returnflag AS pay_channel,
                 CAST(l_shipdate AS TIMESTAMP) AS ts FROM lineitem""",
        "file_marketing": """
          SELECT 'u-' || user_id AS user_id, event_type AS behavior, 'wechat' AS channel,
                 date_trunc('millisecond', ts) AS ts FROM events""",
        "report_text": _report_sql(),
        "url_report_text": _url_report_sql(),
    }


ORACLE_SQL: dict[str, str] = _oracles()
