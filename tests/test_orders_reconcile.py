from pyspark.sql import functions as F

import pytest

from eventide.operators import decide_at_deadline, order_outcomes, reconcile, with_tx
from eventide.sources import parse_lines
from tests.fixtures import ORDER_KEY_LINES, TX_PAIRS, at, epoch


def _orders(spark):
    return parse_lines(spark.createDataFrame([(l,) for l in ORDER_KEY_LINES], "value string"),
                       "order")


def test_order_outcomes_one_per_order(spark):
    got = {r.order_id: r.result_msg for r in order_outcomes(_orders(spark)).collect()}
    assert got == {34730: "order timeout", 34747: "payed successfully",
                   34756: "payed but already timeout", 34767: "payed but already timeout",
                   34768: "already payed but not found create log"}


def test_pay_before_create_counts_as_payed(spark):
    df = spark.createDataFrame([(1, "pay", epoch(100)), (1, "create", epoch(160))],
                               "order_id long, event_type string, ts timestamp")
    assert order_outcomes(df).first().result_msg == "payed successfully"
    assert decide_at_deadline(df).count() == 0        # no deadline is set


def test_decide_at_deadline(spark):
    got = {r.order_id: r.result_msg for r in decide_at_deadline(_orders(spark)).collect()}
    assert got == {34730: "order timeout", 34747: "order payed successfully",
                   34756: "order timeout", 34767: "order timeout"}


def test_reconcile_pairs_and_tolerance_edges(spark):
    pays = [(tx, epoch(p)) for _, tx, p, _ in TX_PAIRS] + [("only-pay", epoch(10)), ("far", epoch(100))]
    rcps = [(tx, "wechat", epoch(r)) for _, tx, _, r in TX_PAIRS] + \
           [("only-rcpt", "alipay", epoch(20)), ("far", "alipay", epoch(106)), ("", "x", epoch(1))]
    p = with_tx(spark.createDataFrame(pays, "tx_id string, pay_ts timestamp"))
    r = spark.createDataFrame(rcps, "tx_id string, pay_channel string, receipt_ts timestamp")
    got = {}
    for row in reconcile(p, r, "5 seconds").collect():
        got.setdefault(row.tag, set()).add(row.tx_id)
    assert got["matched"] == {tx for _, tx, _, _ in TX_PAIRS}          # 5 s apart still matches
    assert got["unmatched_pay"] == {"only-pay", "far"}                  # 6 s does not
    assert got["unmatched_receipt"] == {"only-rcpt", "far", ""}


def test_reconcile_reused_id_spreads_and_matches_by_time(spark):
    pays = [("t", epoch(1000 * i)) for i in range(50)]
    rcps = [("t", "c", epoch(1000 * i + 3)) for i in range(0, 50, 2)]
    out = reconcile(spark.createDataFrame(pays, "tx_id string, pay_ts timestamp"),
                    spark.createDataFrame(rcps, "tx_id string, pay_channel string, receipt_ts timestamp"),
                    "5 seconds")
    counts = {r.tag: r["count"] for r in out.groupBy("tag").count().collect()}
    assert counts == {"matched": 25, "unmatched_pay": 25}


def test_reconcile_equals_brute_force_interval_join(spark):
    import random
    import pytest
    rnd = random.Random(9)
    pays = [(f"t{rnd.randint(0, 15)}", epoch(rnd.randint(0, 400))) for _ in range(150)]
    rcps = [(f"t{rnd.randint(0, 15)}", "c", epoch(rnd.randint(0, 400))) for _ in range(150)]
    pdf = spark.createDataFrame(pays, "tx_id string, pay_ts timestamp")
    rdf = spark.createDataFrame(rcps, "tx_id string, pay_channel string, receipt_ts timestamp")
    near = lambda p, r: p[0] == r[0] and abs((p[1] - r[2]).total_seconds()) <= 5
    want_pairs = sorted((p[0], p[1], r[2]) for p in pays for r in rcps if near(p, r))
    want_lone_p = sorted((p[0], p[1]) for p in pays if not any(near(p, r) for r in rcps))
    want_lone_r = sorted((r[0], r[2]) for r in rcps if not any(near(p, r) for p in pays))
    for factor in (1, 3, 8):
        out = reconcile(pdf, rdf, "5 seconds", bucket_factor=factor).collect()
        assert sorted((o.tx_id, o.pay_ts, o.receipt_ts) for o in out if o.tag == "matched") == want_pairs
        assert sorted((o.tx_id, o.pay_ts) for o in out if o.tag == "unmatched_pay") == want_lone_p
        assert sorted((o.tx_id, o.receipt_ts) for o in out if o.tag == "unmatched_receipt") == want_lone_r


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_each_record_is_matched_once(spark, hot_rows):
    """A hot id with many records, ties, repeated records and rows without id
    or time, against the walk over each id's records."""
    import random

    from eventide.operators import reconcile_once

    rnd = random.Random(4)
    pays = [(rnd.choice(["hot", "a", "b", None]), at(rnd.randint(0, 400)), i // 2) for i in range(300)]
    rcps = [(rnd.choice(["hot", "a", "b", None]), at(rnd.randint(0, 400)), i // 2) for i in range(300)]
    pays += pays[:40] + [("hot", None, 900)]
    rcps += rcps[:40]
    got = reconcile_once(spark.createDataFrame(pays, "tx_id string, pay_ts timestamp, p int"),
                         spark.createDataFrame(rcps, "tx_id string, receipt_ts timestamp, r int"),
                         "3 seconds", pay_seq="p", receipt_seq="r", hot_rows=hot_rows).collect()
    want, by = [], {}
    for rows, side in ((pays, 0), (rcps, 1)):
        for tx, ts, no in rows:
            if tx is None or ts is None:
                want.append((str(tx), "u", side, no, None))
            else:
                by.setdefault(tx, []).append((ts, side, no))
    for tx, events in by.items():
        open_ = None
        for e in sorted(events):
            if open_ and open_[1] != e[1] and (e[0] - open_[0]).total_seconds() <= 3:
                p, r = (open_, e) if open_[1] == 0 else (e, open_)
                want.append((tx, "m", 0, p[2], r[2]))
                open_ = None
            else:
                if open_:
                    want.append((tx, "u", open_[1], open_[2], None))
                open_ = e
        if open_:
            want.append((tx, "u", open_[1], open_[2], None))
    mine = [(str(g.tx_id), "m", 0, g.p, g.r) if g.tag == "matched" else
            (str(g.tx_id), "u", *((0, g.p) if g.tag == "unmatched_pay" else (1, g.r)), None) for g in got]
    assert sorted(map(str, mine)) == sorted(map(str, want))


@pytest.mark.parametrize("hot_rows", [None, 100])
def test_runs_of_links_that_cross_many_cuts(spark, hot_rows):
    """One id whose records all link: parity is carried through every cut."""
    from eventide.operators import reconcile_once

    # 801 records one second apart, sides in turn, so all are one run of links
    pays = [("x", at(2 * i), i) for i in range(401)]
    rcps = [("x", at(2 * i + 1), i) for i in range(400)]
    got = reconcile_once(spark.createDataFrame(pays, "tx_id string, pay_ts timestamp, p int"),
                         spark.createDataFrame(rcps, "tx_id string, receipt_ts timestamp, r int"),
                         "1 second", hot_rows=hot_rows).collect()
    assert sorted((g.p, g.r) for g in got if g.tag == "matched") == [(i, i) for i in range(400)]
    assert [(g.p, g.r) for g in got if g.tag != "matched"] == [(400, None)]


def test_one_exchange_of_full_rows_and_one_scan_per_table(spark):
    from eventide.operators import reconcile_once

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = reconcile_once(spark.createDataFrame([("a", at(0), 1)], "tx_id string, pay_ts timestamp, p int"),
                            spark.createDataFrame([("a", at(1), 1)], "tx_id string, receipt_ts timestamp, r int"))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert plan.count("Scan ExistingRDD") == 2 and plan.count("+- Sort [") == 1
