"""Two-stream reconciliation (JOIN-1, FLT-3, SNK-3).

``reconcile`` gives every pair within the tolerance, which is one row per
record where ids are used once; an id used n times within the tolerance gives
up to n * n pairs.  ``reconcile_once`` gives every record exactly once, matched
or unmatched, however often an id is used.

Pays and receipts match on the transaction id when their times differ by at
most ``tolerance``.  Output has three tags: ``matched`` (both sides),
``unmatched_pay`` and ``unmatched_receipt``.

The join key is (tx_id, time bucket), so rows that share an id (a hot or
reused id) still spread over tasks.  Buckets are ``bucket_factor`` times the
tolerance wide; a row is also offered to a neighbouring bucket only when it
lies within the tolerance of that boundary (about 1 + 2/factor copies per
row), which finds every pair within the tolerance exactly once.  Unmatched
rows come from anti joins on the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.time import duration_micros, epoch_micros
from eventide.plans.ordered import volume_cuts

TAG_MATCHED = "matched"
TAG_UNMATCHED_PAY = "unmatched_pay"
TAG_UNMATCHED_RECEIPT = "unmatched_receipt"


def _bucket(ts: str, width_us: int) -> Column:
    # whole numbers throughout (a double is exact to 2^53 only)
    t, width = epoch_micros(ts), F.lit(width_us).cast("long")
    return F.call_function("div", t - F.pmod(t, width), width)


def with_tx(events: DataFrame, tx_col: str = "tx_id") -> DataFrame:
    """FLT-3: keep events that carry a transaction id (any event type)."""
    return events.filter(F.col(tx_col).isNotNull() & (F.col(tx_col) != ""))


def reconcile(pays: DataFrame, receipts: DataFrame, tolerance: str = "5 seconds",
              tx_col: str = "tx_id", pay_ts: str = "pay_ts", receipt_ts: str = "receipt_ts",
              bucket_factor: int = 4) -> DataFrame:
    """``pays`` and ``receipts`` share only ``tx_col``; other column names
    must be distinct.  Returns the union of all pay and receipt columns plus
    ``tag``."""
    tol_us = duration_micros(tolerance)
    width = max(tol_us, 1) * max(bucket_factor, 1)
    pay_cols = [c for c in pays.columns if c != tx_col]
    rcp_cols = [c for c in receipts.columns if c != tx_col]

    p = pays.withColumn("__b", _bucket(pay_ts, width))
    r = receipts.withColumn("__b", _bucket(receipt_ts, width))
    near = F.abs(epoch_micros(F.col(pay_ts)) - epoch_micros(F.col(receipt_ts))) <= tol_us

    def offered(df, ts):   # own bucket, plus a neighbour when within tol of its edge
        t = epoch_micros(F.col(ts))
        b = F.col("__b")
        lower = F.when(t - tol_us < b * width, b - 1)
        upper = F.when(t + tol_us >= (b + 1) * width, b + 1)
        return df.withColumn("__b", F.explode(F.filter(F.array(lower, b, upper),
                                                       lambda x: x.isNotNull())))

    r3 = offered(r, receipt_ts).withColumnRenamed(tx_col, "__rtx").withColumnRenamed("__b", "__rb")
    p3 = offered(p, pay_ts).withColumnRenamed(tx_col, "__ptx").withColumnRenamed("__b", "__pb")

    matched = (p.join(r3, (F.col(tx_col) == F.col("__rtx")) & (F.col("__b") == F.col("__rb")) & near)
               .select(tx_col, *pay_cols, *rcp_cols, F.lit(TAG_MATCHED).alias("tag")))
    lone_pays = (p.join(r3, (F.col(tx_col) == F.col("__rtx")) & (F.col("__b") == F.col("__rb"))
                        & near, "left_anti")
                 .select(tx_col, *pay_cols, *[F.lit(None).cast(receipts.schema[c].dataType).alias(c)
                                              for c in rcp_cols],
                         F.lit(TAG_UNMATCHED_PAY).alias("tag")))
    lone_rcps = (r.join(p3, (F.col(tx_col) == F.col("__ptx")) & (F.col("__b") == F.col("__pb"))
                        & near, "left_anti")
                 .select(tx_col, *[F.lit(None).cast(pays.schema[c].dataType).alias(c)
                                   for c in pay_cols], *rcp_cols,
                         F.lit(TAG_UNMATCHED_RECEIPT).alias("tag")))
    return matched.unionByName(lone_pays).unionByName(lone_rcps)


def reconcile_once(pays: DataFrame, receipts: DataFrame, tolerance: str = "5 seconds",
                   tx_col: str = "tx_id", pay_ts: str = "pay_ts", receipt_ts: str = "receipt_ts",
                   pay_seq: str | None = None, receipt_seq: str | None = None,
                   hot_rows: int | None = None) -> DataFrame:
    """Match each record at most once, with the open record of the other side.

    Records of an id are taken in time order; at equal times pays come first,
    then the ``seq`` columns decide (by default a hash of the record).  A
    record matches the open one if that is of the other side and not older than
    the tolerance; otherwise it becomes the open one itself, and the one it
    replaces is unmatched.  Same columns and tags as ``reconcile``; records
    without an id or time are unmatched.

    At most one record is open at a time, so matching is decided by parity:
    where neighbours could match (a *link*), the first matches the second, the
    third the fourth, and so on from the last neighbours that could not.  One
    exchange and one sort serve lag, position and the place of the last break
    together.  Ids with more than ``hot_rows`` records are cut by volume; per
    cut one summary (last record, number of records, length of the run of links
    at its end) is carried into the next one.
    """
    tol_us = duration_micros(tolerance)
    pay_cols = [c for c in pays.columns if c != tx_col]
    rcp_cols = [c for c in receipts.columns if c != tx_col]
    p_type, r_type = (F.struct(*[df[c].alias(c) for c in cols]) for df, cols in
                      ((pays, pay_cols), (receipts, rcp_cols)))

    def side(df, ts, seq, number, me):
        tie = F.col(seq).cast("long") if seq else F.xxhash64(*df.columns)
        at = F.col(ts).cast("timestamp")
        # a record that can match nothing is a group of its own, whatever its id
        alone = F.when(F.col(tx_col).isNull() | at.isNull(), F.xxhash64(*df.columns)).otherwise(0)
        return df.select(tie.alias("__tie"), F.xxhash64(*df.columns).alias("__same"), F.col(tx_col).alias("__tx"), at.alias("__ts"), alone.alias("__alone"),
                         F.lit(number).alias("__side"), me.alias("__p" if number == 0 else "__r"))

    rows = side(pays, pay_ts, pay_seq, 0, p_type).unionByName(
        side(receipts, receipt_ts, receipt_seq, 1, r_type), allowMissingColumns=True)
    keys, order = ["__tx", "__alone"], ["__ts", "__side", "__tie", "__same"]
    cuts = volume_cuts(rows, keys, epoch_micros("__ts"), hot_rows)
    part = keys
    if cuts is not None:
        rows, part = cuts.number(rows), [*keys, "__bucket"]
    w = Window.partitionBy(*part).orderBy(*order)
    record = F.struct("__ts", "__side", "__p", "__r")

    def linked(prev: Column) -> Column:
        return F.coalesce(F.col("__tx").isNotNull() & F.col("__ts").isNotNull() & (F.col("__side") != prev["__side"])
                          & (epoch_micros("__ts") - epoch_micros(prev["__ts"]) <= tol_us), F.lit(False))

    d = rows.withColumn("__prev", F.lag(record).over(w)).withColumn("__pos", F.row_number().over(w).cast("long"))
    if cuts is None:
        d = d.withColumns({"__run": F.lit(0).cast("long"), "__more": F.lit(False)})
    else:
        carry = F.broadcast(_carried(d.filter("__hot"), keys, part, record, linked))    # HOT_KEYS * CUTS rows at most
        same = F.col("__tx").eqNullSafe(carry["c_tx"]) & (F.col("__alone") == carry["c_alone"]) \
            & (F.col("__bucket") == carry["c_bucket"])
        d = (d.join(carry, same, "left")
             .withColumn("__prev", F.when(F.col("__pos") == 1, F.col("c_prev")).otherwise(F.col("__prev")))
             .withColumn("__run", F.coalesce("c_run", F.lit(0).cast("long")))
             .withColumn("__more", F.coalesce("c_more", F.lit(False))))
    d = d.withColumn("__link", linked(F.col("__prev")))
    start = F.max(F.when(~F.col("__link"), F.col("__pos"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumns({"__start": start, "__next": F.lead("__link").over(w)})
    # place in the run of links, from 0; without a break so far the run came from the cut before
    place = F.coalesce(F.col("__pos") - F.col("__start"), F.col("__run") + F.col("__pos") - 1)
    matched = F.pmod(place, F.lit(2)) == 1
    alone = ~matched & ~F.coalesce(F.col("__next"), F.col("__more"))
    either = lambda c: F.when(F.col("__matched"), F.coalesce(F.col(c), F.col("__prev")[c])).otherwise(F.col(c))
    out = d.withColumn("__matched", matched).filter(F.col("__matched") | alone).select(
        F.col("__tx").alias(tx_col), either("__p").alias("__p"), either("__r").alias("__r"),
        F.when(F.col("__matched"), F.lit(TAG_MATCHED)).when(F.col("__side") == 0, F.lit(TAG_UNMATCHED_PAY))
        .otherwise(F.lit(TAG_UNMATCHED_RECEIPT)).alias("tag"))
    return out.select(tx_col, *[F.col("__p")[c].alias(c) for c in pay_cols],
                      *[F.col("__r")[c].alias(c) for c in rcp_cols], "tag")


def _carried(d: DataFrame, keys: list, part: list, record: Column, linked) -> DataFrame:
    """What each cut of a hot id gets from the ones before: c_prev (the record
    before its first), c_run (length of the run of links that reaches it) and
    c_more (whether the record after its last one is linked to that)."""
    broken = F.when((F.col("__pos") > 1) & ~linked(F.col("__prev")), F.col("__pos"))
    per = d.groupBy(*part).agg(
        F.max("__pos").alias("n"), F.max(broken).alias("cut"),
        F.max_by(record, "__pos").alias("last"), F.min_by(record, "__pos").alias("first"))
    along = Window.partitionBy(*keys).orderBy("__bucket")
    per = per.withColumn("c_prev", F.lag("last").over(along))
    per = per.select("*", "first.__ts", "first.__side").withColumn("link", linked(F.col("c_prev")))
    # a run starts anew where a cut holds a break or is not linked to the one before
    anew = F.col("cut").isNotNull() | ~F.col("link")
    own = F.coalesce(F.col("n") - F.col("cut") + 1, F.col("n"))
    per = per.withColumn("group", F.sum(anew.cast("int")).over(along))
    so_far = Window.partitionBy(*keys, "group").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("end", F.sum(own).over(so_far))
    return per.select(F.col("__tx").alias("c_tx"), F.col("__alone").alias("c_alone"),
                      F.col("__bucket").alias("c_bucket"), "c_prev",
                      F.when(F.col("link"), F.lag("end").over(along)).otherwise(0).cast("long").alias("c_run"),
                      F.lead("link").over(along).alias("c_more"))
