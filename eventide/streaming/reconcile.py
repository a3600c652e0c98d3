"""One-open-record reconciliation of two streams (JOIN-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.time import duration_micros
from eventide.operators.reconciliation import (TAG_MATCHED, TAG_UNMATCHED_PAY, TAG_UNMATCHED_RECEIPT)
from eventide.streaming.processors import OneOpenRecord

_TAGS = (TAG_MATCHED, TAG_UNMATCHED_PAY, TAG_UNMATCHED_RECEIPT)


def reconcile_once_stream(pays: DataFrame, receipts: DataFrame, tolerance: str = "5 seconds",
                          tx_col: str = "tx_id", pay_ts: str = "pay_ts", receipt_ts: str = "receipt_ts",
                          pay_seq: str | None = None, receipt_seq: str | None = None) -> DataFrame:
    """The stream form of ``reconcile_once``: same arguments, columns, tags and
    rows.  Both streams need a watermark on their time.  State is one open
    record per id and the rows that the watermark has not passed yet; records
    without id or time are unmatched at once and touch no state."""
    pay_cols = [c for c in pays.columns if c != tx_col]
    rcp_cols = [c for c in receipts.columns if c != tx_col]
    pay_type, rcp_type = (T.StructType([T.StructField(c, df.schema[c].dataType) for c in cols])
                          for df, cols in ((pays, pay_cols), (receipts, rcp_cols)))

    def side(df, ts, seq, number, cols):
        me = F.struct(*[F.col(c).alias(c) for c in cols])
        p, r = (me, F.lit(None).cast(rcp_type)) if number == 0 else (F.lit(None).cast(pay_type), me)
        # the time column keeps its name until here, and with it its watermark
        return df.select(F.col(ts).alias("ts"), F.col(tx_col).alias("tx"), F.lit(number).alias("side"),
                         (F.col(seq).cast("long") if seq else F.xxhash64(*df.columns)).alias("seq"),
                         F.xxhash64(*df.columns).alias("same"), p.alias("p"), r.alias("r"))

    rows = side(pays, pay_ts, pay_seq, 0, pay_cols).unionByName(side(receipts, receipt_ts, receipt_seq, 1, rcp_cols))
    usable = F.col("tx").isNotNull() & F.col("ts").isNotNull()
    out = T.StructType([T.StructField("tx", pays.schema[tx_col].dataType), T.StructField("p", pay_type),
                        T.StructField("r", rcp_type), T.StructField("tag", T.StringType())])
    decided = rows.filter(usable).groupBy("tx").transformWithState(
        OneOpenRecord(duration_micros(tolerance), pay_type, rcp_type, _TAGS), out, "Append", "EventTime")
    alone = rows.filter(~usable).select(
        "tx", "p", "r", F.when(F.col("side") == 0, F.lit(TAG_UNMATCHED_PAY)).otherwise(F.lit(TAG_UNMATCHED_RECEIPT)).alias("tag"))
    return decided.unionByName(alone).select(
        F.col("tx").alias(tx_col), *[F.col("p")[c].alias(c) for c in pay_cols],
        *[F.col("r")[c].alias(c) for c in rcp_cols], "tag")
