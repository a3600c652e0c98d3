"""A persisted visitor-bitmap store fed by a stream (UV-3, SNK-4).

Each micro-batch ORs its bitmaps into the store, so the stream itself has no
state and no window ever closes: late rows count, however late.  A batch that is
replayed after a failure is known by the store's ledger; one that failed between
its merge and its ledger entry is merged again, which an OR does not notice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventide.operators.distinct import window_bitmaps
from eventide.sinks.bitmap_store import BitmapStore


def feed_bitmap_store(stream: DataFrame, store: BitmapStore, name: str, checkpoint: str, user_col: str = "user_id",
                      ts: str = "ts", size: str = "1 hour", slide: str | None = None, bits: int = 29):
    """Start a query (``availableNow``) that merges ``stream`` into ``store``.
    ``name`` stands for the stream in the ledger: one name, one checkpoint."""

    def merge(batch: DataFrame, epoch: int) -> None:
        store.merge(window_bitmaps(batch, user_col, ts, size, slide, bits), batch=(name, epoch))

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
