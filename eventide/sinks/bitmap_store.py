"""Persisted per-window visitor bitmaps (SNK-4, UV-3).

The reference keeps one bitmap per window end in an external key-value
store and a running count next to it, updated per element.  Here the store
is a Parquet table ``(window_end, bucket, bitmap)`` in folders
``day=<day of the window end>/v=<version>``: ``merge`` ORs a new run's bitmaps
into the days that it touches, writes them as the next version and then drops
versions before the last one.  A job never overwrites what it reads, and a
failed merge leaves the days as they were.  Counts are derived, not stored.
A stream gives its micro-batch's number along, which ``_ledger/<stream>/<epoch>``
keeps, so that a replayed batch is merged once.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.distinct import bitmap_counts, merge_bitmaps

_DAY = re.compile(r"^day=(.+)$")
_VERSION = re.compile(r"^v=(\d+)$")
_NO_TIME = "none"


def _by_day(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.withColumn("day", F.coalesce(F.date_format("window_end", "yyyy-MM-dd"), F.lit(_NO_TIME)))


class BitmapStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hpath = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hpath(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str, pattern: re.Pattern) -> list[str]:
        at = self._hpath(folder)
        if not self._fs.exists(at):
            return []
        found = (pattern.match(s.getPath().getName()) for s in self._fs.listStatus(at))
        return [m[1] for m in found if m]

    def _versions(self) -> dict[str, list[int]]:
        """Versions of each day, from the folder names alone."""
        return {d: sorted(int(v) for v in self._names(f"{self.path}/day={d}", _VERSION))
                for d in self._names(self.path, _DAY)}

    def _read(self, versions: dict[str, list[int]]) -> DataFrame | None:
        paths = [f"{self.path}/day={d}/v={v[-1]}" for d, v in sorted(versions.items()) if v]
        return self.spark.read.parquet(*paths) if paths else None

    def latest(self) -> DataFrame | None:
        return self._read(self._versions())

    def merged(self, stream: str, epoch: int) -> bool:
        return self._fs.exists(self._hpath(f"{self.path}/_ledger/{stream}/{epoch}"))

    def merge(self, bitmaps: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """OR ``bitmaps`` (from ``window_bitmaps``) into the store; returns
        the new version number.  ``batch``: (stream, epoch); one that the ledger
        has changes nothing.  Bitmaps of days that the store does not have yet
        are written once, those of others again with what the day holds."""
        have = self._versions()
        last = max((v[-1] for v in have.values() if v), default=-1)
        if batch is not None and self.merged(*batch):
            return last
        version = last + 1
        stage = f"{self.path}/_stage-{version}"
        # on the same keys as ``window_bitmaps``: no further shuffle
        _by_day(merge_bitmaps(bitmaps)).write.mode("overwrite").partitionBy("day").parquet(f"{stage}/new")
        touched = self._names(f"{stage}/new", _DAY)
        again = [d for d in touched if have.get(d)]
        if again:
            old = self._read({d: have[d] for d in again})
            new = self.spark.read.parquet(*[f"{stage}/new/day={d}" for d in again])
            _by_day(merge_bitmaps(old, new)).write.mode("overwrite").partitionBy("day").parquet(f"{stage}/merged")
        for d in touched:
            part = "merged" if d in again else "new"
            self._fs.mkdirs(self._hpath(f"{self.path}/day={d}"))
            self._fs.rename(self._hpath(f"{stage}/{part}/day={d}"), self._hpath(f"{self.path}/day={d}/v={version}"))
            for old_version in have.get(d, [])[:-1]:
                self._fs.delete(self._hpath(f"{self.path}/day={d}/v={old_version}"), True)
        if batch is not None:
            self._fs.create(self._hpath(f"{self.path}/_ledger/{batch[0]}/{batch[1]}"), True).close()
        self._fs.delete(self._hpath(stage), True)
        return version

    def counts(self, out_col: str = "uv_count") -> DataFrame:
        current = self.latest()
        if current is None:
            return self.spark.createDataFrame([], f"window_end timestamp, {out_col} long")
        return bitmap_counts(current, out_col)
