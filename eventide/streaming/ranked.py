"""Top-N of a window on a stream: changelog and re-ranked versions
(TOP-2, TOP-3, CHG-1, STR-3).

The counts come from Spark's own streaming aggregate in ``update`` mode: every
micro-batch brings the new count of each (window, key) that it touched.  The
ranking needs no more state than the rank border, i.e. the current top N of
each open window: a count only grows, so whoever enters the top N is either in
it already or among the touched rows.  Each epoch therefore ranks

    (touched rows) + (old top N of the touched windows, where not touched)

with a bounded ``row_number`` (each task forwards N rows of a window at most),
however large the windows are, and windows that nothing touched are not ranked.

State and output of an epoch are folders of their own: epoch k reads the state
of epoch k - 1 and overwrites its own folders, so a micro-batch that is
replayed after a failure gives the same rows once.  The state holds the windows
that can still change; older snapshots are removed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import duration_micros
from eventide.operators.topn import top_n_per_window
from eventide.session import scratch_path
from eventide.streaming.runner import before_flush, run_epochs

#: Snapshots that stay: the last one and, for a replay of its epoch, the one before.
SNAPSHOTS = 2


def _on(a_cols: Sequence[str]):
    """Join condition on the renamed right side; NULL equals NULL."""
    return reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in a_cols])


def _without(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    return a.join(b.select(*[F.col(c).alias(f"__{c}") for c in cols]), _on(cols), "left_anti")


def _in(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    return a.join(b.select(*[F.col(c).alias(f"__{c}") for c in cols]), _on(cols), "left_semi")


@dataclass
class RankBorder:
    """The top ``n`` of every open window, one snapshot per epoch."""

    spark: SparkSession
    n: int
    keys: Sequence[str]
    count: str
    window: str = "window_end"
    rank: str = "row_num"
    folder: str = field(default="")

    def __post_init__(self) -> None:
        self.folder = self.folder or scratch_path(self.spark, "rank-border")

    def _path(self, epoch: int) -> str:
        return f"{self.folder}/epoch={epoch:09d}"

    def read(self, like: DataFrame, epoch: int) -> DataFrame:
        """The snapshot after an epoch (empty before epoch 0), with the schema of ``like``."""
        if epoch < 0:
            return like.sparkSession.createDataFrame([], like.schema)
        return like.sparkSession.read.schema(like.schema).parquet(self._path(epoch))

    def keep(self, epoch: int, state: DataFrame) -> None:
        state.write.mode("overwrite").parquet(self._path(epoch))
        if epoch >= SNAPSHOTS:
            old = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(epoch - SNAPSHOTS))
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)

    def like(self, batch: DataFrame) -> DataFrame:
        """A frame with the columns of a snapshot."""
        return batch.select(self.window, *self.keys, self.count, F.lit(0).cast("long").alias(self.rank))

    def ranked(self, touched: DataFrame, old: DataFrame) -> DataFrame:
        """The new top n of the touched windows."""
        cols = [self.window, *self.keys, self.count]
        stay = _without(_in(old, touched.select(self.window).distinct(), [self.window]), touched,
                        [self.window, *self.keys])
        return top_n_per_window(touched.select(*cols).unionByName(stay.select(*cols)), self.n, self.window,
                                self.keys, self.count, self.rank)

    def untouched(self, touched: DataFrame, old: DataFrame) -> DataFrame:
        return _without(old, touched.select(self.window).distinct(), [self.window])


def _open_after(windows: DataFrame, window: str, size_us: int, delay_us: int):
    """A window whose end lies ``delay`` before the start of the latest one of
    ``windows`` gets no more rows: the watermark has passed it."""
    latest = windows.filter(F.col(window).isNotNull()).agg(F.unix_micros(F.max(window))).first()[0]
    if latest is None:
        return F.lit(True)
    return F.unix_micros(F.col(window)) > F.lit(latest - size_us - delay_us)


def write_top_n_changelog(counts: DataFrame, name: str, n: int, keys: Sequence[str], count: str, size: str,
                          delay: str = "0 seconds", window: str = "window_end", rank: str = "row_num") -> str:
    """Run a stream of per-window counts (``counts``: an aggregate, run in
    ``update`` mode) and write the changes of each window's top ``n`` as rows
    (window, keys, count, rank, op): per epoch ``-`` for entries that left or
    moved and ``+`` for what stands there now.  Returns the log's folder."""
    border = RankBorder(counts.sparkSession, n, list(keys), count, window, rank)
    cols = [window, *keys, count, rank]

    def epoch_rows(batch: DataFrame, epoch: int) -> DataFrame:
        touched = before_flush(batch, window)
        like = border.like(batch)
        old = border.read(like, epoch - 1)
        now = border.ranked(touched, old).withColumn("__now", F.lit(True))
        rest = border.untouched(touched, old).withColumn("__now", F.lit(False))
        # Spark drops late rows by the watermark of one micro-batch before, hence the old windows
        is_open = _open_after(old, window, duration_micros(size), duration_micros(delay))
        # the touched windows are read back below
        border.keep(epoch, now.unionByName(rest).filter(F.col("__now") | is_open).select(*cols))
        windows = touched.select(window).distinct()
        old, new = (_in(border.read(like, e), windows, [window]).select(*cols) for e in (epoch - 1, epoch))
        return (_without(old, new, cols).withColumn("op", F.lit("-"))
                .unionByName(_without(new, old, cols).withColumn("op", F.lit("+"))))

    return run_epochs(counts, f"{name}-changelog", epoch_rows, output_mode="update")


def fold_changelog(log: DataFrame, columns: Sequence[str], op: str = "op") -> DataFrame:
    """The rows that a changelog leaves: every ``-`` takes one ``+`` back."""
    sign = F.when(F.col(op) == "+", 1).otherwise(-1)
    return (log.groupBy(*columns).agg(F.sum(sign).alias("__n")).filter("__n > 0")
            .withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(*columns))


def write_refined_rankings(counts: DataFrame, name: str, n: int, keys: Sequence[str], count: str, disorder: str,
                           lateness: str, seen: str = "last_ts", window: str = "window_end", rank: str = "rank"
                           ) -> str:
    """Rank windows when they are due and again whenever a late row changes
    them.  ``counts`` is an aggregate with ``seen`` = max(event time); a window
    is due once the latest event time is ``disorder`` past its end and can
    change until ``lateness`` more has passed (the stream's watermark has to be
    that late).  Writes complete versions (window, keys, count, rank, first) of
    the windows that became due or changed in an epoch; returns the folder."""
    border = RankBorder(counts.sparkSession, n, list(keys), count, window, rank)
    cols = [window, *keys, count, rank]
    wait, grace = duration_micros(disorder), duration_micros(lateness)

    def epoch_rows(batch: DataFrame, epoch: int) -> DataFrame:
        touched = before_flush(batch, window)
        like = border.like(batch).withColumn("emitted", F.lit(False)).withColumn("latest", F.lit(0).cast("long"))
        old = border.read(like, epoch - 1)
        ranked = border.ranked(touched, old)
        now = batch.agg(F.unix_micros(F.max(seen))).first()[0]
        last = old.agg(F.max("latest")).first()[0]
        latest = max((x for x in (now, last) if x is not None), default=-2 ** 62)
        was = old.filter("emitted").select(window).distinct().withColumnRenamed(window, "__w") \
            .withColumn("__was", F.lit(True))
        changed = ranked.withColumn("touched", F.lit(True))
        rest = border.untouched(touched, old).select(*cols).withColumn("touched", F.lit(False))
        every = changed.unionByName(rest)
        every = every.join(was, every[window].eqNullSafe(was["__w"]), "left")
        due = F.unix_micros(F.col(window)) <= F.lit(latest - wait)
        every = every.select(*cols, "touched", F.coalesce("__was", F.lit(False)).alias("__was"), due.alias("__due"))
        # Spark drops late rows by the watermark of one micro-batch before, hence the old time
        closed = F.lit(False) if last is None else F.unix_micros(F.col(window)) <= F.lit(last - wait - grace)
        border.keep(epoch, every.filter(~closed | F.col("touched") | ~F.col("__was"))
                    .select(*cols, (F.col("__was") | F.col("__due")).alias("emitted"),
                            F.lit(latest).cast("long").alias("latest")))
        return (every.filter(F.col("__due") & (F.col("touched") | ~F.col("__was")))
                .select(*cols, (~F.col("__was")).alias("first")))

    return run_epochs(counts, f"{name}-refined", epoch_rows, output_mode="update")


def last_versions(log: DataFrame, window: str = "window_end", epoch: str = "epoch") -> DataFrame:
    """Of every window the rows of its last version."""
    last = log.groupBy(window).agg(F.max(epoch).alias("__e")).withColumnRenamed(window, "__w")
    return (log.join(last, log[window].eqNullSafe(last["__w"]) & (log[epoch] == last["__e"]))
            .drop("__w", "__e", epoch))
