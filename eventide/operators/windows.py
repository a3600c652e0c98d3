"""Windowed and running counts (AGG-1..AGG-8, PRJ-3, PRJ-4, FLT-1, FLT-2).

All of them are one ``groupBy(window, keys)`` aggregate: Spark does a
partial count per task before the shuffle, so a constant or hot key costs one
partial row per task instead of a single hot task (the reference's
``("dummyKey", 1)`` pattern disappears).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.time import (duration_seconds, epoch_millis_text, event_window,
                                    format_java_ts)

# Fixed values of the reference's total-marketing report.
MARKETING_TOTAL_CHANNEL = "app marketing"
MARKETING_TOTAL_BEHAVIOR = "total"


# Sliding windows with at least this many windows per row are counted per
# pane first (batch only).
PANE_MIN_OVERLAP = 4


def _pane_counts(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str],
                 count_col: str) -> DataFrame:
    """Pane-based sliding count: count per slide-wide pane (one hash insert
    per row), then add each pane's count to the size/slide windows that
    contain it.  ``F.window`` would instead copy every raw row size/slide
    times before aggregating.  Windows are the same epoch-aligned windows."""
    n = int(round(duration_seconds(size) / duration_seconds(slide)))
    slide_iv = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(duration_seconds(slide)))
    size_iv = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(duration_seconds(size)))
    panes = (df.groupBy(event_window(ts, slide).start.alias("__pane"), *keys)
             .agg(F.count(F.lit(1)).alias("__n")))
    k = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("__k")
    spread = panes.select("*", k).withColumn(
        "__start", F.col("__pane") - slide_iv * F.col("__k"))
    agg = spread.groupBy("__start", *keys).agg(F.sum("__n").cast("long").alias(count_col))
    return agg.select(F.struct(F.col("__start").alias("start"),
                               (F.col("__start") + size_iv).alias("end")).alias("window"),
                      *keys, count_col)


def windowed_count(df: DataFrame, ts: str, size: str, slide: str | None = None,
                   keys: Sequence[str] = (), count_col: str = "count",
                   with_start: bool = False, end_col: str = "window_end") -> DataFrame:
    """Rows per (window, keys); sliding when ``slide`` is given (AGG-1..7).
    Batch sliding windows that overlap a lot are counted pane by pane."""
    overlap = (duration_seconds(size) / duration_seconds(slide)) if slide else 1
    if (not df.isStreaming and overlap >= PANE_MIN_OVERLAP
            and abs(overlap - round(overlap)) < 1e-9):
        agg = _pane_counts(df, ts, size, slide, keys, count_col)
    else:
        agg = df.groupBy(event_window(ts, size, slide).alias("window"), *keys) \
                .agg(F.count(F.lit(1)).alias(count_col))
    cols: list[Column] = []
    if with_start:
        cols.append(F.col("window.start").alias("window_start"))
    cols += [F.col("window.end").alias(end_col), *[F.col(k) for k in keys], F.col(count_col)]
    return agg.select(*cols)


def page_views(df: DataFrame, ts: str = "ts", size: str = "1 hour", behavior_col: str = "behavior",
               behavior: str | None = "pv", count_col: str = "pv") -> DataFrame:
    """AGG-6: page views per tumbling window (the reference's ``("pv", n)``)."""
    if behavior is not None:
        df = df.filter(F.col(behavior_col) == behavior)
    return windowed_count(df, ts, size, count_col=count_col, with_start=True)


def marketing_total(df: DataFrame, ts: str, size: str, slide: str, behavior_col: str = "behavior",
                    exclude: str | None = "Uninstall") -> DataFrame:
    """AGG-4: all behaviours but ``exclude``, counted per sliding window, with
    the constant channel/behaviour labels and formatted bounds."""
    if exclude is not None:
        df = df.filter(F.col(behavior_col) != exclude)
    counted = windowed_count(df, ts, size, slide, with_start=True)
    return counted.select(
        "window_start", "window_end",
        format_java_ts("window_start").alias("window_start_text"),
        format_java_ts("window_end").alias("window_end_text"),
        F.lit(MARKETING_TOTAL_CHANNEL).alias("channel"),
        F.lit(MARKETING_TOTAL_BEHAVIOR).alias("behavior"),
        "count")


def marketing_by_channel(df: DataFrame, ts: str, size: str, slide: str,
                         channel_col: str = "channel", behavior_col: str = "behavior",
                         exclude: str | None = "Uninstall") -> DataFrame:
    """AGG-5: count per (channel, behaviour) per sliding window.  The
    reference buffers whole windows to take ``elements.size``; a count is the
    same number without the buffer."""
    if exclude is not None:
        df = df.filter(F.col(behavior_col) != exclude)
    counted = windowed_count(df, ts, size, slide, keys=[channel_col, behavior_col],
                             with_start=True)
    return counted.select("window_start", "window_end",
                          format_java_ts("window_start").alias("window_start_text"),
                          format_java_ts("window_end").alias("window_end_text"),
                          channel_col, behavior_col, "count")


def count_by_key_per_window(df: DataFrame, ts: str, size: str, slide: str, key: str,
                            count_col: str = "count") -> DataFrame:
    """AGG-3: count per key per sliding window, window end also as ms text."""
    counted = windowed_count(df, ts, size, slide, keys=[key], count_col=count_col)
    return counted.select("window_end", epoch_millis_text("window_end").alias("window_end_ms"),
                          key, count_col)


def running_count(df: DataFrame, keys: Sequence[str] | str, count_col: str = "count") -> DataFrame:
    """AGG-8: unbounded ``count(1) GROUP BY key``; on a stream use output mode
    update/complete (or :mod:`eventide.streaming.changelog` for -/+ rows)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


def words(df: DataFrame, text_col: str = "text", word_col: str = "word") -> DataFrame:
    """Split whole texts into words on runs of ASCII whitespace."""
    return (df.select(F.explode(F.split(F.col(text_col), r"[ \t\n\r\f]+")).alias(word_col))
            .filter(F.col(word_col) != ""))
