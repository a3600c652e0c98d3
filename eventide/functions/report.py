"""Ranked report text (FMT-1, SC-12).

A report is built from an already-bounded array of ranked entries (top-n per
window), so one row never holds more than n entries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.functions.time import epoch_millis_text, format_java_ts

# Fixed values that must equal the reference's report text.
#   item reports: header "时间：", entry " 商品ID=" / " 浏览量=", footer 34 "="
#   url reports:  header "time: ", entry " URL = " / " views = ", footer 30 "*"
ITEM_LABELS = {"header": "时间：", "key": " 商品ID=", "count": " 浏览量=", "footer": "=" * 34}
URL_LABELS = {"header": "time: ", "key": " URL = ", "count": " views = ", "footer": "*" * 30}
REPORT_STYLES = {"items": ITEM_LABELS, "urls": URL_LABELS}
# Fixed value: the Bloom UV line is "window end: <ms>, uv_count: <n>".
UV_LINE_PREFIX, UV_LINE_MIDDLE = "window end: ", ", uv_count: "


def uv_line(window_end: Column, count: Column) -> Column:
    """The per-window text line of the reference's Bloom UV job (SC-7)."""
    return F.concat(F.lit(UV_LINE_PREFIX), epoch_millis_text(window_end), F.lit(UV_LINE_MIDDLE),
                    count.cast("string"))


def report_text(header_ts: Column, entries: Column, key_field: str, count_field: str,
                style: str = "items") -> Column:
    """``entries`` is an array<struct> already in rank order."""
    lab = REPORT_STYLES[style]
    lines = F.transform(
        entries,
        lambda e, i: F.concat(F.lit("No"), (i + 1).cast("string"), F.lit(":"),
                              F.lit(lab["key"]), e[key_field].cast("string"),
                              F.lit(lab["count"]), e[count_field].cast("string"),
                              F.lit("\n")))
    return F.concat(F.lit(lab["header"]), format_java_ts(header_ts), F.lit("\n"),
                    F.array_join(lines, ""), F.lit(lab["footer"]))
