from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventide.functions import (bloom_size, duration_seconds, format_java_ts, next_day_start,
                                poly_hash)
from eventide.functions.report import report_text


def test_duration_parsing():
    assert duration_seconds("5 seconds") == 5
    assert duration_seconds("1 hour") == 3600
    assert duration_seconds("15 minutes") == 900
    assert duration_seconds("1 day 2 hours") == 93600
    with pytest.raises(ValueError):
        duration_seconds("soon")


def test_poly_hash_matches_hand_computation(spark):
    # h = h*61 + char, masked to 2^29 bits: "2315" -> 11541863
    h = 0
    for ch in "2315":
        h = (h * 61 + ord(ch)) & ((1 << 29) - 1)
    assert h == 11541863
    got = spark.range(1).select(poly_hash(F.lit(2315)).alias("h")).first()["h"]
    assert got == 11541863


def test_poly_hash_long_text_never_overflows(spark):
    text = "9" * 200   # ANSI mode would throw on overflow
    got = spark.range(1).select(poly_hash(F.lit(text)).alias("h")).first()["h"]
    h = 0
    for ch in text:
        h = (h * 61 + ord(ch)) & ((1 << 29) - 1)
    assert got == h


def test_bloom_sizing_for_reference_parameters():
    assert bloom_size(10_000, 0.01) == (95850, 7)


def test_java_timestamp_text(spark):
    df = spark.createDataFrame([(datetime(2017, 11, 26, 9, 0, 0),),
                                (datetime(2017, 11, 26, 9, 59, 59, 999000),),
                                (datetime(2017, 11, 26, 9, 0, 0, 120000),)], "t timestamp")
    got = [r[0] for r in df.select(format_java_ts("t")).collect()]
    assert got == ["2017-11-26 09:00:00.0", "2017-11-26 09:59:59.999", "2017-11-26 09:00:00.12"]


def test_next_day_start(spark):
    df = spark.createDataFrame([(datetime(2017, 11, 26, 23, 59, 59),)], "t timestamp")
    assert df.select(next_day_start("t")).first()[0] == datetime(2017, 11, 27)


def test_report_text_layout(spark):
    df = spark.createDataFrame(
        [(datetime(2017, 11, 26, 10, 0), [(1, 42, 7), (2, 9, 3)])],
        "w timestamp, e array<struct<r:int,k:long,c:long>>")
    items = df.select(report_text(F.col("w") - F.expr("INTERVAL 1 MILLISECOND"), F.col("e"),
                                  "k", "c", "items")).first()[0]
    assert items == ("时间：2017-11-26 09:59:59.999\n"
                     "No1: 商品ID=42 浏览量=7\n"
                     "No2: 商品ID=9 浏览量=3\n" + "=" * 34)
    urls = df.select(report_text(F.col("w"), F.col("e"), "k", "c", "urls")).first()[0]
    assert urls.startswith("time: 2017-11-26 10:00:00.0\nNo1: URL = 42 views = 7\n")
    assert urls.endswith("*" * 30)


def test_uv_line(spark):
    from eventide.functions.report import uv_line
    df = spark.createDataFrame([(datetime(2017, 11, 26, 1, 2), 42)], "w timestamp, n long")
    assert df.select(uv_line(F.col("w"), F.col("n"))).first()[0] == \
        "window end: 1511658120000, uv_count: 42"
