from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventide.sources import (format_access_log, format_lines, kafka_source_options,
                              kafka_values, parse_access_log, parse_lines, read_delimited)
from eventide.sources.kafka import kafka_sink_options
from tests.fixtures import AD_CLICK_SAMPLE, ORDER_KEY_LINES, epoch


def _write(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines))   # no newline after the last row, like the inputs
    return str(p)


def test_order_reader_keeps_empty_tx_as_empty_string(spark, tmp_path):
    path = _write(tmp_path, "orders.csv", ORDER_KEY_LINES)
    df = read_delimited(spark, path, "order")
    assert df.columns == ["order_id", "event_type", "tx_id", "ts"]
    rows = {(r.order_id, r.event_type): r for r in df.collect()}
    assert rows[(34730, "create")].tx_id == ""
    assert rows[(34730, "modify")].tx_id == "3hu3k2432"
    assert rows[(34747, "pay")].ts == epoch(1558430893)


def test_reader_trims_fields(spark, tmp_path):
    path = _write(tmp_path, "ad.csv", [" 543462 , 1715 , beijing , beijing , 1511658000 "])
    r = read_delimited(spark, path, "ad_click").first()
    assert (r.user_id, r.ad_id, r.province, r.city) == (543462, 1715, "beijing", "beijing")
    assert r.ts == epoch(1511658000)


def test_reader_fails_on_bad_line(spark, tmp_path):
    path = _write(tmp_path, "bad.csv", [AD_CLICK_SAMPLE, "x,1715,beijing,beijing,1511658000"])
    with pytest.raises(Exception):
        read_delimited(spark, path, "ad_click").collect()
    permissive = read_delimited(spark, path, "ad_click", mode="PERMISSIVE").collect()
    assert len(permissive) == 2 and permissive[1].user_id is None


def test_an_empty_number_is_an_error(spark, tmp_path):
    for i, line in enumerate(["1,2,,pv,1511658000", "1,2,3,pv,", " ,2,3,pv,1511658000"]):
        path = _write(tmp_path, f"empty{i}.csv", ["1,2,3,pv,1511658000", line])
        with pytest.raises(Exception, match="empty number"):
            read_delimited(spark, path, "user_behavior").collect()
        with pytest.raises(Exception, match="empty number"):
            parse_lines(spark.createDataFrame([(line,)], "value string"), "user_behavior").collect()
        assert len(read_delimited(spark, path, "user_behavior", mode="PERMISSIVE").collect()) == 2


def test_parse_and_format_lines_roundtrip(spark):
    lines = spark.createDataFrame([(AD_CLICK_SAMPLE,)], "value string")
    parsed = parse_lines(lines, "ad_click")
    back = format_lines(parsed.withColumn("s", F.unix_seconds("ts")),
                        ["user_id", "ad_id", "province", "city", "s"])
    assert back.first().value == AD_CLICK_SAMPLE


def test_marketing_layout_is_milliseconds(spark):
    lines = spark.createDataFrame([("u-1,Click,wechat,1511658000123",)], "value string")
    r = parse_lines(lines, "marketing").first()
    assert r.ts == datetime(2017, 11, 26, 1, 0, 0, 123000)


def test_access_log_parse(spark):
    line = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash-monitorama-2013/"
    r = parse_access_log(spark.createDataFrame([(line,)], "value string")).first()
    assert (r.ip, r.user_id, r.method) == ("83.149.9.216", "-", "GET")
    assert r.url == "/presentations/logstash-monitorama-2013/"
    assert r.ts == datetime(2015, 5, 17, 10, 5, 3)
    again = parse_access_log(format_access_log(parse_access_log(
        spark.createDataFrame([(line,)], "value string")))).first()
    assert again == r


def test_kafka_options_and_value_cast(spark):
    opts = kafka_source_options("b1:9092,b2:9092", "clicks", group_id="analytics",
                                **{"kafka.partition.assignment.strategy": "roundrobin", "maxOffsetsPerTrigger": 5})
    assert opts["kafka.bootstrap.servers"] == "b1:9092,b2:9092"
    assert opts["subscribe"] == "clicks" and opts["startingOffsets"] == "latest"
    assert opts["kafka.group.id"] == "analytics"
    assert opts["maxOffsetsPerTrigger"] == "5" and "failOnDataLoss" not in opts    # Spark's default: fail
    assert opts["kafka.partition.assignment.strategy"] == "roundrobin"
    assert kafka_sink_options("b:1", "t", "/ck")["checkpointLocation"] == "/ck"
    raw = spark.createDataFrame([(bytearray(b"1,2,3,pv,1511658000"),)], "value binary")
    parsed = parse_lines(kafka_values(raw), "user_behavior").first()
    assert (parsed.user_id, parsed.item_id, parsed.category_id, parsed.behavior) == (1, 2, 3, "pv")
