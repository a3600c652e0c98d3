from eventide.operators import windowed_count
from eventide.session import SCALE_CONF, apply_scale_conf, checkpoint_root


def test_scale_conf_keeps_explicit_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")       # set explicitly by the session
    apply_scale_conf(spark, {"spark.sql.adaptive.autoBroadcastJoinThreshold": "32m"})
    try:
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == \
            SCALE_CONF["spark.sql.files.maxPartitionBytes"]
        assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "32m"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        for key in SCALE_CONF:
            if key != "spark.sql.shuffle.partitions":
                spark.conf.unset(key)


def test_checkpoint_root_is_stable(spark):
    assert checkpoint_root(spark) == checkpoint_root(spark)


def test_streaming_windows_do_not_use_panes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2024-01-01 00:00:01\n")
    stream = spark.readStream.schema("k long, ts timestamp").csv(str(tmp_path))
    counted = windowed_count(stream.withWatermark("ts", "0 seconds"), "ts", "1 hour", "5 minutes")
    assert counted.isStreaming
    plan = counted._jdf.queryExecution().analyzed().toString()
    assert "__pane" not in plan
