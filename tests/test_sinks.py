from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.sinks import console_stream, split_by_tag, write_tagged, write_tagged_stream
from eventide.streaming.runner import prepare_streaming


def _tagged(spark):
    return spark.createDataFrame([(1, "matched"), (2, "unmatched_pay"), (3, "matched")],
                                 "id long, tag string")


def test_split_and_write_by_tag(spark, tmp_path):
    parts = split_by_tag(_tagged(spark), ["matched", "unmatched_pay", "unmatched_receipt"])
    assert {k: v.count() for k, v in parts.items()} == \
        {"matched": 2, "unmatched_pay": 1, "unmatched_receipt": 0}
    out = str(tmp_path / "tagged")
    write_tagged(_tagged(spark), out)
    assert sorted(r.id for r in spark.read.parquet(f"{out}/tag=matched").collect()) == [1, 3]


def test_streaming_tagged_and_console_sinks(spark, tmp_path):
    prepare_streaming(spark)
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"id": 1, "tag": "matched"}\n{"id": 2, "tag": "unmatched_pay"}\n')
    stream = spark.readStream.schema("id long, tag string").json(str(src))
    out = str(tmp_path / "out")
    q = write_tagged_stream(stream, out, scratch_path(spark, "tag-sink"),
                            trigger={"availableNow": True})
    q.awaitTermination(120)
    assert spark.read.parquet(out).filter(F.col("tag") == "matched").count() == 1
    c = console_stream(stream, prefix="payed", checkpoint=scratch_path(spark, "console"),
                       trigger={"availableNow": True})
    c.awaitTermination(120)
    assert c.exception() is None
