"""Streaming forms equal their batch forms (SURVEY §5 (c))."""

import pytest
from pyspark.sql import functions as F

from eventide.streaming.changelog import final_counts, running_count_changelog
from eventide.streaming.runner import prepare_streaming, run_and_read
from tests.conftest import SF001, have_testdata

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver test data missing")


def _same(a, b):
    from tools.check_oracle import normalize
    assert sorted(a.columns) == sorted(b.columns)
    assert normalize(a.toPandas()).equals(normalize(b.toPandas()))


@pytest.mark.parametrize("name,batch", [
    ("hot_items_topn_stream", "hot_items_topn"),
    ("uv_exact_stream", "uv_exact"),
    ("login_fail_strict_stream", "login_fail_strict"),
    ("ad_gate_stream", "ad_gate_daily"),
    ("order_timeout_stream", "order_timeout_cep"),
    ("tx_reconcile_stream", "tx_reconcile"),
    ("uv_bitmap_stream", "uv_bitmap"),
    ("uv_bloom_stream", "uv_bloom"),
    ("login_fail_burst_stream", "login_fail_burst"),
    ("ad_by_geo_stream", "ad_by_geo"),
])
def test_stream_equals_batch(spark, name, batch):
    import __spark_entry__ as entry
    qs = entry.queries()
    _same(qs[name](spark, SF001), qs[batch](spark, SF001))


def test_changelog_folds_back_to_counts(spark, tmp_path):
    prepare_streaming(spark)
    folder = tmp_path / "words"
    folder.mkdir()
    (folder / "a.txt").write_text("x\ny\nx\n")
    stream = spark.readStream.text(str(folder))
    log = run_and_read(running_count_changelog(stream, "value"), "changelog")
    rows = sorted((r.key, r.op, r["count"]) for r in log.collect())
    assert rows == [("x", "+", 2), ("y", "+", 1)]
    assert sorted(final_counts(log).collect()) == [("x", 2), ("y", 1)]
