import pytest

from tests.conftest import SF001, have_testdata

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver test data missing")


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["window_end", "item_id", "item_count", "row_num"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [
    "hot_items_sql", "url_rank_all", "page_views", "uv_bitmap", "uv_bloom", "marketing_total",
    "ad_gate_pass", "ad_by_geo", "login_fail_arrival", "login_fail_burst", "order_outcomes",
    "order_deadline", "tx_reconcile", "running_count", "access_log_parse", "csv_roundtrip",
    "report_text",
])
def test_query_matches_duckdb_oracle(spark, name):
    """Same comparison as the driver's correctness gate, on sf0.001."""
    import duckdb
    import __spark_entry__ as entry
    from tools.check_oracle import TABLES, normalize
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = entry.queries()[name](spark, SF001).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert normalize(got).equals(normalize(want))
