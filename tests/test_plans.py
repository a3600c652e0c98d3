"""Physical-plan properties the design relies on."""

import pytest

from tests.conftest import SF001, have_testdata

pytestmark = pytest.mark.skipif(not have_testdata(), reason="driver test data missing")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_items_prunes_columns_and_pushes_the_filter(spark):
    from eventide.plans.catalog import q_hot_items_topn
    plan = _plan(q_hot_items_topn(spark, SF001))
    assert "EqualTo(event_type,view)" in plan.split("PushedFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    assert "props" not in plan and "value" not in plan
    assert "WindowGroupLimit" in plan            # limit before the window-end shuffle
    assert "PythonUDF" not in plan and "ArrowEval" not in plan


@pytest.mark.parametrize("name", ["page_views", "uv_exact", "uv_bitmap", "uv_bloom",
                                  "marketing_total", "ad_gate_pass", "login_fail_strict",
                                  "order_timeout_cep", "order_outcomes", "tx_reconcile",
                                  "running_count"])
def test_builtin_only_queries_have_no_python(spark, name):
    import __spark_entry__ as entry
    plan = _plan(entry.queries()[name](spark, SF001))
    for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                   "MapInPandas"):
        assert marker not in plan


def test_gate_only_numbers_the_first_events(spark):
    from eventide.plans.catalog import q_ad_gate_pass
    plan = _plan(q_ad_gate_pass(spark, SF001))
    assert plan.count("WindowGroupLimit") == 2    # before the exchange and after it


@pytest.mark.parametrize("name", ["login_fail_strict", "login_fail_arrival", "ad_gate_pass", "ad_gate_warn",
                                  "ad_gate_daily", "order_timeout_cep"])
def test_keyed_scans_without_a_hot_key_are_one_exchange(spark, name):
    import __spark_entry__ as entry
    plan = _plan(entry.queries()[name](spark, SF001))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["login_fail_strict", "login_fail_arrival", "order_timeout_cep", "login_fail_burst"])
def test_keyed_scans_of_hot_keys_shuffle_full_rows_once(spark, name, monkeypatch):
    """Only the table of cuts is joined, by broadcast; the rows go through one
    exchange on (key, bucket), united with what is carried."""
    import re

    import __spark_entry__ as entry
    from eventide.plans import ordered
    monkeypatch.setattr(ordered, "HOT_ROWS", 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(entry.queries()[name](spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    # of the exchanges on (key, bucket) only the summary's (partial aggregates) and the union's are left
    lines = plan.split("\n")
    full = [i for i, x in enumerate(lines) if re.search(r"Exchange hashpartitioning\(.*__bucket", x)
            and not re.search(r"functions=\[partial|HashAggregate|SortAggregate", "".join(lines[i + 1:i + 3]))]
    assert len(full) == 1
