"""Plan-shape guards: no cartesian products, pruned scans, window group limits."""

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL

SKIP = {"als_tune", "als_tune_grid", "stream_recs"}  # grid search refits; the stream runs a query of its own
# recommendForAllUsers crosses blocks of factors: scoring all users with all items is its definition
CROSSES_BLOCKS = {"als_user_recs"}


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_join(spark):
    qs = entry_mod.queries()
    for name in sorted(set(qs) - SKIP - CROSSES_BLOCKS):
        plan = _plan(qs[name](spark, SF_SMALL))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_statistics_scan_reads_only_needed_columns(spark):
    plan = _plan(entry_mod.queries()["rate_more_products"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan  # the user id is not needed


def test_top_k_uses_window_group_limit(spark):
    plan = _plan(entry_mod.queries()["item_cf_recs"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan
