"""Physical plans: no all-pairs joins, narrow scans, filters in the scan, few shuffles."""

import pytest

import __spark_entry__ as entry
from tillwatch.catalog import batch
from tillwatch.operators import cleaning, entity_features, quality
from tillwatch.operators import history
from tillwatch.operators.skew import HotKeys
from tillwatch.operators.asof import AsofTable, asof_carry_all, point_in_time_join
from tillwatch.catalog.inputs import driver_spine, driver_stats

LAZY = ["quality_profile", "load_report", "class_balance", "dedupe_first", "clean", "customer_terminal_features_orders",
        "point_in_time_join", "point_in_time_join_hot_keys", "multi_view_join",
        "historical_features_v4", "latest_per_entity", "promote", "best_runs", "tune_threshold", "metrics_pivot"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_all_pairs(spark, folder, name):
    plan = _plan(entry.queries()[name](spark, folder))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.fixture(scope="module")
def table(spark, folder):
    return batch.clean_table(spark, folder)


def test_scans_are_narrow(table):
    assert "ReadSchema: struct<tx_fraud:int>" in _plan(quality.class_balance(table))
    plan = _plan(entity_features.amount_by_entity(table, "terminal_id"))
    assert "ReadSchema: struct<terminal_id:bigint,tx_amount:double>" in plan


def test_filters_reach_the_scan(table):
    plan = _plan(cleaning.clean(table))
    for part in ("GreaterThanOrEqual(customer_id,0)", "GreaterThanOrEqual(terminal_id,0)", "In(tx_fraud, [0,1])"):
        assert part in plan


def test_without_hot_keys_one_shuffle_per_entity(table):
    plan = _plan(entity_features.customer_terminal_features(table))
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_several_tables_share_one_shuffle(spark, folder):
    """Two sources with the same keys are carried by one window."""
    stats = driver_stats(spark, folder)
    one = AsofTable(stats, "event_timestamp", "created", ["conv_rate"])
    other = AsofTable(stats.selectExpr("driver_id", "event_timestamp + INTERVAL 1 HOUR AS seen", "acc_rate"), "seen", None, ["acc_rate"])
    plan = _plan(asof_carry_all(driver_spine(spark, folder), [one, other], ["driver_id"], "event_timestamp"))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_one_shuffle_per_point_in_time_join(spark, folder):
    out = point_in_time_join(driver_spine(spark, folder), driver_stats(spark, folder), ["driver_id"],
                             "event_timestamp", "event_timestamp", ["conv_rate"], "created")
    plan = _plan(out)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_four_shuffles_for_busy_keys(table):
    """Seconds, their frames, the frames put together, and the rows: one shuffle each."""
    frames = {"1d": 86_400, "7d": 7 * 86_400}
    rows = table.withColumn("t", table["tx_time_seconds"].cast("bigint"))
    out = history.past_only_features(rows, rows, "customer_id", frames, "c", HotKeys(), "t", "tx_amount", sliding_rows=1)
    plan = _plan(out)
    assert plan.count("Exchange") == 4 and plan.count("Join") == 1
    without = history.past_only_features(rows, rows, "customer_id", frames, "c", HotKeys(), "t", "tx_amount", 10**9)
    assert _plan(without).count("Exchange") == 1
