"""Physical-plan guards: the shapes the design relies on at scale."""

import pytest

import __spark_entry__ as E
from pulse.plans import catalog

SF = "/root/testdata/sf0.001"
KEYS = sorted(set(catalog.MART_QUERIES) | set(catalog.CHANGE_QUERIES) | set(catalog.SOURCE_QUERIES))
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df, capsys):
    capsys.readouterr()
    df.explain(mode="formatted")
    return capsys.readouterr().out


# Windows that run in a single partition are allowed only over the dense-id
# partition offsets (one row per partition, never fact rows).
SINGLE_PARTITION_WINDOWS = {"county_dimension", "delimited_scan", "dense_surrogate_id"}


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_products_or_python_udfs(spark, capsys, key):
    plan = _plan(E.queries()[key](spark, SF), capsys)
    assert not [f for f in FORBIDDEN if f in plan]
    if "Window" in plan and "SinglePartition" in plan:
        assert key in SINGLE_PARTITION_WINDOWS


def test_small_increment_upsert_reads_target_once_at_full_width(spark, capsys):
    plan = _plan(E.queries()["upsert_preserve"](spark, SF), capsys)
    assert "FullOuter" not in plan
    # the other scans of the orders read the key only
    assert sum("o_orderpriority:string" in line for line in plan.splitlines() if line.startswith("ReadSchema")) == 1


@pytest.mark.parametrize("key", ["rate_per_1000", "rate_geo", "mart_filtered", "new_by_activity", "kpi_recent_total"])
def test_founding_dates_are_pruned_in_the_scan(spark, capsys, key):
    plan = _plan(E.queries()[key](spark, SF), capsys)
    assert any(line.startswith(("PushedFilters", "DataFilters")) and "GreaterThanOrEqual(o_orderdate" in line
               for line in plan.splitlines())


def test_incremental_metrics_read_stored_steps(spark, capsys):
    plan = _plan(E.queries()["incremental_run_metrics"](spark, SF), capsys)
    assert plan.count("Scan parquet") <= 3


def test_crosswalk_resolution_is_an_aggregate_not_a_window(spark, capsys):
    plan = _plan(E.queries()["crosswalk_resolve"](spark, SF), capsys)
    assert "Window" not in plan
    assert "Aggregate" in plan
