"""What the plans of the queries look like once they have run."""

import pytest

import __spark_entry__
from helpers import final_plan, planned, table_scans

QUERIES = __spark_entry__.queries()


@pytest.mark.parametrize(
    "name",
    [
        "tickets_per_officer",
        "top_officer",
        "top_officer_strict",
        "top_months_with_ties",
        "officer_and_month_counts",
        "mom_change",
        "seasonal_index",
        "month_rank_in_year",
        "month_grid",
        "ticket_vehicle_owner",
        "owner_totals_as_coded",
        "top_payers_as_coded",
        "top_payers_with_ties",
    ],
)
def test_tickets_are_scanned_once(spark, sf, name):
    assert table_scans(QUERIES[name](spark, sf))["lineitem"] == 1


def test_report_scans_tickets_twice(spark, sf):
    """Once for the fees here, and once before for the counts that three questions share."""
    assert table_scans(QUERIES["report_lines"](spark, sf))["lineitem"] == 1


@pytest.mark.parametrize("name", ["top_payers_as_coded", "ticket_cost_lookup", "report_lines"])
def test_no_python_in_the_plan(spark, sf, name):
    plan = planned(QUERIES[name](spark, sf))
    assert "Python" not in plan and "Arrow" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = planned(QUERIES["officer_filter"](spark, sf))
    assert "GreaterThan(s_acctbal,0.0)" in plan
    for name in ("top_payers_as_coded", "ticket_vehicle_owner"):
        plan = planned(QUERIES[name](spark, sf))
        assert "l_extendedprice" not in plan and "o_totalprice" not in plan


@pytest.mark.parametrize("name", ["top_months", "top_payers_as_coded", "top_payers_with_ties"])
def test_top_k_is_planned_as_top_k(spark, sf, name):
    assert "TakeOrderedAndProject" in final_plan(QUERIES[name](spark, sf))


@pytest.mark.parametrize("name", ["tickets_per_officer", "month_counts", "owner_totals_as_coded"])
def test_rows_are_combined_before_the_shuffle(spark, sf, name):
    assert "partial_" in planned(QUERIES[name](spark, sf))


def test_only_the_top_rows_are_broadcast_by_hint(spark, sf, set_conf):
    """Without size-based broadcasts, one remains: the ten payers."""
    set_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    plan = final_plan(QUERIES["top_payers_as_coded"](spark, sf))
    assert plan.count("BroadcastHashJoin") == 1
    assert plan.count("SortMergeJoin") == 2
