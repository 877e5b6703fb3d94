"""What the physical plans must and must not contain."""

import pytest

from tradeledger.catalog import REPORTS
from tradeledger.operators.preagg import shipments_by
from tradeledger.plans import shipments

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEvalPython",
             "MapInPandas", "Expand")
# Reports that look at no operator, and so have no business reading orders.
LEAN = (
    "q01_distributor_yoy", "q09_top_products", "q11_seasonality", "kpi_yoy_growth",
    "readme_net_sales_margin", "readme_yoy_total", "yoy_total_latest", "dash_region_sales",
    "dash_top_distributors", "dash_margin_bar", "dash_yoy_top", "dq_net_pct_band",
    "dq_net_le_gross", "dq_rate_caps", "dq_quantity_iqr",
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_no_cross_join_and_no_python(fixture_star, name):
    plan = plan_of(REPORTS[name](fixture_star))
    for operator in FORBIDDEN:
        assert operator not in plan, operator


@pytest.mark.parametrize("name", LEAN)
def test_lean_reports_join_nothing_for_operators(fixture_star, name):
    assert "orders.parquet" not in plan_of(REPORTS[name](fixture_star))


def test_scans_read_only_needed_columns(fixture_star):
    plan = plan_of(shipments_by(fixture_star, "distributor_id").select("distributor_id", "quantity"))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan


def test_rep_reports_drop_the_unused_fact(fixture_star):
    """Catalyst removes the left join whose summed side nobody reads."""
    from tradeledger.plans import crm

    deals_only = plan_of(crm.rep_frame(fixture_star).select("rep_id", "revenue"))
    assert "event_type" not in deals_only


def test_top_n_is_taken_per_task(fixture_star):
    for name in ("q02_rep_win_rate", "q07_monthly_sales_trend", "q09_top_products",
                 "dash_top_territories"):
        assert "TakeOrderedAndProject" in plan_of(REPORTS[name](fixture_star))


def test_sums_combine_before_the_shuffle(fixture_star):
    plan = plan_of(REPORTS["kpi_yoy_growth"](fixture_star))
    assert "partial_sum" in plan


@pytest.mark.parametrize(
    "name, file",
    [
        ("readme_yoy_total", "lineitem"), ("yoy_total_latest", "lineitem"),
        ("q11_seasonality", "lineitem"), ("q06_pipeline_by_stage", "orders"),
        ("q10_loss_reasons", "orders"), ("dash_pipeline_funnel", "orders"),
        ("dash_stage_share", "orders"), ("dq_quantity_iqr", "lineitem"),
    ],
)
def test_totals_do_not_read_the_facts_again(fixture_star, name, file):
    df = REPORTS[name](fixture_star)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    # the subquery's plan follows its own initial plan; count reads in the final ones
    assert final.count(f"{file}.parquet") <= 1


def test_summed_branches_meet_without_another_shuffle(fixture_star):
    """Sums and distinct counts are hashed by the grain already."""
    df = shipments_by(fixture_star, "month_start", distinct=("active_operators",))
    plan = plan_of(df)
    above_union = plan[: plan.index("Union")]
    assert "Exchange" not in above_union


PERIOD = (
    "q01_distributor_yoy", "q04_active_operators", "dash_yoy_top", "slice_scorecards_year_type",
    "slice_scorecard_view_region", "slice_heatmap_year_region", "slice_yoy_region", "slice_monthly_trends_year",
    "slice_region_sales_year", "slice_top_distributors_year", "slice_executive_summary_year",
)


@pytest.mark.parametrize("name", PERIOD)
def test_periods_reach_the_scan_of_the_shipments(fixture_star, name):
    plan = plan_of(REPORTS[name](fixture_star))
    assert "GreaterThanOrEqual(l_shipdate" in plan or "l_shipdate" in plan and "Subquery subquery" in plan


@pytest.mark.parametrize("name", ["slice_rankings_year_region", "slice_heatmap_year_region", "slice_pipeline_year"])
def test_periods_reach_the_scan_of_the_orders(fixture_star, name):
    assert "GreaterThanOrEqual(o_orderd" in plan_of(REPORTS[name](fixture_star))  # the text is cut off there


def test_q04_reads_the_last_week_once_and_ahead(fixture_star):
    """The plan has no scan more than with a given day; with none loaded nothing is reported."""
    free = plan_of(shipments.q04_active_operators(fixture_star))
    fixed = plan_of(shipments.q04_active_operators(fixture_star, as_of=shipments.last_week(fixture_star)))
    assert free.count("Scan parquet") == fixed.count("Scan parquet")
    assert "Subquery" not in free
