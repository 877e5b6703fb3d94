"""Every report by name, bound to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.functions.display import with_display
from tradeledger.operators import quality
from tradeledger.plans import crm, dashboard, roundtrip, shipments, territory
from tradeledger.sources import fixtures
from tradeledger.sources.schemas import PRIMARY_KEYS

Report = Callable[..., DataFrame]

# The last full year of the test tables, and the days they cover.
YEAR = 2000
DAYS = {"first": date(1995, 1, 1), "last": date(2001, 12, 31)}
# Their shipments have no id, so uniqueness is tested on what identifies a row.
KEYS = {
    **PRIMARY_KEYS,
    "shipments": ("shipment_date", "distributor_id", "operator_id", "product_id"),
}

ANALYST = {
    "q01_distributor_yoy": partial(shipments.q01_distributor_yoy, year=YEAR),
    "q02_rep_win_rate": crm.q02_rep_win_rate,
    "q03_lead_source_deals": crm.q03_lead_source_deals,
    "q04_active_operators": shipments.q04_active_operators,
    "q05_activity_revenue": crm.q05_activity_revenue,
    "q06_pipeline_by_stage": crm.q06_pipeline_by_stage,
    "q07_monthly_sales_trend": shipments.q07_monthly_sales_trend,
    "q08_territory_ranking": territory.q08_territory_ranking,
    "q09_top_products": shipments.q09_top_products,
    "q10_loss_reasons": crm.q10_loss_reasons,
    "q11_seasonality": shipments.q11_seasonality,
}

# Which columns of an analyst query are printed as money and as percentages.
PRINTED: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "q01_distributor_yoy": (("current_year_sales", "prior_year_sales"), ("yoy_growth",)),
    "q02_rep_win_rate": (("revenue_won",), ()),
    "q03_lead_source_deals": (("avg_deal_size", "total_revenue"), ()),
    "q04_active_operators": (("net_sales", "revenue_per_operator"), ()),
    "q05_activity_revenue": (("revenue",), ()),
    "q06_pipeline_by_stage": (("pipeline_value", "weighted_value"), ("pct_of_pipeline",)),
    "q07_monthly_sales_trend": (("net_sales", "gross_margin"), ("margin_pct",)),
    "q08_territory_ranking": (("net_sales", "sales_per_rep"), ()),
    "q09_top_products": (("net_sales", "gross_margin"), ("margin_pct",)),
    "q10_loss_reasons": (("lost_revenue",), ("pct_of_losses",)),
    "q11_seasonality": (("avg_monthly_sales",), ()),
}

VIEWS = {
    "vw_distributor_scorecard": shipments.vw_distributor_scorecard,
    "vw_rep_performance": crm.vw_rep_performance,
    "vw_pipeline_health": crm.vw_pipeline_health,
    "vw_territory_summary": territory.vw_territory_summary,
}

SUMMARIES = {
    "an_yoy_growth": shipments.an_yoy_growth,
    "an_rep_summary": crm.an_rep_summary,
    "an_monthly_trend": shipments.an_monthly_trend,
}

PRODUCTS = {
    "kpi_executive_summary": crm.kpi_executive_summary,
    "kpi_yoy_growth": shipments.kpi_yoy_growth,
    "kpi_distributor_scorecards": shipments.kpi_distributor_scorecards,
    "kpi_rep_rankings": crm.kpi_rep_rankings,
    "kpi_territory_heatmap": territory.kpi_territory_heatmap,
    "kpi_pipeline_health": crm.kpi_pipeline_health,
    "kpi_monthly_trends": shipments.kpi_monthly_trends,
    "kpi_activity_correlation": crm.kpi_activity_correlation,
}

DOCUMENTED = {
    "readme_net_sales_margin": shipments.readme_net_sales_margin,
    "readme_win_rate": crm.readme_win_rate,
    "readme_yoy_total": shipments.readme_yoy_total,
    "shipment_monthly_summary": shipments.shipment_monthly_summary,
}

DASHBOARD = {
    "dash_region_sales": dashboard.dash_region_sales,
    "dash_top_distributors": dashboard.dash_top_distributors,
    "dash_top_reps": dashboard.dash_top_reps,
    "dash_yoy_top": partial(dashboard.dash_yoy_top, year=YEAR),
    "dash_rep_leaderboard": dashboard.dash_rep_leaderboard,
    "dash_region_rollup": dashboard.dash_region_rollup,
    "dash_top_territories": dashboard.dash_top_territories,
    "dash_pipeline_funnel": dashboard.dash_pipeline_funnel,
    "dash_pipeline_totals": dashboard.dash_pipeline_totals,
    "dash_stage_share": dashboard.dash_stage_share,
    "dash_distributor_totals": dashboard.dash_distributor_totals,
    "dash_rep_totals": dashboard.dash_rep_totals,
    "dash_win_rate_by_tier": dashboard.dash_win_rate_by_tier,
    "dash_margin_bar": dashboard.dash_margin_bar,
    "dash_distributor_cards": dashboard.dash_distributor_cards,
    "dash_headline_cards": dashboard.dash_headline_cards,
}

PROMISED = {
    "win_rate_trend_monthly": crm.win_rate_trend_monthly,
    "deal_velocity": crm.deal_velocity,
    "activity_revenue_corr": crm.activity_revenue_corr,
    "yoy_total_latest": shipments.yoy_total_latest,
}

# The filters the dashboards offer, on the reports behind each page.
SLICES = {
    "slice_scorecards_year_type": partial(
        shipments.kpi_distributor_scorecards, year=YEAR, distributor_type="National"
    ),
    "slice_scorecard_view_region": partial(
        shipments.vw_distributor_scorecard, year=YEAR, region="ASIA"
    ),
    "slice_heatmap_year_region": partial(
        territory.kpi_territory_heatmap, year=YEAR, region="EUROPE"
    ),
    "slice_rankings_year_region": partial(crm.kpi_rep_rankings, year=YEAR, region="AMERICA"),
    "slice_yoy_region": partial(shipments.kpi_yoy_growth, year=YEAR, region="ASIA"),
    "slice_monthly_trends_year": partial(shipments.kpi_monthly_trends, year=YEAR),
    "slice_rep_performance_year": partial(crm.vw_rep_performance, year=YEAR),
    "slice_executive_summary_year": partial(crm.kpi_executive_summary, year=YEAR),
    "slice_pipeline_year": partial(crm.kpi_pipeline_health, year=YEAR),
    "slice_headline_cards_year": partial(dashboard.dash_headline_cards, year=YEAR),
    "slice_region_sales_year": partial(dashboard.dash_region_sales, year=YEAR),
    "slice_top_distributors_year": partial(dashboard.dash_top_distributors, year=YEAR),
    "slice_top_reps_year": partial(dashboard.dash_top_reps, year=YEAR),
    "slice_distributor_totals_type": partial(
        dashboard.dash_distributor_totals, distributor_type="Regional"
    ),
    "slice_distributor_cards_type": partial(
        dashboard.dash_distributor_cards, distributor_type="Specialty"
    ),
    "slice_margin_bar_type": partial(dashboard.dash_margin_bar, distributor_type="National"),
    "slice_leaderboard_region": partial(dashboard.dash_rep_leaderboard, region="ASIA"),
    "slice_rep_totals_region": partial(dashboard.dash_rep_totals, region="EUROPE"),
    "slice_win_rate_tier_region": partial(dashboard.dash_win_rate_by_tier, region="AFRICA"),
    "slice_activity_correlation_region": partial(crm.kpi_activity_correlation, region="AMERICA"),
}

QUALITY = {
    "dq_row_counts": quality.dq_row_counts,
    "dq_nulls": quality.dq_nulls,
    "dq_fk_orphans": quality.dq_fk_orphans,
    "dq_fk_left_join": quality.dq_fk_left_join,
    "dq_date_ranges": quality.dq_date_ranges,
    "dq_win_rate_band": quality.dq_win_rate_band,
    "dq_net_pct_band": quality.dq_net_pct_band,
    "dq_avg_deal_band": quality.dq_avg_deal_band,
    "dq_summary_stats": quality.dq_summary_stats,
    "dq_issue_summary": partial(quality.dq_issue_summary, keys=KEYS, **DAYS),
    "dq_net_identity": quality.dq_net_identity,
    "dq_net_le_gross": quality.dq_net_le_gross,
    "dq_date_bounds": partial(quality.dq_date_bounds, **DAYS),
    "dq_rate_caps": quality.dq_rate_caps,
    "dq_quantity_iqr": quality.dq_quantity_iqr,
    "dq_quantity_flags": quality.dq_quantity_flags,
    "dq_deal_amount_range": quality.dq_deal_amount_range,
    "dq_pk_unique": partial(quality.dq_pk_unique, keys=KEYS),
    "dq_join_fanout": quality.dq_join_fanout,
}

SOURCES_AND_SINKS = {
    "read_master": roundtrip.read_master,
    "read_crm": roundtrip.read_crm,
    "read_shipments": roundtrip.read_shipments,
    "read_view": roundtrip.read_view,
    "read_json_product": roundtrip.read_json_product,
    "write_star": roundtrip.write_star,
    "write_rollups": roundtrip.write_rollups,
    "write_summary": roundtrip.write_summary,
    "write_json": roundtrip.write_json,
    "write_kpi_card": roundtrip.write_kpi_card,
    "write_csv_by_year": roundtrip.write_csv_by_year,
    "append_shipments": roundtrip.append_shipments,
    "append_rollups": roundtrip.append_rollups,
    "read_rejected": roundtrip.read_rejected,
    "state_cube": roundtrip.sales_cube,
    "state_operators": roundtrip.operator_states,
    "state_quantities": roundtrip.quantity_states,
    "dq_while_writing": partial(roundtrip.checks_while_writing, **DAYS),
}


def _printed(report: Report, money: tuple[str, ...], percent: tuple[str, ...]) -> Report:
    return lambda star: with_display(report(star), money, percent)


DISPLAY = {f"display_{key}": _printed(ANALYST[key], *PRINTED[key]) for key in ANALYST}

REPORTS: dict[str, Report] = {
    **ANALYST, **VIEWS, **SUMMARIES, **PRODUCTS, **DOCUMENTED, **DASHBOARD,
    **PROMISED, **SLICES, **QUALITY, **DISPLAY, **SOURCES_AND_SINKS,
}


def money_as_double(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, for consumers that have no decimal type."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def on_fixtures(report: Report) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return money_as_double(report(fixtures.star(spark, sf_dir)))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: on_fixtures(report) for name, report in REPORTS.items()}
