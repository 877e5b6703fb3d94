"""Roll-ups the dashboard pages make of the KPI products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.functions import display, kpis
from tradeledger.operators.preagg import merge_single_rows
from tradeledger.operators.ranking import with_rank
from tradeledger.plans import crm, shipments, territory
from tradeledger.star import Star


# ---- distributors ---------------------------------------------------------

def dash_region_sales(star: Star, year: int | None = None) -> DataFrame:
    return (
        shipments.distributor_money(star, year)
        .groupBy(F.coalesce("region", F.lit("Unknown")).alias("region"))
        .agg(F.coalesce(F.sum("net_sales"), F.lit(0)).alias("net_sales"))
    )


def dash_top_distributors(star: Star, n: int = 8, year: int | None = None) -> DataFrame:
    """``label`` is the short form under a chart's bar; id and name say who it is."""
    return (
        shipments.distributor_money(star, year)
        .orderBy(F.desc("net_sales"), "distributor_id")
        .limit(n)
        .select(
            "distributor_id",
            "distributor_name",
            F.substring("distributor_name", 1, 15).alias("label"),
            "net_sales",
        )
    )


def dash_margin_bar(
    star: Star,
    year: int | None = None,
    distributor_type: str | None = None,
    region: str | None = None,
) -> DataFrame:
    """The margin in percent, and the width of its bar: three times that, at most 100.

    For the bar a missing margin counts as 0 and a missing or zero net as 1.
    """
    net = F.coalesce(F.nullif(F.col("net_sales"), F.lit(0)), F.lit(1))
    width = kpis.ratio(F.coalesce(kpis.gross_margin(), F.lit(0)), net, 2, 300.0)
    return shipments.distributor_money(star, year, distributor_type, region).select(
        "distributor_id",
        "distributor_name",
        kpis.margin_pct(digits=2).alias("margin_pct"),
        F.least(F.lit(100.0), width).alias("bar_width"),
    )


def dash_distributor_totals(
    star: Star,
    year: int | None = None,
    distributor_type: str | None = None,
    region: str | None = None,
) -> DataFrame:
    rows = shipments.scorecard_rows(star, year, distributor_type, region)
    return rows.agg(
        F.count(F.lit(1)).alias("distributors"),
        F.coalesce(F.sum("net_sales"), F.lit(0)).alias("net_sales"),
        F.sum("active_operators").alias("operators_served"),
        F.max("products_sold").alias("max_products"),
    )


def dash_distributor_cards(
    star: Star,
    year: int | None = None,
    distributor_type: str | None = None,
    region: str | None = None,
) -> DataFrame:
    """The text on each distributor card."""
    return shipments.scorecard_rows(star, year, distributor_type, region).select(
        "distributor_id",
        "distributor_name",
        F.concat_ws(" / ", "distributor_type", F.coalesce("region", F.lit("N/A"))).alias("subtitle"),
        display.fmt_compact_money(F.coalesce("net_sales", F.lit(0))).alias("net_sales"),
        display.fmt_compact("active_operators").alias("operators"),
        display.fmt_compact("products_sold").alias("products"),
        display.fmt_percent(F.coalesce("return_rate", F.lit(0.0))).alias("return_rate"),
        display.fmt_compact_money(F.coalesce("gross_margin", F.lit(0))).alias("margin"),
    )


def dash_yoy_top(star: Star, year: int = shipments.DEFAULT_YEAR, n: int = 5) -> DataFrame:
    growth = F.coalesce("yoy_growth", F.lit(0.0))
    return (
        shipments.growth_rows(star, year)
        .orderBy(F.desc("net_sales"), "distributor_name")
        .limit(n)
        .select(
            "distributor_name",
            "distributor_type",
            "net_sales",
            "yoy_growth",
            F.when(growth >= 0, "success").otherwise("danger").alias("band"),
        )
    )


# ---- reps -----------------------------------------------------------------

def _win_rate():
    return F.coalesce("win_rate", F.lit(0.0))


def dash_top_reps(star: Star, n: int = 5, year: int | None = None) -> DataFrame:
    return (
        crm.ranking_rows(star, year)
        .orderBy(F.desc("revenue"), "rep_id")
        .limit(n)
        .select(
            "rep_name",
            F.coalesce("territory_name", F.lit("N/A")).alias("territory_name"),
            "revenue",
            "win_rate",
            F.when(_win_rate() >= 40, "success").otherwise("warning").alias("win_band"),
            "won",
        )
    )


def dash_rep_leaderboard(star: Star, year: int | None = None, region: str | None = None) -> DataFrame:
    ranked = with_rank(crm.ranking_rows(star, year, region), "revenue", "rep_id")
    quota = F.coalesce("quota_attainment", F.lit(0.0))
    return ranked.select(
        "rank",
        (F.col("rank") <= 3).alias("top_three"),
        "rep_id",
        "rep_name",
        F.coalesce("rep_tier", F.lit("N/A")).alias("rep_tier"),
        F.coalesce("territory_name", F.lit("N/A")).alias("territory_name"),
        "revenue",
        "win_rate",
        F.when(_win_rate() >= 40, "success")
        .when(_win_rate() >= 25, "warning")
        .otherwise("danger")
        .alias("win_band"),
        "won",
        "opportunities",
        "avg_deal",
        "quota_attainment",
        F.when(quota >= 100, "success").otherwise("warning").alias("quota_band"),
        "activities",
    )


def dash_rep_totals(star: Star, year: int | None = None, region: str | None = None) -> DataFrame:
    """Means over reps count a missing rate or deal size as 0.

    Rates and sizes are short decimals; summing them as such keeps the mean
    independent of the order of addition.
    """
    rates = F.sum(_win_rate().cast("decimal(18,1)"))
    deals = F.sum(F.coalesce("avg_deal", F.lit(0.0)).cast("decimal(18,2)"))
    reps = F.count(F.lit(1))
    return crm.ranking_rows(star, year, region).agg(
        reps.alias("reps"),
        kpis.ratio(rates, reps, 1).alias("avg_win_rate"),
        kpis.ratio(deals, reps, 2).alias("avg_deal"),
        F.coalesce(F.sum("activities"), F.lit(0)).alias("total_activities"),
    )


def dash_win_rate_by_tier(
    star: Star, year: int | None = None, region: str | None = None
) -> DataFrame:
    rates = F.sum(_win_rate().cast("decimal(18,1)"))
    return (
        crm.ranking_rows(star, year, region)
        .groupBy(F.coalesce("rep_tier", F.lit("Unknown")).alias("rep_tier"))
        .agg(
            F.count(F.lit(1)).alias("reps"),
            kpis.ratio(rates, F.count(F.lit(1)), 2).alias("avg_win_rate"),
        )
    )


# ---- territories ----------------------------------------------------------

def dash_region_rollup(star: Star) -> DataFrame:
    return (
        territory.heatmap_rows(star)
        .groupBy(F.coalesce("region", F.lit("Unknown")).alias("region"))
        .agg(
            F.count(F.lit(1)).alias("territories"),
            F.coalesce(F.sum("net_sales"), F.lit(0)).alias("net_sales"),
            F.sum("operators").alias("operators"),
        )
    )


def dash_top_territories(star: Star, n: int = 10) -> DataFrame:
    return (
        territory.heatmap_rows(star)
        .orderBy(F.desc("net_sales"), "territory_id")
        .limit(n)
        .select(
            "territory_name",
            "state",
            "region",
            F.coalesce("net_sales", F.lit(0)).alias("net_sales"),
            "operators",
            "reps",
        )
    )


# ---- open deals -----------------------------------------------------------

def dash_pipeline_funnel(star: Star) -> DataFrame:
    stages = crm.stage_rows(star).select("stage", "count", "value")
    largest = crm.over_all(stages, "value", F.max)
    return stages.select(
        "stage", "count", "value", kpis.percent(F.col("value"), largest, 2).alias("pct_of_largest")
    )


def dash_pipeline_totals(star: Star) -> DataFrame:
    return crm.stage_rows(star).agg(
        F.coalesce(F.sum("value"), F.lit(0)).alias("total_value"),
        F.coalesce(F.sum("weighted_value"), F.lit(0)).alias("weighted_value"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("open_count"),
    )


def dash_stage_share(star: Star) -> DataFrame:
    stages = crm.stage_rows(star).select("stage", "value")
    return stages.select("stage", crm.share_of_total(stages, "value").alias("pct_of_pipeline"))


# ---- headline cards -------------------------------------------------------

def dash_headline_cards(star: Star, year: int | None = None) -> DataFrame:
    """The six headline figures as printed on the front page, one row."""
    figures = merge_single_rows(
        shipments.shipment_totals(star, year).select(
            F.col("total_net_sales").alias("net_sales"),
            F.col("total_units").alias("quantity"),
            F.col("total_operators").alias("active_operators"),
        ),
        crm.deal_totals(star, year).select("win_rate", "avg_deal_size", "pipeline_value"),
    )

    def zero(name: str):
        return F.coalesce(F.col(name), F.lit(0))

    return figures.select(
        display.fmt_compact_money(zero("net_sales")).alias("total_net_sales"),
        display.fmt_compact(zero("quantity")).alias("total_units"),
        display.fmt_compact(zero("active_operators")).alias("active_operators"),
        display.fmt_percent(zero("win_rate")).alias("win_rate"),
        display.fmt_compact_money(zero("avg_deal_size")).alias("avg_deal_size"),
        display.fmt_compact_money(zero("pipeline_value")).alias("pipeline_value"),
    )
