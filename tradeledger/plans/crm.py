"""Reports over deals and activities: reps, stages, sources and losses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions import dates, kpis
from tradeledger.operators.preagg import activities_by, merge_single_rows, opps_by
from tradeledger.plans.shipments import shipment_totals
from tradeledger.sources.schemas import DIRECTOR
from tradeledger.star import Star


# ---- reps -----------------------------------------------------------------

def rep_frame(
    star: Star,
    directors: bool = False,
    year: int | None = None,
    region: str | None = None,
    territory: str = "left",
) -> DataFrame:
    """One row per rep with deal and activity figures next to each other.

    Both facts are summed per owner before the join. Reports that read only
    one of them lose the other join again: Catalyst drops a left join whose
    right side is unique on the key and unused. ``year`` limits deals by close
    date and activities by their own date.
    """
    reps = star.sales_reps
    if not directors:
        reps = reps.filter(F.col("rep_tier") != DIRECTOR)
    places = star.territories.select("territory_id", "territory_name", "region")
    if region is not None:
        places = places.filter(F.col("region") == region)
        territory = "inner"
    deals = opps_by(star, "owner_id", year=year).withColumnRenamed("owner_id", "deal_owner")
    acts = activities_by(star, "owner_id", year=year).withColumnRenamed("owner_id", "act_owner")
    reps = reps.join(places, "territory_id", territory)
    joined = reps.join(deals, reps["rep_id"] == deals["deal_owner"], "left").join(
        acts, reps["rep_id"] == acts["act_owner"], "left"
    )
    zero_money = F.lit(0).cast("decimal(18,2)")
    return joined.select(
        "rep_id",
        "rep_name",
        "rep_tier",
        "territory_name",
        "region",
        "quota_annual",
        *[
            F.coalesce(F.col(c), F.lit(0)).alias(c)
            for c in ("opportunities", "won", "lost", "activities", "calls", "meetings", "site_visits")
        ],
        F.coalesce(F.col("revenue"), zero_money).alias("revenue"),
        kpis.average("revenue", "priced_wins").alias("avg_deal"),
    )


def q02_rep_win_rate(star: Star, n: int = 20, region: str | None = None) -> DataFrame:
    return (
        rep_frame(star, region=region, territory="inner")
        .filter(F.col("opportunities") > 0)
        .orderBy(F.desc("revenue"), "rep_id")
        .limit(n)
        .select(
            "rep_name",
            "rep_tier",
            "territory_name",
            F.col("opportunities").alias("total_opportunities"),
            "won",
            "lost",
            kpis.win_rate().alias("win_rate_pct"),
            F.col("revenue").alias("revenue_won"),
        )
    )


def q05_activity_revenue(star: Star, n: int = 20) -> DataFrame:
    return (
        rep_frame(star)
        .filter(F.col("activities") > 0)
        .orderBy(F.desc("revenue"), "rep_id")
        .limit(n)
        .select(
            "rep_name",
            F.col("activities").alias("total_activities"),
            "calls",
            "meetings",
            "site_visits",
            "revenue",
            kpis.ratio(F.col("revenue"), F.col("activities"), 2).alias("revenue_per_activity"),
        )
    )


def an_rep_summary(star: Star) -> DataFrame:
    return rep_frame(star, directors=True).select(
        "rep_id",
        "rep_name",
        "rep_tier",
        "territory_name",
        "region",
        F.col("opportunities").alias("total_opportunities"),
        F.col("won").alias("won_deals"),
        F.col("lost").alias("lost_deals"),
        kpis.win_rate_all("won", "opportunities").alias("win_rate_all"),
        F.col("revenue").alias("total_revenue"),
        F.col("avg_deal").alias("avg_deal_size"),
        F.col("activities").alias("total_activities"),
    )


def ranking_rows(star: Star, year: int | None = None, region: str | None = None) -> DataFrame:
    """``year`` restricts deals and activities to it, so that revenue and the
    annual quota cover the same time; without it revenue is all-time."""
    return rep_frame(star, year=year, region=region).select(
        "rep_id",
        "rep_name",
        "rep_tier",
        "territory_name",
        "region",
        "quota_annual",
        "opportunities",
        "won",
        "lost",
        kpis.win_rate().alias("win_rate"),
        "revenue",
        "avg_deal",
        kpis.quota_attainment("revenue", "quota_annual").alias("quota_attainment"),
        "activities",
        kpis.ratio(F.col("activities"), F.col("opportunities"), 1).alias("activities_per_opp"),
    )


def kpi_rep_rankings(star: Star, year: int | None = None, region: str | None = None) -> DataFrame:
    return ranking_rows(star, year, region).orderBy(F.desc("revenue"), "rep_id")


def kpi_activity_correlation(star: Star, year: int | None = None, region: str | None = None) -> DataFrame:
    return (
        rep_frame(star, year=year, region=region)
        .filter(F.col("activities") > 0)
        .select(
            "rep_id",
            "rep_name",
            F.col("activities").alias("total_activities"),
            "calls",
            "meetings",
            "site_visits",
            "revenue",
        )
    )


def activity_revenue_corr(star: Star) -> DataFrame:
    """Pearson correlation of activities and revenue over reps with activities."""
    return kpi_activity_correlation(star).agg(
        F.count(F.lit(1)).alias("reps"),
        F.round(
            F.corr(F.col("total_activities").cast("double"), F.col("revenue").cast("double")), 6
        ).alias("correlation"),
    )


def vw_rep_performance(star: Star, year: int | None = None, region: str | None = None) -> DataFrame:
    """Rep by year of close date; activities count in years that have deals.

    A rep without deals keeps a row without a year; a filter on the year drops it.
    """
    deals = opps_by(star, "owner_id", F.year("close_date").alias("year"), year=year)
    acts = activities_by(star, "owner_id", F.year("activity_date").alias("act_year"), year=year)
    acts = acts.select(F.col("owner_id").alias("act_owner"), "act_year", "activities")
    # A NULL close year or activity year equals nothing, as it should.
    by_year = deals.join(
        acts,
        (deals["owner_id"] == acts["act_owner"]) & (deals["year"] == acts["act_year"]),
        "left",
    )
    places = star.territories.select("territory_id", "territory_name", "region")
    if region is not None:
        places = places.filter(F.col("region") == region)
    reps = star.sales_reps.join(places, "territory_id", "left" if region is None else "inner")
    zero_money = F.lit(0).cast("decimal(18,2)")
    how = "left" if year is None else "inner"
    return reps.join(by_year, reps["rep_id"] == by_year["owner_id"], how).select(
        "rep_id",
        "rep_name",
        "rep_tier",
        "territory_name",
        "region",
        "year",
        F.coalesce("opportunities", F.lit(0)).alias("total_opportunities"),
        F.coalesce("won", F.lit(0)).alias("won_deals"),
        F.coalesce("lost", F.lit(0)).alias("lost_deals"),
        kpis.win_rate_all("won", "opportunities").alias("win_rate_all"),
        F.coalesce("revenue", zero_money).alias("total_revenue"),
        kpis.average("revenue", "priced_wins").alias("avg_deal_size"),
        F.coalesce("activities", F.lit(0)).alias("total_activities"),
    )


# ---- open deals -----------------------------------------------------------

def stage_rows(star: Star, year: int | None = None) -> DataFrame:
    """Open deals by stage; ``year`` keeps those expected to close in it."""
    return opps_by(star, "stage", where=kpis.is_open(), year=year).select(
        "stage",
        F.col("opportunities").alias("count"),
        F.col("amount").alias("value"),
        kpis.average("probability_sum", "probability_count", digits=None).alias("avg_probability"),
        "weighted_value",
    )


def kpi_pipeline_health(star: Star, year: int | None = None) -> DataFrame:
    return stage_rows(star, year).orderBy("avg_probability", "stage")


def over_all(df: DataFrame, column: str, how: Callable[[str], Column] = F.sum) -> Column:
    """``how(column)`` over all rows of an aggregated frame, as a scalar subquery.

    The subquery touches every column of ``df``. It then needs the very same
    shuffle as the frame itself, and Spark runs that once for both; if unused
    columns were left out, the facts would be read a second time.
    """
    rest = [F.max(c).alias(c) for c in df.columns if c != column]
    totals = df.agg(F.struct(how(column).alias("figure"), *rest))
    return totals.scalar()["figure"]


def share_of_total(df: DataFrame, column: str) -> Column:
    """Percent of the column's sum over all rows."""
    return kpis.percent(F.col(column), over_all(df, column))


def q06_pipeline_by_stage(star: Star) -> DataFrame:
    stages = stage_rows(star)
    return stages.select(
        "stage",
        F.col("count").alias("opportunity_count"),
        F.col("value").alias("pipeline_value"),
        kpis.half_up(F.col("avg_probability"), 0).alias("avg_probability"),
        "weighted_value",
        share_of_total(stages, "value").alias("pct_of_pipeline"),
    ).orderBy("avg_probability", "stage")


def vw_pipeline_health(star: Star) -> DataFrame:
    created = dates.month_start("created_date").alias("created_month")
    return opps_by(star, created, "stage", where=kpis.is_open()).select(
        dates.month_label("created_month").alias("period"),
        "stage",
        F.col("opportunities").alias("opportunity_count"),
        F.col("amount").alias("pipeline_value"),
        kpis.average("probability_sum", "probability_count", digits=None).alias("avg_probability"),
        F.col("weighted_value").alias("weighted_pipeline"),
    )


# ---- closed deals ---------------------------------------------------------

def q03_lead_source_deals(star: Star) -> DataFrame:
    return (
        opps_by(star, "lead_source", where=kpis.is_closed())
        .select(
            "lead_source",
            F.col("opportunities").alias("total_deals"),
            F.col("won").alias("won_deals"),
            kpis.percent(F.col("won"), F.col("opportunities")).alias("win_rate"),
            kpis.average("revenue", "priced_wins").alias("avg_deal_size"),
            F.col("revenue").alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "lead_source")
    )


def q10_loss_reasons(star: Star) -> DataFrame:
    reason = F.coalesce("loss_reason", F.lit("Unknown")).alias("loss_reason")
    losses = opps_by(star, reason, where=kpis.is_lost()).select(
        "loss_reason", "opportunities", "amount", "priced"
    )
    return losses.select(
        "loss_reason",
        F.col("opportunities").alias("lost_deals"),
        F.col("amount").alias("lost_revenue"),
        share_of_total(losses, "opportunities").alias("pct_of_losses"),
        kpis.average("amount", "priced").alias("avg_deal_size"),
    ).orderBy(F.desc("lost_deals"), "loss_reason")


def readme_win_rate(star: Star) -> DataFrame:
    return opps_by(star).select(kpis.win_rate(digits=2).alias("win_rate"))


def win_rate_trend_monthly(star: Star) -> DataFrame:
    closed = dates.month_start("close_date").alias("close_month")
    return (
        opps_by(star, closed, where=kpis.is_closed())
        .select(
            dates.month_label("close_month").alias("month"),
            "won",
            "lost",
            kpis.win_rate().alias("win_rate"),
        )
        .orderBy("month")
    )


def deal_velocity(star: Star) -> DataFrame:
    """Mean days from creation to close, by stage and the operator's revenue tier.

    Deals are summed per account and stage first; accounts and operators are
    then looked up for those sums only.
    """
    days = F.datediff("close_date", "created_date")
    per_account = star.sf_opportunities.groupBy("account_id", "stage").agg(
        F.count(days).alias("deals"), F.sum(days).alias("days")
    )
    accounts = star.sf_accounts.select("account_id", "operator_id")
    tiers = star.operators.select("operator_id", F.col("annual_revenue_tier").alias("revenue_tier"))
    return (
        per_account.join(accounts, "account_id", "left")
        .join(tiers, "operator_id", "left")
        .groupBy("stage", F.coalesce("revenue_tier", F.lit("Unknown")).alias("revenue_tier"))
        .agg(F.sum("deals").alias("deals"), F.sum("days").alias("days"))
        .select("stage", "revenue_tier", "deals", kpis.average("days", "deals", 1).alias("avg_days"))
        .orderBy("stage", "revenue_tier")
    )


# ---- executive summary ----------------------------------------------------

def deal_totals(star: Star, year: int | None = None) -> DataFrame:
    """The seven deal metrics of the executive summary, as one row."""
    return opps_by(star, year=year).select(
        F.col("opportunities").alias("total_opportunities"),
        F.col("won").alias("won_deals"),
        F.col("lost").alias("lost_deals"),
        kpis.win_rate().alias("win_rate"),
        F.col("revenue").alias("revenue_won"),
        kpis.average("revenue", "priced_wins").alias("avg_deal_size"),
        "pipeline_value",
    )


def kpi_executive_summary(star: Star, year: int | None = None) -> DataFrame:
    return merge_single_rows(shipment_totals(star, year), deal_totals(star, year))
