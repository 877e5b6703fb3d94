"""Territory reports.

A territory meets five facts and dimensions. Each branch is summed to the
territory on its own and only then joined, so no branch multiplies another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions import dates, kpis
from tradeledger.operators.preagg import opps_by, shipments_by
from tradeledger.star import Star


def _members(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("territory_id").agg(F.count(F.lit(1)).alias(name))


def _sales(star: Star, year: int | None = None) -> DataFrame:
    """Net sales by the territory of the operator that was shipped to."""
    period = None if year is None else dates.year_bounds(year)
    sold = shipments_by(star, "operator_id", period=period)
    per_operator = sold.select("operator_id", "net_sales")
    home = star.operators.select("operator_id", "territory_id")
    return (
        per_operator.join(home, "operator_id")
        .groupBy("territory_id")
        .agg(F.sum("net_sales").alias("net_sales"))
    )


def _deals(star: Star, year: int | None = None) -> DataFrame:
    """Deals by the territory of the operator behind the account."""
    per_account = opps_by(star, "account_id", year=year).select("account_id", "opportunities", "revenue")
    accounts = star.sf_accounts.select("account_id", "operator_id")
    home = star.operators.select("operator_id", "territory_id")
    return (
        per_account.join(accounts, "account_id")
        .join(home, "operator_id")
        .groupBy("territory_id")
        .agg(
            F.sum("opportunities").alias("opportunities"),
            F.sum("revenue").alias("revenue_won"),
        )
    )


def _territory_frame(star: Star, *branches: DataFrame, region: str | None = None) -> DataFrame:
    frame = star.territories.select("territory_id", "territory_name", "region", "state")
    if region is not None:
        frame = frame.filter(F.col("region") == region)
    for branch in branches:
        frame = frame.join(branch, "territory_id", "left")
    return frame


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def q08_territory_ranking(star: Star, region: str | None = None) -> DataFrame:
    frame = _territory_frame(
        star,
        _members(star.operators, "operators"),
        _members(star.sales_reps, "reps"),
        _sales(star),
        region=region,
    )
    return frame.select(
        "territory_name",
        "region",
        "state",
        _or_zero("operators").alias("operators"),
        _or_zero("reps").alias("reps"),
        _or_zero("net_sales").alias("net_sales"),
        F.coalesce(kpis.ratio(F.col("net_sales"), F.col("reps"), 2), F.lit(0.0)).alias(
            "sales_per_rep"
        ),
    ).orderBy(F.desc("net_sales"), "territory_name")


def vw_territory_summary(star: Star, region: str | None = None) -> DataFrame:
    frame = _territory_frame(
        star,
        _members(star.operators, "total_operators"),
        _members(star.sales_reps, "total_reps"),
        _members(star.distributors, "total_distributors"),
        _sales(star),
        _deals(star),
        region=region,
    )
    return frame.select(
        "territory_id",
        "territory_name",
        "region",
        "state",
        _or_zero("total_operators").alias("total_operators"),
        _or_zero("total_reps").alias("total_reps"),
        _or_zero("total_distributors").alias("total_distributors"),
        F.col("net_sales").alias("total_net_sales"),
        _or_zero("opportunities").alias("total_opportunities"),
    )


def heatmap_rows(star: Star, year: int | None = None, region: str | None = None) -> DataFrame:
    frame = _territory_frame(
        star,
        _members(star.operators, "operators"),
        _members(star.sales_reps, "reps"),
        _sales(star, year),
        _deals(star, year),
        region=region,
    )
    return frame.select(
        "territory_id",
        "territory_name",
        "region",
        "state",
        _or_zero("operators").alias("operators"),
        _or_zero("reps").alias("reps"),
        "net_sales",
        _or_zero("opportunities").alias("opportunities"),
        _or_zero("revenue_won").alias("revenue_won"),
    )


def kpi_territory_heatmap(
    star: Star, year: int | None = None, region: str | None = None
) -> DataFrame:
    return heatmap_rows(star, year, region).orderBy(F.desc("net_sales"), "territory_id")
