"""Reports over shipments: distributors, products, months and years."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeledger.functions import dates, kpis
from tradeledger.operators.growth import prior_year, prior_year_totals
from tradeledger.operators.preagg import shipments_by
from tradeledger.star import Star

DEFAULT_YEAR = 2024


def _whole_year(year: int | None) -> tuple[date, date] | None:
    return None if year is None else dates.year_bounds(year)


def _distributors(star: Star, distributor_type: str | None = None) -> DataFrame:
    rows = star.distributors
    if distributor_type is not None:
        rows = rows.filter(F.col("distributor_type") == distributor_type)
    return rows


# ---- year over year -------------------------------------------------------

def _growth_by_distributor(
    star: Star,
    year: int | None = None,
    distributor_type: str | None = None,
    region: str | None = None,
) -> DataFrame:
    """Distributor and year with net sales and the year before.

    Grouping is by id, so two distributors with one name stay apart. For a
    single year only that year and the one before it are read.
    """
    period = None if year is None else dates.year_bounds(year - 1, year)
    yearly = shipments_by(star, "distributor_id", "year", period=period)
    yearly = yearly.withColumn("prior", prior_year("net_sales", "distributor_id"))
    if year is not None:
        yearly = yearly.filter(F.col("year") == year)
    named = yearly.join(_distributors(star, distributor_type), "distributor_id")
    if region is not None:
        in_region = star.territories.filter(F.col("region") == region)
        named = named.join(in_region, "territory_id", "left_semi")
    return named


def q01_distributor_yoy(
    star: Star,
    year: int = DEFAULT_YEAR,
    distributor_type: str | None = None,
    region: str | None = None,
) -> DataFrame:
    rows = _growth_by_distributor(star, year, distributor_type, region)
    return (
        rows.select(
            "distributor_name",
            "distributor_type",
            "year",
            F.col("net_sales").alias("current_year_sales"),
            F.col("prior").alias("prior_year_sales"),
            kpis.growth_pct("net_sales", "prior").alias("yoy_growth"),
        )
        .orderBy(F.desc("current_year_sales"), "distributor_name")
    )


def an_yoy_growth(star: Star) -> DataFrame:
    yearly = shipments_by(star, "distributor_id", "year", distinct=("active_operators",))
    return yearly.select(
        "year",
        "distributor_id",
        F.col("net_sales").alias("total_net_sales"),
        F.col("quantity").alias("total_quantity"),
        "active_operators",
        prior_year("net_sales", "distributor_id").alias("prior_year_sales"),
    ).withColumn(
        "yoy_growth_pct", kpis.growth_pct("total_net_sales", "prior_year_sales", digits=2)
    )


def growth_rows(star: Star, year: int | None = None, **slices: str | None) -> DataFrame:
    return _growth_by_distributor(star, year, **slices).select(
        "year",
        "distributor_name",
        "distributor_type",
        "net_sales",
        F.col("prior").alias("prior_year"),
        kpis.growth_pct("net_sales", "prior").alias("yoy_growth"),
    )


def kpi_yoy_growth(
    star: Star,
    year: int | None = None,
    distributor_type: str | None = None,
    region: str | None = None,
) -> DataFrame:
    rows = growth_rows(star, year, distributor_type=distributor_type, region=region)
    return rows.orderBy(F.desc("year"), F.desc("net_sales"), "distributor_name")


def _yearly_totals(star: Star) -> DataFrame:
    return prior_year_totals(shipments_by(star, "year").select("year", "net_sales"), "net_sales")


def readme_yoy_total(star: Star) -> DataFrame:
    return (
        _yearly_totals(star)
        .select("year", kpis.growth_pct("net_sales", "prior", digits=2).alias("yoy_growth_pct"))
        .orderBy("year")
    )


def yoy_total_latest(star: Star) -> DataFrame:
    """Company growth in the last year whose December has shipments.

    A year without a December is still running, and comparing it with a full
    year would understate the growth.
    """
    monthly = shipments_by(star, "year", "month").select("year", "month", "net_sales")
    yearly = monthly.groupBy("year").agg(
        F.sum("net_sales").alias("net_sales"), F.max("month").alias("last_month")
    )
    return (
        prior_year_totals(yearly, "net_sales", "last_month")
        .filter(F.col("last_month") == 12)
        .select(
            "year",
            "net_sales",
            F.col("prior").alias("prior_year"),
            kpis.growth_pct("net_sales", "prior").alias("yoy_growth"),
        )
        .orderBy(F.desc("year"))
        .limit(1)
    )


# ---- distributors ---------------------------------------------------------

def last_week(star: Star) -> date | None:
    """The last week ending, read once; with roll-ups only the last month's shipments are looked at."""
    rows, monthly = star.lean_shipments, star.rollup("by_operator")
    if monthly is not None:
        month = monthly.agg(F.max("month_start")).first()[0]
        if month is None:
            return None
        rows = star.shipments_between(month, (month + timedelta(days=31)).replace(day=1) - timedelta(days=1), operators=False)
    return rows.agg(F.max("week_ending")).first()[0]


def q04_active_operators(
    star: Star,
    as_of: date | None = None,
    distributor_type: str | None = None,
) -> DataFrame:
    """Distributors over the twelve months up to ``as_of`` (default: the last week)."""
    end = F.lit(as_of or last_week(star)).cast("date")
    first, last = dates.trailing_year_start(end), end
    first_day = F.date_sub(first, 6).cast("timestamp_ntz")
    per_distributor = shipments_by(
        star,
        "distributor_id",
        distinct=("active_operators", "products_sold"),
        period=(first, last, first_day),
    )
    return (
        per_distributor.join(_distributors(star, distributor_type), "distributor_id")
        .select(
            "distributor_name",
            "distributor_type",
            "active_operators",
            F.col("products_sold").alias("unique_products"),
            F.col("quantity").alias("total_units"),
            "net_sales",
            kpis.average("net_sales", "active_operators").alias("revenue_per_operator"),
        )
        .orderBy(F.desc("net_sales"), "distributor_name")
    )


def vw_distributor_scorecard(
    star: Star,
    year: int | None = None,
    distributor_type: str | None = None,
    region: str | None = None,
) -> DataFrame:
    """Distributor by year and month; one without shipments keeps a NULL period.

    A filter on the year drops that row like any other of another year.
    """
    sold = shipments_by(
        star,
        "distributor_id",
        "year",
        "month",
        distinct=("active_operators", "products_sold"),
        period=_whole_year(year),
    )
    how = "left" if year is None else "inner"
    return _distributor_frame(star, sold, distributor_type, region, how).select(
        "distributor_id",
        "distributor_name",
        "distributor_type",
        "region",
        "year",
        "month",
        *_counts("active_operators", "products_sold"),
        F.col("quantity").alias("total_units"),
        "gross_sales",
        "net_sales",
        F.col("returns").alias("total_returns"),
        kpis.gross_margin().alias("gross_margin"),
    )


def scorecard_rows(
    star: Star,
    year: int | None = None,
    distributor_type: str | None = None,
    region: str | None = None,
) -> DataFrame:
    sold = shipments_by(
        star,
        "distributor_id",
        distinct=("active_operators", "products_sold"),
        period=_whole_year(year),
    )
    return _distributor_frame(star, sold, distributor_type, region).select(
        "distributor_id",
        "distributor_name",
        "distributor_type",
        "region",
        *_counts("active_operators", "products_sold"),
        F.col("quantity").alias("total_units"),
        "net_sales",
        "gross_sales",
        kpis.return_rate().alias("return_rate"),
        kpis.gross_margin().alias("gross_margin"),
    )


def kpi_distributor_scorecards(
    star: Star,
    year: int | None = None,
    distributor_type: str | None = None,
    region: str | None = None,
) -> DataFrame:
    rows = scorecard_rows(star, year, distributor_type, region)
    return rows.orderBy(F.desc("net_sales"), "distributor_id")


def distributor_money(
    star: Star,
    year: int | None = None,
    distributor_type: str | None = None,
    region: str | None = None,
) -> DataFrame:
    """Scorecard money without the distinct counts, for charts that show no counts."""
    sold = shipments_by(star, "distributor_id", period=_whole_year(year))
    return _distributor_frame(star, sold, distributor_type, region)


def _distributor_frame(
    star: Star,
    sold: DataFrame,
    distributor_type: str | None = None,
    region: str | None = None,
    how: str = "left",
) -> DataFrame:
    places = star.territories.select("territory_id", "region")
    if region is not None:
        places = places.filter(F.col("region") == region)
    dims = _distributors(star, distributor_type).join(
        places, "territory_id", "left" if region is None else "inner"
    )
    return dims.join(sold, "distributor_id", how)


def _counts(*names: str) -> list:
    return [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names]


# ---- months ---------------------------------------------------------------

def _monthly(star: Star, *distinct: str, year: int | None = None) -> DataFrame:
    monthly = shipments_by(star, "month_start", distinct=distinct, period=_whole_year(year))
    return monthly.withColumn("month", dates.month_label("month_start"))


def q07_monthly_sales_trend(star: Star, n: int = 24) -> DataFrame:
    return (
        _monthly(star, "active_operators")
        .select(
            "month",
            "net_sales",
            F.col("quantity").alias("units"),
            "active_operators",
            kpis.gross_margin().alias("gross_margin"),
            kpis.margin_pct().alias("margin_pct"),
        )
        .orderBy(F.desc("month"))
        .limit(n)
    )


def kpi_monthly_trends(star: Star, year: int | None = None) -> DataFrame:
    return (
        _monthly(star, "active_operators", year=year)
        .select(
            "month",
            "net_sales",
            F.col("quantity").alias("units"),
            "active_operators",
            kpis.gross_margin().alias("gross_margin"),
        )
        .orderBy("month")
    )


def an_monthly_trend(star: Star) -> DataFrame:
    counts = ("active_operators", "active_distributors", "products_sold")
    return (
        _monthly(star, *counts)
        .select("month", "net_sales", "gross_sales", "returns", "quantity", *counts)
        .orderBy("month")
    )


def shipment_monthly_summary(star: Star) -> DataFrame:
    counts = ("active_operators", "active_distributors")
    return (
        shipments_by(star, "year", "month", distinct=counts)
        .select(
            "year",
            "month",
            "shipment_count",
            F.col("quantity").alias("total_quantity"),
            "gross_sales",
            "net_sales",
            "returns",
            *counts,
        )
        .orderBy("year", "month")
    )


def q11_seasonality(star: Star) -> DataFrame:
    """Mean monthly net per calendar month against the mean of all months."""
    monthly = shipments_by(star, "year", "month").select("month", "net_sales")
    overall = monthly.agg(kpis.ratio(F.sum("net_sales"), F.count("net_sales"))).scalar()
    by_month = monthly.groupBy("month").agg(
        F.sum("net_sales").alias("total"), F.count("net_sales").alias("months")
    )
    mean = kpis.average("total", "months", digits=None)
    return by_month.select(
        F.col("month").alias("month_num"),
        dates.month_name("month").alias("month_name"),
        kpis.half_up(mean, 2).alias("avg_monthly_sales"),
        kpis.half_up(F.try_divide(100.0 * mean, overall), 1).alias("seasonality_index"),
    ).orderBy("month_num")


# ---- products and totals --------------------------------------------------

def q09_top_products(star: Star, n: int = 25) -> DataFrame:
    """Products by net sales; ids without a product are left out before the cut."""
    top = (
        shipments_by(star, "product_id")
        .join(star.products, "product_id")
        .orderBy(F.desc("net_sales"), "product_id")
        .limit(n)
    )
    return top.select(
        "product_name",
        "brand",
        "category",
        "subcategory",
        F.col("quantity").alias("units_sold"),
        "net_sales",
        kpis.gross_margin().alias("gross_margin"),
        kpis.margin_pct().alias("margin_pct"),
    )


def readme_net_sales_margin(star: Star) -> DataFrame:
    return shipments_by(star).select(
        F.col("net_sales").alias("total_net_sales"),
        (F.col("gross_sales") - F.col("cost_of_goods")).alias("gross_margin"),
        kpis.margin_pct_of_gross().alias("margin_pct"),
    )


def shipment_totals(star: Star, year: int | None = None) -> DataFrame:
    """The eight shipment metrics of the executive summary, as one row."""
    counts = ("active_operators", "active_distributors")
    return shipments_by(star, distinct=counts, period=_whole_year(year)).select(
        F.col("net_sales").alias("total_net_sales"),
        F.col("gross_sales").alias("total_gross_sales"),
        kpis.gross_margin().alias("gross_margin"),
        kpis.margin_pct().alias("margin_pct"),
        F.col("quantity").alias("total_units"),
        F.col("active_operators").alias("total_operators"),
        F.col("active_distributors").alias("total_distributors"),
        F.col("shipment_count").alias("total_shipments"),
    )
