"""Facts summed to a grain before they meet any other table.

Every report that combines facts joins these frames and never the raw rows:
a join can then match each key once and no amount is counted twice. It also
keeps skew harmless. A key that owns a third of all shipments shrinks to one
row per map task in the partial aggregation, and that is all the shuffle sees.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeledger.functions import dates, kpis
from tradeledger.star import Star

SUMS = ("quantity", "gross_sales", "discounts", "returns", "net_sales", "cost_of_goods")

# Name of a distinct count -> the column it counts.
DISTINCTS = {
    "active_operators": "operator_id",
    "products_sold": "product_id",
    "active_distributors": "distributor_id",
}

# The stored roll-ups: every shipment report can be answered from these two.
ROLLUPS = {
    "by_operator": ("month_start", "distributor_id", "operator_id"),
    "by_product": ("month_start", "distributor_id", "product_id"),
}

# First and last week ending; where these are subqueries, also the first day of the first week.
Period = tuple[date | Column, ...]

_DERIVED = {
    "year": lambda day: F.year(day),
    "month": lambda day: F.month(day),
    "month_start": lambda day: dates.month_start(day),
}


def shipments_by(
    star: Star,
    *keys: str,
    distinct: tuple[str, ...] = (),
    period: Period | None = None,
    ranged: bool = False,
) -> DataFrame:
    """Shipment sums, ``shipment_count`` and distinct counts at a grain.

    ``keys`` are shipment columns or ``year``, ``month``, ``month_start`` of
    the week ending; without keys the result is one row. ``period`` limits the
    week ending to a closed interval. ``ranged`` deals the rows by ranges of the keys before
    they are summed, for grains that hardly sum anything.

    Each distinct count comes from its own narrow scan of grain and counted
    id, deduplicated and counted; the small results are stacked under the sums
    and folded into one row per grain. Several ``count(distinct)`` in one
    aggregation would instead copy every shipment once per count and carry all
    sums through the shuffle that finds the distinct ids.
    """
    # distributors are few: sums by distributor give their number without another scan
    with_distributors = "active_distributors" in distinct and "distributor_id" not in keys
    grain = (*keys, "distributor_id") if with_distributors else keys
    rows, day = _source(star, {*grain}, period)
    counted = F.col("shipment_count") if "shipment_count" in rows.columns else F.lit(1)
    rows = rows.select(*_key_columns(grain, day), *SUMS, counted.alias("shipment_count"))
    if with_distributors:
        distinct = tuple(d for d in distinct if d != "active_distributors")
        rows = rows.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in (*SUMS, "shipment_count")])
    if ranged:
        rows = rows.repartitionByRange(*keys)
    sums = rows.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.coalesce(F.sum("shipment_count"), F.lit(0)).alias("shipment_count"),
        *([F.count("distributor_id").alias("active_distributors")] if with_distributors else []),
    )
    return _folded(keys, sums, *[_distinct_ids(star, keys, d, period) for d in distinct])


def _distinct_ids(star: Star, keys: tuple[str, ...], name: str, period: Period | None) -> DataFrame:
    """How many ids there are per grain, in the column ``name``."""
    counted = DISTINCTS[name]
    rows, day = _source(star, {*keys, counted}, period)
    pairs = rows.select(*_key_columns(keys, day), F.col(counted).alias("__id"))
    present = pairs.filter(F.col("__id").isNotNull()).distinct()
    return present.groupBy(*keys).agg(F.count("__id").alias(name))


def _folded(keys: tuple[str, ...], *frames: DataFrame) -> DataFrame:
    """Frames with different measures at one grain, side by side.

    Each frame has at most one row per grain, so the rows are stacked with
    NULL in the measures they lack, and a maximum picks the one value. Unlike
    a join this matches a NULL key with itself. A count without a row is 0.
    """
    if len(frames) == 1:
        return frames[0]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    measures = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(
        *[
            F.coalesce(F.max(c), F.lit(0)).alias(c) if c in DISTINCTS else F.max(c).alias(c)
            for c in measures
        ]
    )


def _key_columns(keys: tuple[str, ...], day: str) -> list[Column | str]:
    return [_DERIVED[k](F.col(day)).alias(k) if k in _DERIVED else k for k in keys]


def _source(star: Star, columns: set[str], period: Period | None) -> tuple[DataFrame, str]:
    """The smallest frame with the asked columns, and its day column.

    A stored roll-up where there is one with these columns, unless a period
    cuts through one of its months; else the shipment rows.
    """
    if period is None or _is_whole_months(period):
        for name, grain in ROLLUPS.items():
            rollup = star.rollup(name)
            if rollup is not None and columns <= {*grain, *_DERIVED}:
                if period is not None:
                    rollup = rollup.filter(F.col("month_start").between(*map(F.lit, period[:2])))
                return rollup, "month_start"
    with_operator = "operator_id" in columns
    if period is not None:
        return star.shipments_between(*period, operators=with_operator), "week_ending"
    return (star.shipments if with_operator else star.lean_shipments), "week_ending"


def _is_whole_months(period: Period) -> bool:
    first, last = period[:2]
    if not (isinstance(first, date) and isinstance(last, date)):
        return False
    return first.day == 1 and (last + timedelta(days=1)).day == 1


def rollup_shipments(star: Star, name: str, ranged: bool = False) -> DataFrame:
    """One of the two roll-ups, computed from the shipment rows; ``ranged`` leaves it in ranges of its grain."""
    return shipments_by(star.without_rollups(), *ROLLUPS[name], ranged=ranged)


def opps_by(
    star: Star, *keys: str | Column, where: Column | None = None, year: int | None = None
) -> DataFrame:
    """Deal counts and amounts at a grain, from the opportunity rows.

    ``opportunity_id`` is the key of its table, so rows are deals. ``year`` limits
    them to those whose close date, reached or expected, lies in it.
    """
    rows = star.sf_opportunities if year is None else star.deals_between(*dates.year_bounds(year))
    if where is not None:
        rows = rows.filter(where)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("opportunities"),
        kpis.won_deals().alias("won"),
        kpis.lost_deals().alias("lost"),
        F.count_if(kpis.is_open()).alias("open"),
        kpis.revenue_won().alias("revenue"),
        F.count(F.when(kpis.is_won(), F.col("amount"))).alias("priced_wins"),
        F.sum("amount").alias("amount"),
        F.count("amount").alias("priced"),
        kpis.pipeline_value().alias("pipeline_value"),
        kpis.weighted_pipeline().alias("weighted_value"),
        F.sum("probability").alias("probability_sum"),
        F.count("probability").alias("probability_count"),
    )


def activities_by(star: Star, *keys: str | Column, year: int | None = None) -> DataFrame:
    """Activity counts at a grain, in all and for the types reports show."""

    def of_type(name: str) -> Column:
        return F.count_if(F.col("activity_type") == name)

    rows = star.sf_activities
    if year is not None:
        rows = rows.filter(F.col("activity_date").between(*map(F.lit, dates.year_bounds(year))))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("activities"),
        of_type("Call").alias("calls"),
        of_type("Meeting").alias("meetings"),
        of_type("Site Visit").alias("site_visits"),
    )


def merge_single_rows(*frames: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row frames, without a join."""
    return _folded((), *frames)
