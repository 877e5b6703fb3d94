"""KPI definitions as Column builders; none of them takes a DataFrame.

Money stays decimal until a ratio is taken, so sums are exact and do not
depend on the order in which executors add them up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradeledger.sources.schemas import LOST, WON

CLOSED = (WON, LOST)


def ratio(num: Column, den: Column, digits: int | None = None, scale: float = 1.0) -> Column:
    """``scale * num / den``; NULL when the denominator is zero or NULL.

    With ``digits`` the quotient is a decimal of 13 places, rounded once, halves
    away from zero; amounts and counts have at most four places.
    """
    if digits is None:
        return F.try_divide(F.lit(float(scale)) * num.cast("double"), den.cast("double"))
    scaled = num.cast("decimal(22,4)") * F.lit(int(scale))
    return F.round(F.try_divide(scaled, den.cast("decimal(22,4)")), digits).cast("double")


def half_up(value: Column, digits: int) -> Column:
    """Rounded once from the shortest decimal form, halves away from zero."""
    return F.round(value, digits).cast("double")


def percent(num: Column, den: Column, digits: int = 1) -> Column:
    return ratio(num, den, digits, 100.0)


# ---- row-level predicates and amounts -------------------------------------

def is_won(stage: str | Column = "stage") -> Column:
    return _col(stage) == WON


def is_lost(stage: str | Column = "stage") -> Column:
    return _col(stage) == LOST


def is_closed(stage: str | Column = "stage") -> Column:
    return _col(stage).isin(*CLOSED)


def is_open(stage: str | Column = "stage") -> Column:
    """Not in a closed stage; a NULL stage is neither open nor closed."""
    return ~_col(stage).isin(*CLOSED)


def net_sales() -> Column:
    return F.col("gross_sales") - F.col("discounts") - F.col("returns")


# ---- aggregates over opportunity rows -------------------------------------

def won_deals() -> Column:
    return F.count_if(is_won())


def lost_deals() -> Column:
    return F.count_if(is_lost())


def revenue_won() -> Column:
    return F.coalesce(F.sum(F.when(is_won(), F.col("amount"))), F.lit(0).cast("decimal(18,2)"))


def pipeline_value() -> Column:
    return F.coalesce(F.sum(F.when(is_open(), F.col("amount"))), F.lit(0).cast("decimal(18,2)"))


def weighted_amount() -> Column:
    """Expected value of one deal: amount times probability percent, exact."""
    return F.col("amount") * F.col("probability") * F.lit("0.01").cast("decimal(3,2)")


def weighted_pipeline() -> Column:
    return F.sum(F.when(is_open(), weighted_amount()))


# ---- ratios over aggregated columns ---------------------------------------

def win_rate(won: str | Column = "won", lost: str | Column = "lost", digits: int = 1) -> Column:
    """Share of closed deals that were won, in percent."""
    return percent(_col(won), _col(won) + _col(lost), digits)


def win_rate_all(won: str | Column, total: str | Column, digits: int = 1) -> Column:
    """Share of all deals, open ones included, that were won, in percent."""
    return percent(_col(won), _col(total), digits)


def gross_margin(net: str | Column = "net_sales", cogs: str | Column = "cost_of_goods") -> Column:
    return _col(net) - _col(cogs)


def margin_pct(net: str | Column = "net_sales", cogs: str | Column = "cost_of_goods",
               digits: int = 1) -> Column:
    return percent(gross_margin(net, cogs), _col(net), digits)


def margin_pct_of_gross(gross: str | Column = "gross_sales", cogs: str | Column = "cost_of_goods",
                        digits: int = 2) -> Column:
    return percent(_col(gross) - _col(cogs), _col(gross), digits)


def growth_pct(current: str | Column, prior: str | Column, digits: int = 1) -> Column:
    return percent(_col(current) - _col(prior), _col(prior), digits)


def return_rate(returns: str | Column = "returns", gross: str | Column = "gross_sales") -> Column:
    return percent(_col(returns), _col(gross), 2)


def quota_attainment(revenue: str | Column, quota: str | Column) -> Column:
    return percent(_col(revenue), _col(quota), 1)


def average(total: str | Column, count: str | Column, digits: int | None = 2) -> Column:
    return ratio(_col(total), _col(count), digits)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
