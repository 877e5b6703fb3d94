"""Calendar keys. Grouping uses dates and ints; text is made afterwards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_ending(day: str | Column) -> Column:
    """The Saturday on or after the given day."""
    day = F.col(day) if isinstance(day, str) else day
    return F.date_add(day, F.lit(7) - F.dayofweek(day))


def month_start(day: str | Column) -> Column:
    return F.trunc(day, "MM")


def month_label(first_day: str | Column) -> Column:
    return F.date_format(first_day, "yyyy-MM")


def month_name(month_number: str | Column) -> Column:
    number = F.col(month_number) if isinstance(month_number, str) else month_number
    return F.date_format(F.make_date(F.lit(2000), number, F.lit(1)), "MMMM")


def year_bounds(first_year: int, last_year: int | None = None) -> tuple[date, date]:
    return date(first_year, 1, 1), date(last_year or first_year, 12, 31)


def trailing_year_start(as_of: Column) -> Column:
    return F.add_months(as_of, -12)
