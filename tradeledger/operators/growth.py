"""Prior-period comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prior_year(value: str, key: str, year: str = "year") -> Column:
    """``value`` of the same key exactly one year earlier, NULL over a gap.

    A range frame looks at the year number, not at the previous row, so a key
    with a missing year gets NULL and not the value of two years before. Use
    it on a frame with one row per key and year: a partition then holds no
    more rows than there are years.
    """
    frame = Window.partitionBy(key).orderBy(F.col(year)).rangeBetween(-1, -1)
    return F.first(value).over(frame)


def prior_year_totals(
    yearly: DataFrame, value: str, *others: str, year: str = "year"
) -> DataFrame:
    """Years that have a predecessor, with its value as ``prior``.

    Each yearly row is also written as next year's prior value, and one
    aggregation brings the two together: the facts behind ``yearly`` are read
    once, which a self join does not ensure.
    """
    own = F.struct(
        F.col(year), F.col(value), *others, F.lit(None).alias("prior")
    )
    following = F.struct(
        (F.col(year) + 1).alias(year),
        F.lit(None).alias(value),
        *[F.lit(None).alias(c) for c in others],
        F.col(value).alias("prior"),
    )
    both = yearly.filter(F.col(year).isNotNull()).select(F.inline(F.array(own, following)))
    return (
        both.groupBy(year)
        .agg(*[F.max(c).alias(c) for c in (value, *others, "prior")])
        .filter(F.col(value).isNotNull() & F.col("prior").isNotNull())
    )
