"""The nine-table star every report reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeledger.sources.schemas import TABLES

Loader = Callable[[], DataFrame]


class Star:
    """Nine DataFrames, each opened the first time a report asks for it.

    ``lean_shipments`` is an optional second view of the shipments without
    ``operator_id``. A source that has to join to find the operator supplies
    it, so a report which never looks at operators also never pays the join.

    ``shipments_near`` is an optional way to open only the files that can hold
    a range of weeks; it may return more rows than asked for. It gets the first
    and last week, the first day that ships in the first week, and whether
    operators are wanted. ``deals_near`` does the same for a range of close dates.

    ``rollups`` holds the two stored monthly roll-ups (see
    ``operators.preagg``) when the star was opened over a warehouse that has
    them; reports then read those instead of the shipment rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        loaders: Mapping[str, Loader],
        lean_shipments: Loader | None = None,
        rollups: Mapping[str, Loader] | None = None,
        shipments_near: Callable[[Column, Column, Column, bool], DataFrame] | None = None,
        deals_near: Callable[[date, date], DataFrame] | None = None,
    ):
        unknown = set(loaders) - set(TABLES)
        if unknown:
            raise ValueError(f"not star tables: {sorted(unknown)}")
        self.spark = spark
        self._loaders = dict(loaders)
        self._lean_loader = lean_shipments
        self._rollup_loaders = dict(rollups or {})
        self._shipments_near = shipments_near
        self._deals_near = deals_near
        self._opened: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, **frames: DataFrame) -> Star:
        """A star over given frames; tables not given are empty."""
        loaders: dict[str, Loader] = {}
        for name, schema in TABLES.items():
            if name in frames:
                loaders[name] = lambda df=frames[name]: df
            else:
                loaders[name] = lambda s=schema: spark.createDataFrame([], s)
        return cls(spark, loaders)

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            if name not in self._loaders:
                raise KeyError(f"star has no table {name!r}")
            self._opened[name] = self._loaders[name]()
        return self._opened[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    @property
    def lean_shipments(self) -> DataFrame:
        """Shipments for reports that do not read ``operator_id``."""
        if self._lean_loader is None:
            return self.table("shipments")
        if "lean_shipments" not in self._opened:
            self._opened["lean_shipments"] = self._lean_loader()
        return self._opened["lean_shipments"]

    def rollup(self, name: str) -> DataFrame | None:
        if name not in self._rollup_loaders:
            return None
        key = f"rollup:{name}"
        if key not in self._opened:
            self._opened[key] = self._rollup_loaders[name]()
        return self._opened[key]

    def with_rollups(self, rollups: Mapping[str, Loader]) -> Star:
        """The same star, reading stored roll-ups where a report allows it."""
        return Star(
            self.spark, self._loaders, self._lean_loader, rollups, self._shipments_near, self._deals_near
        )

    def without_rollups(self) -> Star:
        return self.with_rollups({}) if self._rollup_loaders else self

    def shipments_between(
        self,
        first: date | Column,
        last: date | Column,
        first_day: Column | None = None,
        operators: bool = True,
    ) -> DataFrame:
        """Shipments whose ``week_ending`` lies in ``[first, last]``.

        The bounds are compared with the bare date column, so that Parquet row
        groups are skipped by their statistics; a source whose files are laid
        out by date first narrows the files. ``first_day``, six days before
        ``first``, is needed only where ``first`` is a subquery: a bound reaches
        a scan if the subquery is all of it.
        """
        if first_day is None:
            first_day = F.lit(first - timedelta(days=6)) if isinstance(first, date) else F.date_sub(first, 6)
        first, last = _as_column(first), _as_column(last)
        if self._shipments_near is not None:
            rows = self._shipments_near(first, last, first_day, operators)
        else:
            rows = self.table("shipments") if operators else self.lean_shipments
        return rows.filter(F.col("week_ending").between(first, last))

    def deals_between(self, first: date, last: date) -> DataFrame:
        """Opportunities whose ``close_date`` lies in ``[first, last]``."""
        rows = self.table("sf_opportunities") if self._deals_near is None else self._deals_near(first, last)
        return rows.filter(F.col("close_date").between(F.lit(first), F.lit(last)))


def _as_column(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
