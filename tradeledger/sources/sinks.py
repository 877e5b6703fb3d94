"""Writing the star and its products. A write replaces what was there only when it is complete."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradeledger.operators import quality
from tradeledger.operators.preagg import ROLLUPS, merge_single_rows, rollup_shipments
from tradeledger.operators.states import STATES
from tradeledger.sources import files, snapshots
from tradeledger.sources.schemas import FACT, TABLES
from tradeledger.sources.tables import REJECTED
from tradeledger.star import Star

CHECKS = "checks"
DAYS = (quality.FIRST_DAY, quality.LAST_DAY)
_SINGLE = "rows"
# Tables whose jobs are handed to Spark at the same time.
AT_ONCE = 4


def at_once(work: Callable, names: Iterable[str]) -> list:
    """``work(name)`` for each, several at a time and the last names first, for the facts are last.

    A table's last tasks leave cores idle that another table's can use. An error is raised when
    all have ended; results are in the order of the names.
    """
    names = list(names)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        begun = [pool.submit(work, name) for name in reversed(names)]
    return [one.result() for one in begun][::-1]


def _layout(name: str, df: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """A star table's rows as they are stored, and the partition columns.

    ``rebalance`` lets adaptive execution even out the output files: small
    ones are merged and a year, or any other part, that is too big is split.
    Rows are ordered by week within a file, so a date filter skips row groups.
    Lines that didn't parse lie apart, by the partition column ``rejected``, with
    no value but their text and file.
    """
    lines = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in REJECTED]
    data = [c for c in df.columns if c not in REJECTED]
    rows = df.select(*data, *lines).withColumn("rejected", F.col(REJECTED[0]).isNotNull())
    rows = rows.select(*[F.when(~F.col("rejected"), F.col(c)).alias(c) for c in data], *REJECTED, "rejected")
    if name != FACT:
        return rows, ("rejected",)
    dated = rows.withColumn("year", F.year("week_ending"))
    dated = dated.hint("rebalance", "rejected", "year").sortWithinPartitions("rejected", "year", "week_ending")
    return dated, ("rejected", "year")


def _observed(name: str, df: DataFrame, days: tuple[date, date]) -> tuple[DataFrame, Observation, list[quality.Check]]:
    """The rows with their declared checks evaluated on the way to the files.

    The checks come last before the files, in tasks that count once however often they are tried.
    """
    checks = [c for c in quality.declared_checks(*days) if c.table == name]
    observation = Observation(f"{name}-{uuid.uuid4().hex}")
    found = [c.value().cast("double").alias(f"v{i}") for i, c in enumerate(checks)]
    return df.observe(observation, F.count_if("rejected").alias("bad"), *found), observation, checks


def _check_rows(observation: Observation, checks: list[quality.Check]) -> list[tuple]:
    found = observation.get

    def bound(value: float | None) -> float | None:
        return None if value is None else float(value)

    return [
        (c.name, c.table, c.column, found[f"v{i}"] - found["bad"] if c.counts_rows else found[f"v{i}"], bound(c.lower),
         bound(c.upper))
        for i, c in enumerate(checks)
    ]


def _put_table(name: str, df: DataFrame, how: Callable, days: tuple[date, date] = DAYS) -> list[tuple]:
    rows, by = _layout(name, df)
    rows, observation, checks = _observed(name, rows, days)
    how(name, rows, by)
    return _check_rows(observation, checks)


def _put_checks(writer: snapshots.Writer, rows: list[tuple]) -> None:
    frame = writer.spark.createDataFrame(
        rows, "check string, table_name string, column_name string, observed double, lower double, upper double"
    )
    writer.add(CHECKS, frame.withColumn("of_load", F.lit(writer.load)).coalesce(1))


def write_star(star: Star, path: str, rollups: bool = False, days: tuple[date, date] = DAYS) -> None:
    """The nine tables as Parquet, shipments in one folder per year, as the next version.

    The declared checks are evaluated while the rows are written, without another scan, and
    stored with the version; ``days`` are the first and last that dates may have. ``rollups`` writes the roll-ups of the new shipments with it.
    """
    with snapshots.Writer(star.spark, path) as writer:
        writer.tables.pop(CHECKS, None)
        found = at_once(lambda name: _put_table(name, star.table(name), writer.put, days), TABLES)
        _put_checks(writer, [row for rows in found for row in rows])
        if rollups:
            stored = Star(star.spark, {FACT: lambda: _good(writer.written(FACT)).drop("year")})
            for name in ROLLUPS:
                _put_rollup(writer, name, stored)


def _good(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("rejected")).drop("rejected", *REJECTED)


def _rollup_layout(star: Star, name: str) -> DataFrame:
    """A roll-up by month, shuffled once: ranges of the grain hold whole groups and few months.

    Groups are summed after the shuffle, for most have a row or two, whose sums take more room than
    the rows. Ranges are even in rows whatever the months, so files are as well.
    """
    months = rollup_shipments(star, name, ranged=True).withColumn("month", F.date_format("month_start", "yyyy-MM"))
    return months.sortWithinPartitions("month", "month_start")


def _put_rollup(writer: snapshots.Writer, name: str, star: Star) -> None:
    writer.put(f"rollup_{name}", _rollup_layout(star, name), ("month",))


def write_rollups(star: Star, path: str) -> None:
    """The two monthly shipment roll-ups all shipment reports can read from, by month."""
    with snapshots.Writer(star.spark, path) as writer:
        for name in ROLLUPS:
            _put_rollup(writer, name, star)


def write_states(star: Star, path: str) -> None:
    """The cube, quantile and operator states (``operators.states``), so that pages read no shipment."""
    with snapshots.Writer(star.spark, path) as writer:
        for name, build in STATES.items():
            writer.put(f"state_{name}", build(star).hint("rebalance"))


def read_states(spark: SparkSession, path: str, name: str) -> DataFrame:
    return snapshots.current(spark, path).read(spark, f"state_{name}")


def append_shipments(
    spark: SparkSession, shipments: DataFrame, path: str, tag: str, replace_years: bool = False
) -> snapshots.Snapshot:
    """A chunk of shipments into a stored warehouse, and the roll-ups kept up with it.

    The chunk's rows are added, or with ``replace_years`` take the place of all shipments of the
    years that they are of. No file of another year is touched. The chunk's own sums are put beside
    those of the roll-ups, so an append costs what its chunk does; the reports add up all rows of a
    group anyway. Where years are replaced, the chunk's sums alone are left of their months.
    ``write_rollups`` over the opened star folds groups that came in many chunks into one row again.
    States (``write_states``) are not of the new version: write them again after the last chunk.
    ``tag`` names the chunk; one that is there already changes nothing. Lines that didn't
    parse (see ``read_table``) are stored apart.
    """
    writer = snapshots.Writer(spark, path, tag)
    if writer.base.has_tag(FACT, tag):
        return writer.base
    for name in STATES:
        writer.tables.pop(f"state_{name}", None)
    years: list = []
    if replace_years:
        # one row a year
        years = [r[0] for r in shipments.select(F.year("week_ending")).distinct().collect()]
        def how(name: str, rows: DataFrame, by: tuple[str, ...]) -> None:
            writer.swap(name, rows, by, "year", years)
    else:
        how = writer.add
    _put_checks(writer, _put_table(FACT, shipments, how))
    chunk = Star(spark, {FACT: lambda: _good(writer.written(FACT)).drop("year")})
    for name in ROLLUPS:
        table = f"rollup_{name}"
        if table not in writer.tables:
            continue
        new = _rollup_layout(chunk, name)
        if replace_years:
            of_years = F.coalesce(F.year("month_start").isin([y for y in years if y is not None]), F.lit(None in years))
            stored = writer.base.read(spark, table).filter(of_years)
            months = [r[0] for r in stored.select("month").distinct().collect()]  # a row a month
            writer.swap(table, new, ("month",), "month", months)
        else:
            writer.add(table, new, ("month",))
    return writer.commit()


def open_star(spark: SparkSession, path: str, rollups: bool = False, version: int | None = None) -> Star:
    """A star over one version of a stored warehouse, optionally reading its roll-ups.

    All tables are of the version that is the latest now, whatever is written afterwards.
    """
    snapshot = snapshots.current(spark, path, version)
    missing = [t for t in TABLES if t not in snapshot.tables]
    if missing:
        raise ValueError(f"no star below {path}: {missing} missing")
    loaders = {name: lambda n=name: _good(snapshot.read(spark, n)) for name in TABLES if name != FACT}
    by_year = lambda: _good(snapshot.read(spark, FACT))
    loaders[FACT] = lambda: by_year().drop("year")

    def near(first: Column, last: Column, first_day: Column, operators: bool) -> DataFrame:
        years = F.col("year").between(F.year(first), F.year(last))
        return by_year().filter(years).drop("year")

    star = Star(spark, loaders, shipments_near=near)
    return star.with_rollups(rollup_loaders(spark, path, version)) if rollups else star


def rollup_loaders(spark: SparkSession, path: str, version: int | None = None) -> dict:
    snapshot = snapshots.current(spark, path, version)
    return {name: lambda n=name: snapshot.read(spark, f"rollup_{n}").drop("month") for name in ROLLUPS}


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """(table_name, file, line) of every line that didn't parse when the warehouse was loaded."""
    snapshot = snapshots.current(spark, path)
    frames = [
        snapshot.read(spark, name).filter("rejected").select(
            F.lit(name).alias("table_name"), F.col(REJECTED[1]).alias("file"), F.col(REJECTED[0]).alias("line")
        )
        for name in TABLES
    ]
    return quality.union(frames)


def stored_checks(spark: SparkSession, path: str) -> DataFrame:
    """The declared checks as they were found while writing, of tables that are one load.

    A table that was added to since has figures for its loads only, which don't add up to figures of
    the whole; ``quality.quality_report`` scans such a table.
    """
    snapshot = snapshots.current(spark, path)
    loads = [(t, parts[0].load) for t, parts in snapshot.tables.items() if t in TABLES and len(parts) == 1]
    whole = spark.createDataFrame(loads, "table_name string, of_load string")
    return snapshot.read(spark, CHECKS).join(whole, ["table_name", "of_load"], "left_semi").drop("of_load")


def write_summary(df: DataFrame, path: str) -> None:
    """A summary table; a stale one never survives, and is there until the new one is complete."""
    with snapshots.Writer(df.sparkSession, path) as writer:
        writer.put(_SINGLE, df)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.current(spark, path).read(spark, _SINGLE)


def write_json(df: DataFrame, path: str) -> None:
    """Records as one JSON array in the file ``path``, in the frame's order, NULLs spelled out.

    Chunks of records are written in parallel and joined to one file, which takes the place of the
    former one in a single step.
    """
    spark = df.sparkSession
    work = f"{path}.work-{uuid.uuid4().hex}"
    try:
        record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
        df.select(F.concat(F.lit(","), record).alias("value")).write.text(f"{work}/parts")
        files.join_parts(spark, f"{work}/parts", f"{work}/joined", b"[", b"]\n", skip=1)
        files.replace_file(spark, f"{work}/joined", path)
    finally:
        files.delete(spark, work)


def write_json_lines(df: DataFrame, path: str) -> None:
    """Records as JSON lines in parallel files, NULLs spelled out, as the folder's next version."""
    with snapshots.Writer(df.sparkSession, path) as writer:
        writer.put(_SINGLE, df, format="json")


def write_kpi_card(path: str, *one_row: DataFrame) -> None:
    """Several one-row results as a single JSON object in the file ``path``."""
    card = merge_single_rows(*one_row)
    spark, work = card.sparkSession, f"{path}.work-{uuid.uuid4().hex}"
    try:
        card.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.text(f"{work}/parts")
        files.join_parts(spark, f"{work}/parts", f"{work}/joined", b"", b"")
        files.replace_file(spark, f"{work}/joined", path)
    finally:
        files.delete(spark, work)


def write_csv_by_year(shipments: DataFrame, path: str, combined: bool = True, by_year: bool = True) -> None:
    """Shipments as CSV, one folder per year of the week ending, and all together; or one of the two."""
    if by_year:
        dated = shipments.withColumn("year", F.year("week_ending"))
        (
            dated.hint("rebalance", F.col("year"))
            .write.mode("overwrite")
            .partitionBy("year")
            .option("header", True)
            .csv(f"{path}/by_year")
        )
    if combined:
        shipments.write.mode("overwrite").option("header", True).csv(f"{path}/all")
