"""Sources and sinks at work: write the star or a product, read it back, report.

Each report writes to a new folder under the shared folder the session names
for checkpoints, and what it returns is computed from the files alone. The
files stay there as long as checkpoints do.
"""

from __future__ import annotations

import tempfile
import uuid
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.operators import quality, states
from tradeledger.operators.preagg import merge_single_rows, shipments_by
from tradeledger.plans import crm, publish, shipments, territory
from tradeledger.sources import sinks, tables
from tradeledger.sources.schemas import CRM, DIMENSIONS, TABLES
from tradeledger.star import Star

# The columns that the test tables fill; the others are NULL throughout.
COMPARED = {
    "territories": ("territory_id", "territory_name", "region", "state"),
    "distributors": ("distributor_id", "distributor_name", "distributor_type", "territory_id"),
    "operators": ("operator_id", "operator_name", "operator_type", "territory_id", "annual_revenue_tier"),
    "products": ("product_id", "product_name", "brand", "category", "subcategory", "standard_price", "cost"),
    "sales_reps": ("rep_id", "rep_name", "territory_id", "rep_tier", "quota_annual"),
    "sf_accounts": ("account_id", "operator_id", "owner_id"),
    "sf_opportunities": (
        "opportunity_id", "account_id", "stage", "amount", "probability", "close_date", "created_date", "owner_id",
        "lead_source", "loss_reason",
    ),
    "sf_activities": ("activity_id", "account_id", "owner_id", "activity_type", "activity_date", "duration_minutes"),
    "shipments": (
        "shipment_date", "week_ending", "distributor_id", "operator_id", "product_id", "quantity", "gross_sales",
        "discounts", "returns", "net_sales", "cost_of_goods",
    ),
}


def _folder(star: Star, name: str) -> str:
    """A new folder below the one all executors share.

    Where none is named, a single-machine session writes below its temporary folder; a
    cluster is an error, for its executors would each write to a disk of their own.
    """
    spark = star.spark
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not (spark.sparkContext.master or "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.gettempdir()
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def profile(df: DataFrame, name: str) -> DataFrame:
    """A row for each column of the table: rows, values, and a total over the values.

    All columns are read, so a value lost or changed on the way shows. ``total`` is the sum of
    numbers and of days since 1970 for dates; ``chars`` sums the lengths of texts and ids.
    """
    df = df.select(*[F.col(c).cast("string").alias(c) if c.endswith("_id") else c for c in df.columns])

    def total(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.NumericType):
            return F.coalesce(F.sum(F.col(field.name).cast("decimal(28,2)")).cast("double"), F.lit(0.0))
        if isinstance(field.dataType, T.DateType):
            return F.coalesce(F.sum(F.unix_date(field.name)).cast("double"), F.lit(0.0))
        return F.lit(0.0)

    def chars(field: T.StructField) -> Column:
        length = F.length(field.name) if isinstance(field.dataType, T.StringType) else F.lit(0)
        return F.coalesce(F.sum(length), F.lit(0))

    fields = df.schema.fields
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.struct(F.count(f.name).alias("value_count"), total(f).alias("total"), chars(f).alias("chars")).alias(f"v{i}")
            for i, f in enumerate(fields)
        ],
    )
    rows = [
        F.struct(
            F.lit(name).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            F.col("rows").alias("row_count"),
            F.col(f"v{i}.value_count").alias("value_count"),
            F.col(f"v{i}.total").alias("total"),
            F.col(f"v{i}.chars").alias("chars"),
        )
        for i, f in enumerate(fields)
    ]
    return wide.select(F.inline(F.array(*rows)))


def _through_csv(star: Star, names: tuple[str, ...], folder: str) -> DataFrame:
    """Profiles of tables that went through CSV files."""

    def through(name: str) -> DataFrame:
        path = f"{folder}/{name}"
        exported = star.table(name).select(*TABLES[name].names)
        exported.write.option("header", True).csv(path)
        read = tables.read_table(star.spark, name, path)
        return profile(read.select(*[c for c in read.columns if c in COMPARED[name]]), name)

    return reduce(lambda a, b: a.unionByName(b), [through(n) for n in names])


def read_master(star: Star) -> DataFrame:
    return _through_csv(star, DIMENSIONS, _folder(star, "master"))


def read_crm(star: Star) -> DataFrame:
    return _through_csv(star, CRM, _folder(star, "crm"))


def _yearly(star: Star) -> DataFrame:
    return shipments_by(star, "year", distinct=("active_operators",)).select(
        "year", "shipment_count", "quantity", "gross_sales", "net_sales", "active_operators"
    )


def _export_shipments(star: Star, name: str, **files: bool) -> str:
    """The files that the report reads; the export's other files would be written for no reader."""
    folder = _folder(star, name)
    sinks.write_csv_by_year(star.shipments.select(*TABLES["shipments"].names), folder, **files)
    return folder


def read_shipments(star: Star) -> DataFrame:
    """Yearly totals from the combined shipment file."""
    folder = _export_shipments(star, "shipments", by_year=False)
    read = tables.read_shipments(star.spark, f"{folder}/all")
    return _yearly(Star(star.spark, {"shipments": lambda: read}))


def write_csv_by_year(star: Star) -> DataFrame:
    """Yearly totals from the files of the single years."""
    folder = _export_shipments(star, "shipments_by_year", combined=False)
    read = tables.read_shipments(star.spark, f"{folder}/by_year/year=*")
    return _yearly(Star(star.spark, {"shipments": lambda: read}))


def write_star(star: Star) -> DataFrame:
    """Profiles of all nine tables of a stored warehouse."""
    folder = _folder(star, "star")
    sinks.write_star(star, folder)
    stored = sinks.open_star(star.spark, folder)
    frames = [profile(stored.table(n).select(*COMPARED[n]), n) for n in TABLES]
    return reduce(lambda a, b: a.unionByName(b), frames)


def write_rollups(star: Star) -> DataFrame:
    """Distributor scorecards from the stored roll-ups."""
    folder = _folder(star, "rollups")
    sinks.write_rollups(star, folder)
    rolled = star.with_rollups(sinks.rollup_loaders(star.spark, folder))
    return shipments.kpi_distributor_scorecards(rolled)


def write_summary(star: Star) -> DataFrame:
    """Row counts and totals of the three stored summaries."""
    folder = _folder(star, "summary")
    publish.build_summaries(star, folder)

    def figures(name: str, sales: str, count: str) -> DataFrame:
        return sinks.read_summary(star.spark, f"{folder}/{name}").agg(
            F.lit(name).alias("summary"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum(sales).cast("double").alias("sales"),
            F.sum(count).cast("long").alias("counted"),
        )

    frames = [
        figures("analytics_yoy_growth", "total_net_sales", "active_operators"),
        figures("analytics_rep_summary", "total_revenue", "total_activities"),
        figures("analytics_monthly_trend", "net_sales", "products_sold"),
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def write_json(star: Star) -> DataFrame:
    """The heat map as one JSON array, read back with its own types."""
    path = f"{_folder(star, 'json')}.json"
    made = territory.kpi_territory_heatmap(star)
    sinks.write_json(made, path)
    return tables.read_product(star.spark, path, made.schema)


def read_json_product(star: Star) -> DataFrame:
    """The monthly trends as JSON lines, written twice; the latest version is read."""
    folder = _folder(star, "product")
    made = shipments.kpi_monthly_trends(star)
    sinks.write_json_lines(made.limit(1), folder)
    sinks.write_json_lines(made, folder)
    return tables.read_product(star.spark, folder, made.schema)


def write_kpi_card(star: Star) -> DataFrame:
    path = f"{_folder(star, 'card')}.json"
    both = shipments.shipment_totals(star), crm.deal_totals(star)
    sinks.write_kpi_card(path, *both)
    return tables.read_product(star.spark, path, merge_single_rows(*both).schema)


def _chunks(star: Star) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Shipments up to 1997, those from then on, and those of 1996 that came with the first."""
    rows = star.shipments.select(*[c for c in star.shipments.columns if c != "shipment_id"])
    year = F.year("week_ending")
    return rows.filter(year < 1998), rows.filter(year >= 1998), rows.filter(year == 1996)


def _appended(star: Star) -> Star:
    """A warehouse that came in pieces: the first years, the rest in two chunks, one of them twice, and one year anew."""
    folder = _folder(star, "appended")
    early, late, again = _chunks(star)
    first = Star(star.spark, {**{n: lambda n=n: star.table(n) for n in TABLES if n != "shipments"}, "shipments": lambda: early})
    sinks.write_star(first, folder, rollups=True)
    odd = F.col("quantity") % 2 == 1
    for chunk, tag in ((late.filter(odd), "odd"), (late.filter(~odd), "even"), (late.filter(odd), "odd")):
        sinks.append_shipments(star.spark, chunk, folder, tag)
    sinks.append_shipments(star.spark, again, folder, "1996 anew", replace_years=True)
    return sinks.open_star(star.spark, folder, rollups=True)


def append_shipments(star: Star) -> DataFrame:
    """Yearly totals over the rows of a warehouse that came in pieces."""
    return _yearly(_appended(star).without_rollups())


def append_rollups(star: Star) -> DataFrame:
    """Distributor scorecards from roll-ups that were kept up while shipments came in pieces."""
    return shipments.kpi_distributor_scorecards(_appended(star))


# Lines that the export below spoils: a table, the column that gets no valid value, and where.
SPOILED = {
    "shipments": ("shipment_date", "quantity = 50", "yesterday"),
    "sf_opportunities": ("amount", "stage = 'Closed Lost'", "n/a"),
    "sales_reps": ("quota_annual", "rep_tier = 'Director'", "none"),
}


def read_rejected(star: Star) -> DataFrame:
    """An export with lines that don't parse, loaded: for each table how many lines were good and how many not."""
    folder = _folder(star, "rejected")

    def export(name: str) -> None:
        names, rows = TABLES[name].names, star.table(name)
        rows = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast("string").alias(c) for c in names])
        if name in SPOILED:
            column, where, value = SPOILED[name]
            rows = rows.withColumn(column, F.when(F.expr(where), F.lit(value)).otherwise(F.col(column)))
        rows.write.option("header", True).csv(f"{folder}/export/{name}")

    sinks.at_once(export, TABLES)
    read = {
        name: lambda n=name: tables.read_table(star.spark, n, f"{folder}/export/{n}", keep_rejected=True) for name in TABLES
    }
    sinks.write_star(Star(star.spark, read), f"{folder}/warehouse")
    good = sinks.stored_checks(star.spark, f"{folder}/warehouse").filter(F.col("check") == "row_count")
    bad = sinks.rejected_lines(star.spark, f"{folder}/warehouse").groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rejected"), F.count_if(F.length("line") > 0).alias("with_text"),
        F.count_if(F.col("file").contains("/export/")).alias("with_file"),
    )
    return good.join(bad, "table_name", "left").select(
        "table_name", F.col("observed").cast("long").alias("good"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rejected", "with_text", "with_file")],
    )


def sales_cube(star: Star) -> DataFrame:
    """Every slice of the stored cube."""
    folder = _folder(star, "cube")
    sinks.write_states(star, folder)
    cube = sinks.read_states(star.spark, folder, "cube")
    return cube.select("slice_id", *states.CUBE_KEYS, "quantity", "gross_sales", "net_sales", "returns", "shipment_count")


def operator_states(star: Star) -> DataFrame:
    """Distinct operators by year and type of distributor from stored monthly bitmaps."""
    folder = _folder(star, "operator_states")
    sinks.write_states(star, folder)
    return states.active_operators(sinks.read_states(star.spark, folder, "operators"), "year", "distributor_type")


def quantity_states(star: Star) -> DataFrame:
    """Quartiles by category from stored monthly sketches, held against the exact ranks."""
    folder = _folder(star, "quantity_states")
    sinks.write_states(star, folder)
    quartiles = states.quantity_quartiles(sinks.read_states(star.spark, folder, "quantities"), star.products)
    return states.within_rank_error(quartiles, quality.quantity_histogram(star))


def checks_while_writing(star: Star, first: date, last: date) -> DataFrame:
    """The declared checks as they were found while the star was written."""
    folder = _folder(star, "checks")
    sinks.write_star(star, folder, days=(first, last))
    return quality.judged(sinks.stored_checks(star.spark, folder))


def read_view(star: Star) -> DataFrame:
    """The star under SQL names, asked in SQL."""
    tables.register_views(star, prefix="ledger_")
    regions = tables.read_view(star.spark, "ledger_territories").select("territory_id", "region")
    regions.createOrReplaceTempView("ledger_regions")
    return star.spark.sql(
        """
        SELECT r.region, o.annual_revenue_tier, count(*) AS operators
        FROM ledger_operators o JOIN ledger_regions r ON r.territory_id = o.territory_id
        GROUP BY r.region, o.annual_revenue_tier
        """
    )
