"""The batch runs: load an export, build the warehouse, publish the products."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.operators import quality
from tradeledger.operators.preagg import merge_single_rows
from tradeledger.plans import crm, shipments, territory
from tradeledger.sources import sinks, tables
from tradeledger.sources.schemas import TABLES
from tradeledger.star import Star

SUMMARIES = {
    "analytics_yoy_growth": shipments.an_yoy_growth,
    "analytics_rep_summary": crm.an_rep_summary,
    "analytics_monthly_trend": shipments.an_monthly_trend,
}

PRODUCTS = {
    "yoy_growth": shipments.kpi_yoy_growth,
    "distributor_scorecards": shipments.kpi_distributor_scorecards,
    "rep_rankings": crm.kpi_rep_rankings,
    "territory_heatmap": territory.kpi_territory_heatmap,
    "pipeline_health": crm.kpi_pipeline_health,
    "monthly_trends": shipments.kpi_monthly_trends,
    "activity_correlation": crm.kpi_activity_correlation,
    "distributor_scorecard": shipments.vw_distributor_scorecard,
    "territory_summary": territory.vw_territory_summary,
}

EXPORTED_SUMMARIES = {
    "monthly_trend": "analytics_monthly_trend",
    "distributor_growth": "analytics_yoy_growth",
    "rep_summary": "analytics_rep_summary",
}


def load_warehouse(spark: SparkSession, export_root: str, path: str, yearly: bool = False) -> Star:
    """CSV export to Parquet warehouse with roll-ups, as its next version.

    The CSV text is parsed once; roll-ups and all reports read Parquet. The
    shipment rows are read twice for the roll-ups and not again. Lines that don't parse are
    put aside (``sinks.rejected_lines``).
    """
    sinks.write_star(tables.read_export(spark, export_root, yearly, keep_rejected=True), path, rollups=True)
    return sinks.open_star(spark, path, rollups=True)


def build_summaries(star: Star, path: str) -> None:
    for name, report in SUMMARIES.items():
        sinks.write_summary(report(star), f"{path}/{name}")


def product_schema(spark: SparkSession, name: str) -> T.StructType:
    """A product's columns and types, which are those of its report over any star."""
    empty = Star.of(spark)
    if name == "executive_summary":
        return merge_single_rows(shipments.shipment_totals(empty), crm.deal_totals(empty)).schema
    report = PRODUCTS.get(name) or SUMMARIES[EXPORTED_SUMMARIES[name]]
    return report(empty).schema


def publish_products(star: Star, warehouse: str, path: str) -> dict[str, str]:
    """All JSON products, one file each: the KPI reports, the card, and the stored summaries.

    One that fails doesn't stop the others, and leaves the former file; returns the failures by product.
    """
    jobs: dict[str, Callable[[], None]] = {
        "executive_summary": lambda: sinks.write_kpi_card(
            f"{path}/executive_summary.json", shipments.shipment_totals(star), crm.deal_totals(star)
        )
    }
    for name, report in PRODUCTS.items():
        jobs[name] = lambda n=name, r=report: sinks.write_json(r(star), f"{path}/{n}.json")
    for name, summary in EXPORTED_SUMMARIES.items():
        jobs[name] = lambda n=name, s=summary: sinks.write_json(
            sinks.read_summary(star.spark, f"{warehouse}/{s}"), f"{path}/{n}.json"
        )
    failed = {}
    for name, job in jobs.items():
        try:
            job()
        except Exception as error:
            failed[name] = str(error)
            warnings.warn(f"product {name} was not written: {error}", stacklevel=2)
    return failed


def _published(spark: SparkSession, failed: dict[str, str]) -> DataFrame:
    """A check for each product: 1 where it was not written."""
    names = ["executive_summary", *PRODUCTS, *EXPORTED_SUMMARIES]
    rows = [("published", n, None, float(n in failed), None, 0.0, n not in failed) for n in names]
    kinds = "check string, table_name string, column_name string, observed double, lower double, upper double, passed boolean"
    return spark.createDataFrame(rows, kinds)


def _rejected(spark: SparkSession, warehouse: str) -> DataFrame:
    """A check for each table: how many lines didn't parse."""
    lines = sinks.rejected_lines(spark, warehouse).groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    names = spark.createDataFrame([(n,) for n in TABLES], "table_name string")
    found = names.join(lines, "table_name", "left").select(
        F.lit("rejected_lines").alias("check"), "table_name", F.lit(None).cast("string").alias("column_name"),
        F.coalesce("n", F.lit(0)).cast("double").alias("observed"),
        F.lit(None).cast("double").alias("lower"), F.lit(0.0).alias("upper"),
    )
    return found.withColumn("passed", F.col("observed") == 0)


def check_warehouse(spark: SparkSession, warehouse: str, star: Star | None = None) -> DataFrame:
    """The quality report of a stored warehouse; declared checks come from when it was written."""
    star = star or sinks.open_star(spark, warehouse, rollups=True)
    report = quality.quality_report(star, stored=sinks.stored_checks(spark, warehouse))
    return report.unionByName(_rejected(spark, warehouse))


def run_all(spark: SparkSession, export_root: str, warehouse: str, products: str) -> DataFrame:
    """Load, check, summarise and publish; returns the quality report.

    The report is stored in the warehouse before anything is published, so whoever reads the
    products can see what was known about the data. What is returned also has a row for each product; one
    that was not written is a failed check.
    """
    star = load_warehouse(spark, export_root, warehouse)
    sinks.write_summary(check_warehouse(spark, warehouse, star), f"{warehouse}/quality_report")
    build_summaries(star, warehouse)
    failed = publish_products(star, warehouse, products)
    return sinks.read_summary(spark, f"{warehouse}/quality_report").unionByName(_published(spark, failed))
