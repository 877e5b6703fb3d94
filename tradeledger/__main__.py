"""Batch runs for ``spark-submit`` or ``python -m tradeledger``.

    run EXPORT WAREHOUSE PRODUCTS   load, summarise, publish and check
    load EXPORT WAREHOUSE           CSV export to Parquet warehouse with roll-ups
    append CHUNK WAREHOUSE TAG      add a CSV chunk of shipments to the warehouse
    publish WAREHOUSE PRODUCTS      summaries and JSON products
    check WAREHOUSE                 quality report; exit status 1 when a check fails
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tradeledger.plans import publish
from tradeledger.sources import sinks, tables

COMMANDS = {
    "run": ("export", "warehouse", "products"),
    "load": ("export", "warehouse"),
    "append": ("chunk", "warehouse", "tag"),
    "publish": ("warehouse", "products"),
    "check": ("warehouse",),
}


def parse(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tradeledger")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, folders in COMMANDS.items():
        command = commands.add_parser(name)
        for folder in folders:
            command.add_argument(folder)
    return parser.parse_args(argv)


def report(checks: DataFrame) -> int:
    """Print the checks, one row each, and say whether all passed."""
    rows = checks.collect()
    for row in rows:
        place = ".".join(filter(None, (row["table_name"], row["column_name"])))
        print("ok  " if row["passed"] else "FAIL", row["check"], place, row["observed"])
    return 0 if all(row["passed"] for row in rows) else 1


def main(argv: list[str], spark: SparkSession | None = None) -> int:
    args = parse(argv)
    spark = spark or SparkSession.builder.appName("tradeledger").getOrCreate()
    if args.command == "run":
        return report(publish.run_all(spark, args.export, args.warehouse, args.products))
    if args.command == "load":
        publish.load_warehouse(spark, args.export, args.warehouse)
        return 0
    if args.command == "append":
        chunk = tables.read_shipments(spark, args.chunk, keep_rejected=True)
        sinks.append_shipments(spark, chunk, args.warehouse, args.tag)
        return 0
    star = sinks.open_star(spark, args.warehouse, rollups=True)
    if args.command == "publish":
        publish.build_summaries(star, args.warehouse)
        failed = publish.publish_products(star, args.warehouse, args.products)
        return 1 if failed else 0
    return report(publish.check_warehouse(spark, args.warehouse, star))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
