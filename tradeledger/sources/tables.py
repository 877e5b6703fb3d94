"""Reading the star: CSV exports, a stored warehouse, published products."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.sources import snapshots
from tradeledger.sources.schemas import CRM, DIMENSIONS, FACT, TABLES
from tradeledger.star import Star

# Where an export keeps its files, below its root folder.
EXPORT_LAYOUT = {
    **{name: f"{name}.csv" for name in DIMENSIONS},
    **{name: f"salesforce_exports/{name}.csv" for name in CRM},
    FACT: "distributor_shipments/shipments_all.csv",
}
# Columns of lines that don't parse: their text and the file they are in.
REJECTED = ("rejected_line", "rejected_file")
YEARLY_SHIPMENTS = "distributor_shipments/shipments_[0-9][0-9][0-9][0-9].csv"


def read_table(
    spark: SparkSession, name: str, path: str | list[str], keep_rejected: bool = False
) -> DataFrame:
    """A CSV file, folder, glob or list of them with the table's own types.

    Column names in the header have to agree with the schema, so a file with
    its columns in another order is refused and not read into wrong columns. A
    line that doesn't parse ends the read, or with ``keep_rejected`` becomes a row with its
    text and file in the columns REJECTED, for the sinks to put aside.
    """
    schema = TABLES[name]
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if not keep_rejected:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    line, file = REJECTED
    read = (
        reader.schema(T.StructType([*schema.fields, T.StructField(line, T.StringType())]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", line)
        .csv(path)
    )
    where = F.when(F.col(line).isNotNull(), F.col("_metadata.file_path"))
    return read.select(*schema.names, line, where.alias(file))


def read_shipments(
    spark: SparkSession, path: str | list[str], missing_ok: bool = False, keep_rejected: bool = False
) -> DataFrame:
    """Shipments from the combined file or from yearly ones.

    A missing file raises, or with ``missing_ok`` warns and reads as empty.
    """
    try:
        return read_table(spark, FACT, path, keep_rejected)
    except AnalysisException as error:
        if not missing_ok or error.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no shipments at {path}", stacklevel=2)
        return spark.createDataFrame([], TABLES[FACT])


def read_export(
    spark: SparkSession, root: str, yearly: bool = False, missing_ok: bool = False, keep_rejected: bool = False
) -> Star:
    """The star over the CSV files of an export; each is opened on first use.

    With ``keep_rejected`` it is meant for ``sinks.write_star`` alone: its tables have the
    lines that don't parse as well.
    """
    loaders = {
        name: lambda n=name, p=path: read_table(spark, n, f"{root}/{p}", keep_rejected)
        for name, path in EXPORT_LAYOUT.items()
        if name != FACT
    }
    shipments = f"{root}/{YEARLY_SHIPMENTS if yearly else EXPORT_LAYOUT[FACT]}"
    loaders[FACT] = lambda: read_shipments(spark, shipments, missing_ok, keep_rejected)
    return Star(spark, loaders)


def read_product(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """A published JSON product with its own types, or None where there is none.

    A ``.json`` file holds one array or object and is read whole, which suits the size of a
    product; a folder holds JSON lines, is read in parallel and in its latest version.
    """
    read = spark.read.schema(schema).option("mode", "FAILFAST")
    try:
        if path.endswith(".json"):
            return read.option("multiLine", True).json(path)
        latest = snapshots.current(spark, path)
        return read.json([f"{path}/rows/load={p.load}" for p in latest.tables["rows"]]) if latest.version else None
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def register_views(star: Star, prefix: str = "") -> None:
    """Make the nine tables available to ``spark.sql`` under their names."""
    for name in TABLES:
        star.table(name).createOrReplaceTempView(prefix + name)


def read_view(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
