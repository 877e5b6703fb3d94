"""Versions of a folder of tables, switched by one small file.

Every write goes to a folder of its own, ``table/load=ID``. A version lists the loads that make up
each table; it is one file appended to the log ``_versions``, and is written last. So a write that
stops half-way changes nothing a reader can see, and a reader that has taken a version keeps to its
files whatever is written later. A load can leave out parts that a later one brought anew, by the
values of a partition column, so replacing a year touches no file of another year.

One writer at a time: a version that someone else wrote meanwhile makes ``commit`` fail.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeledger.sources import files

LOG = "_versions"
LOG_SCHEMA = "version long, table_name string, load string, kind string, tag string, by string, without array<string>"


@dataclass(frozen=True)
class Part:
    """A load of a table, its schema, and values of the partition column ``by`` that later loads replaced."""

    load: str
    kind: str
    tag: str | None = None
    by: str | None = None
    without: tuple[str, ...] = ()


@dataclass(frozen=True)
class Snapshot:
    path: str
    version: int = 0
    tables: dict[str, tuple[Part, ...]] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """The table's rows, with its partition columns; parts that were replaced are not opened."""
        parts = self.tables[name]
        rows = _open(spark, f"{self.path}/{name}", parts)
        for p in parts:
            if p.without:
                gone = F.coalesce(F.col(p.by).cast("string"), F.lit("")).isin(*p.without)
                rows = rows.filter((F.col("load") != p.load) | ~gone)
        return rows.drop("load")

    def has_tag(self, name: str, tag: str) -> bool:
        return any(p.tag == tag for p in self.tables.get(name, ()))


def _open(spark: SparkSession, base: str, parts: tuple[Part, ...]) -> DataFrame:
    """Rows of some loads. Their schema was noted when they were written: a load may have no file to tell it."""
    schema = T.StructType.fromJson(json.loads(parts[-1].kind)).add("load", T.StringType())
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/load={p.load}" for p in parts])


def current(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The latest version, or the one asked for; version 0 has no tables."""
    try:
        log = spark.read.schema(LOG_SCHEMA).json(f"{path}/{LOG}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], LOG_SCHEMA)
    wanted = log.filter(F.col("version") == version) if version is not None else log
    # the rows of one version: one a load in use
    last = wanted.groupBy("version").agg(F.collect_list(F.struct(*log.columns)).alias("rows")).orderBy(F.desc("version"))
    found = last.limit(1).collect()
    if not found:
        if version:
            raise ValueError(f"no version {version} below {path}")
        return Snapshot(path)
    tables: dict[str, tuple[Part, ...]] = {}
    for r in sorted(found[0]["rows"], key=lambda r: (r["table_name"], r["load"])):
        part = Part(r["load"], r["kind"], r["tag"], r["by"], tuple(r["without"] or ()))
        tables[r["table_name"]] = (*tables.get(r["table_name"], ()), part)
    return Snapshot(path, found[0]["version"], tables)


class Writer:
    """Builds the next version. Nothing shows before ``commit``; ``with`` commits unless something failed."""

    def __init__(self, spark: SparkSession, path: str, tag: str | None = None):
        self.spark, self.path, self.tag = spark, path, tag
        self.base = current(spark, path)
        self.load = f"{self.base.version + 1:06d}-{uuid.uuid4().hex[:8]}"
        self.tables = dict(self.base.tables)

    def __enter__(self) -> Writer:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}/load={self.load}"

    def _write(self, name: str, df: DataFrame, by: tuple[str, ...], format: str) -> Part:
        writer = df.write.partitionBy(*by) if by else df.write
        if format == "json":
            writer = writer.option("ignoreNullFields", False)
        writer.format(format).save(self.folder(name))
        return Part(self.load, df.schema.json(), self.tag)

    def put(self, name: str, df: DataFrame, by: tuple[str, ...] = (), format: str = "parquet") -> None:
        """The whole table anew."""
        self.tables[name] = (self._write(name, df, by, format),)

    def add(self, name: str, df: DataFrame, by: tuple[str, ...] = ()) -> None:
        """Rows beside those there are."""
        self.tables[name] = (*self.tables.get(name, ()), self._write(name, df, by, "parquet"))

    def swap(self, name: str, df: DataFrame, by: tuple[str, ...], key: str, values: Iterable) -> None:
        """Rows in place of all former ones whose partition column ``key`` has one of ``values``."""
        gone = {"" if v is None else str(v) for v in values}
        former = tuple(replace(p, by=key, without=tuple(sorted({*p.without, *gone}))) for p in self.tables.get(name, ()))
        self.tables[name] = (*former, self._write(name, df, by, "parquet"))

    def written(self, name: str) -> DataFrame:
        """What this writer wrote for the table; for figures before the commit."""
        return _open(self.spark, f"{self.path}/{name}", self.tables[name][-1:]).drop("load")

    def commit(self) -> Snapshot:
        if current(self.spark, self.path).version != self.base.version:
            raise RuntimeError(f"another version was written below {self.path}")
        made = Snapshot(self.path, self.base.version + 1, self.tables)
        rows = [
            (made.version, name, p.load, p.kind, p.tag, p.by, list(p.without)) for name, parts in self.tables.items() for p in parts
        ]
        # a single file is moved to its place when it is complete
        self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").json(f"{self.path}/{LOG}")
        return made


def remove_unused(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete loads that none of the last ``keep`` versions uses, finished or not; returns their folders.

    Readers of older versions lose their files, and so does a writer at work: run it between loads.
    """
    last = current(spark, path).version
    used = {
        (name, p.load)
        for v in range(max(1, last - keep + 1), last + 1)
        for name, parts in current(spark, path, v).tables.items()
        for p in parts
    }
    fs = files.file_system(spark, path)
    gone = []
    for table in fs.listStatus(files._path(spark, path)):
        name = table.getPath().getName()
        if not table.isDirectory() or name.startswith("_"):
            continue
        for load in fs.listStatus(table.getPath()):
            folder = load.getPath().getName()
            if folder.startswith("load=") and (name, folder.removeprefix("load=")) not in used:
                files.delete(spark, str(load.getPath()))
                gone.append(f"{name}/{folder}")
    return sorted(gone)
