"""Small steps on files that Spark's writers don't offer: atomic replacement and joining parts.

Data passes through as a stream; nothing is held whole.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).delete(_path(spark, path), True)


def replace_file(spark: SparkSession, new: str, target: str) -> None:
    """Put a finished file in the place of another in one step, so a reader finds one or the other."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    target_path = _path(spark, target)
    qualified = file_system(spark, target).makeQualified(target_path)
    context = hadoop.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, new), target_path, options)


def join_parts(spark: SparkSession, folder: str, target: str, head: bytes, tail: bytes, skip: int = 0) -> None:
    """One file out of a folder's parts in name order, between ``head`` and ``tail``.

    The first ``skip`` bytes of the first part that isn't empty are left out.
    """
    fs = file_system(spark, folder)
    found = fs.listStatus(_path(spark, folder))
    parts = sorted((str(s.getPath()), s.getLen()) for s in found if s.getPath().getName().startswith("part-"))
    out = file_system(spark, target).create(_path(spark, target), True)
    try:
        out.write(bytearray(head))
        for part, length in parts:
            if not length:
                continue
            source = fs.open(_path(spark, part))
            try:
                source.seek(skip)
                skip = 0
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
            finally:
                source.close()
        out.write(bytearray(tail))
    finally:
        out.close()
