"""Lineage is cut by tables written to the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and go on from the written rows.

    A written table survives lost executors, and its size is known. (A checkpointed frame
    keeps the estimate of the plan it came from; joins multiply estimates, and over
    the rounds of a loop the numbers get so long that planning stops.) The tables live
    until the driver ends, for the frames made from them are computed later.
    """
    path = f"{_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession) -> str:
    """This application's folder below the one that ``spark.checkpoint.dir`` names.

    Where none is set, a single-machine session (tests) gets its own; a cluster is an error.
    """
    context = spark.sparkContext
    if context.applicationId not in _own:
        shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if shared is None:
            if not (context.master or "").startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="checkpoints-")
        folder = _own[context.applicationId] = f"{shared}/tables-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, folder)
    return _own[context.applicationId]


def _remove(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
