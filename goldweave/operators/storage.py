"""Where intermediate results that must not be recomputed are kept."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the cluster names. A session on
    this machine alone may do without; then a folder of this machine is used.
    On a cluster that names none the job stops."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if named:
        if current.isEmpty():
            context.setCheckpointDir(named)
        return named
    if current.isEmpty():
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="goldweave-"))
        current = context._jsc.sc().getCheckpointDir()
    return current.get()


# folders of the job that is running, if it removes them at its end
_MADE: list[list[str]] = []


def new_folder(spark: SparkSession, label: str) -> str:
    folder = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _MADE:
        _MADE[-1].append(folder)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder of the job's own, wherever it lies."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are removed at the end, also of a run
    that fails: what it finished is in its result folder."""
    _MADE.append([])
    try:
        yield
    finally:
        for folder in _MADE.pop():
            remove(spark, folder)


def settle(df: DataFrame) -> DataFrame:
    """Write the rows out once and go on from there: values that a rerun could
    draw differently (row ids, range bounds) stay as they are when an executor
    is lost."""
    if _MADE:  # a table that can be removed
        return written(df, "settled")
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Like `settle`, as a Parquet table: smaller on disk, for larger results."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
