"""Intermediate tables and files in the shared folder of the cluster."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerlane.sinks import stage, staging_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs in here drop their shuffle files when they end."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """Runs `df` into a table under spark.checkpoint.dir and returns a reader of it.

    The table takes the place of the shuffle files that led to it, so these go at once.
    """
    with _shuffles_removed(df.sparkSession):
        return stage(df, staging_folder(df.sparkSession))


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `cut` wrote and nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {path.rpartition("/")[0] for path in table.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def share_file(spark: SparkSession, name: str, content: bytes) -> str:
    """Writes a file into the shared folder and has Spark hand it to every executor; returns its name there."""
    folder = staging_folder(spark)
    context = spark.sparkContext
    unique = f"{name}-{uuid.uuid4().hex}"
    path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/{unique}")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    context.addFile(path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return unique
