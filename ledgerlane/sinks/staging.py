"""Shared folder for intermediate tables, so a lost executor never means reading the source again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    """A new place under `spark.checkpoint.dir`, gone when the driver ends.

    Only a local session may do without that setting, which has to name a folder that all share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlane-")
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/ledgerlane-{uuid.uuid4().hex}")
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{folder}/staged"


def stage(df: DataFrame, folder: str) -> DataFrame:
    """Writes `df` as parquet and returns a reader of it, which cuts the lineage."""
    df.write.mode("errorifexists").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
