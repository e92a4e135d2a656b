"""Managed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_format(spark: SparkSession) -> str:
    """Delta where the session has it, else parquet."""
    return "delta" if "delta" in spark.conf.get("spark.sql.extensions", "") else "parquet"


def write_table(df: DataFrame, name: str, fmt: str | None = None, path: str | None = None) -> None:
    """Replaces the table; `path` makes it external."""
    writer = df.write.format(fmt or table_format(df.sparkSession)).mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
