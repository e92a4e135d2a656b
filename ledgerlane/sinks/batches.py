"""Tables that grow by loads. A load has a name and replaces the rows of that name, so it can be run again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.functions import quoted, ref
from ledgerlane.sinks.tables import table_format

BATCH = "load_batch"


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _partitions(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def write_batch(df: DataFrame, name: str, batch: str, fmt: str | None = None, path: str | None = None) -> None:
    """Replaces the rows of `batch` in the table, also by none; all other batches stay as they are.

    The table is made by its first batch, with one partition per batch in a last column `load_batch`. Later
    batches need the same columns, in any order. A load that fails may leave its own batch incomplete, and
    no other; running it again makes it whole.
    """
    spark = df.sparkSession
    if not batch:
        raise ValueError("A batch needs a name")
    if BATCH in df.columns:
        raise ValueError(f"{BATCH} is the column that tells batches apart")
    kind = fmt or table_format(spark)
    if not spark.catalog.tableExists(name):
        writer = df.limit(0).withColumn(BATCH, F.lit(batch)).write.format(kind).partitionBy(BATCH)
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
    if kind == "delta":
        tagged = df.withColumn(BATCH, F.lit(batch))
        tagged.write.format(kind).mode("overwrite").option("replaceWhere", f"{BATCH} = {_literal(batch)}").saveAsTable(name)
        return
    if _partitions(spark, name) != [BATCH]:
        raise ValueError(f"{name} is not divided by {BATCH}")
    columns = [c for c in spark.table(name).columns if c != BATCH]
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"{name} has the columns {', '.join(columns)}, the batch {', '.join(df.columns)}")
    # Naming the partition, unlike finding it in the rows, empties it when there are none.
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({BATCH} = {_literal(batch)}) SELECT {', '.join(map(quoted, columns))} FROM {{rows}}",
        rows=df.select(*map(ref, columns)),
    )


def batch_rows(spark: SparkSession, name: str, batch: str) -> DataFrame:
    """The rows of one batch, read from its partition only."""
    return spark.table(name).where(F.col(BATCH) == batch).drop(BATCH)


def all_batches(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(BATCH)
