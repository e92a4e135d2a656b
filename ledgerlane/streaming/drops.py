"""Files that keep arriving, taken up by Structured Streaming with the rules of a contract.

Each call takes what has arrived since the last one and ends. Offsets, the keys already seen and the
files written are kept under the target folder, so a call that fails is carried on by the next, and
every file counts once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.contracts import DatasetContract
from ledgerlane.functions import quoted, ref
from ledgerlane.operators.quality import evaluate, quarantine, rule_counters, valid, without_raw_of_valid
from ledgerlane.operators.rules import ReadableRule
from ledgerlane.operators.shape import conform
from ledgerlane.session import changed_settings
from ledgerlane.sources.files import CORRUPT
from ledgerlane.sources.json_arrays import by_headers

#: Progress reports kept for adding up the counters of a call, one per micro-batch.
REPORTS_KEPT = 100_000
WHOLE_ROW = "__whole_row"
_STORE = "spark.sql.streaming.stateStore"
#: Keys seen are kept for good, so they live on disk with a bounded share of memory, whatever the session is set to.
#: A call writes what it changed of them, and they are not counted, which would ask for each key once more.
#: A progress folder goes on with the store it was begun with.
STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}


@dataclass
class StreamRun:
    """What all calls so far have taken up, and what the last one counted."""

    contract: DatasetContract
    staged: DataFrame
    counts: dict[str, int]
    micro_batches: int

    @property
    def clean(self) -> DataFrame:
        return conform(valid(self.staged), self.contract.schema)

    @property
    def quarantine(self) -> DataFrame:
        return quarantine(self.staged, self.contract.name)


def _arriving(spark: SparkSession, source: str, contract: DatasetContract, fmt: str, files_per_batch: int | None) -> DataFrame:
    """Rows of new files as texts, under the contract's names, and the text of records that can't be read."""
    if fmt == "json":
        reader = spark.readStream.format("text")
        reader = reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)
        lines = reader.load(source).where(F.trim("value") != "").select(F.col("value").alias("text"))
        rows = by_headers(lines, contract.headers, CORRUPT)
    elif fmt == "csv":
        fields = ", ".join(f"{quoted(n)} string" for n in [*contract.headers, CORRUPT])
        options = {"header": "true", "enforceSchema": "false", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}
        reader = spark.readStream.format("csv").schema(T.StructType.fromDDL(fields)).options(**{**contract.read_options, **options})
        reader = reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)
        rows = reader.load(source)
    else:
        raise ValueError(f"Files of the format {fmt} can't be streamed")
    return rows.withColumnsRenamed(contract.renames)


def _without_keys(rows: DataFrame, keys: Sequence[str]) -> Column:
    """The whole row as a text where a key is missing, else null: with the keys it tells deliveries apart."""
    present = reduce(and_, [ref(key).isNotNull() for key in keys])
    return F.when(~present, F.to_json(F.struct(*map(ref, rows.columns))))


def run_drops(
    spark: SparkSession,
    source: str,
    target: str,
    contract: DatasetContract,
    keys: Sequence[str],
    fmt: str = "json",
    files_per_batch: int | None = None,
    horizon: str | None = None,
) -> StreamRun:
    """Takes up the files of `source` (JSON lines or CSV) that no call has taken up, and waits for the end.

    A row whose `keys` came before, in an earlier file or call, is a repeated delivery and left out; the
    first one stays, whatever the rules say of it. Rows that lack a key are compared whole. The keys seen
    are state that grows with them, kept on disk; with a `horizon` ("30 days") they are forgotten so long after they
    arrived, and rows delivered again later than that count anew. Verdicts are written once, as in batch
    ingestion. Rows and rules are counted on the way.
    """
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(REPORTS_KEPT))
    rows = _arriving(spark, source, contract, fmt, files_per_batch)
    # The keys are columns of the row already, so no second text of them is shuffled and kept.
    marked = rows.withColumn(WHOLE_ROW, _without_keys(rows, keys))
    told = [*keys, WHOLE_ROW]
    if horizon is None:
        once = marked.dropDuplicates(told)
    else:
        once = marked.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", horizon)
        once = once.dropDuplicatesWithinWatermark(told).drop("__arrived")
    rules = [ReadableRule(CORRUPT), *contract.rules]
    flagged = without_raw_of_valid(evaluate(once.drop(WHOLE_ROW), rules))
    name = f"arrived {contract.name}"
    observed = flagged.observe(name, *rule_counters(rules))
    writer = (
        observed.writeStream.format("parquet")
        .outputMode("append")
        .option("compression", "zstd")
        .option("checkpointLocation", f"{target}/progress")
        .trigger(availableNow=True)
    )
    with changed_settings(spark, STATE):
        query = writer.start(f"{target}/staged")
    query.awaitTermination()
    counts: Counter[str] = Counter()
    reports = query.recentProgress
    for report in reports:
        found = report.observedMetrics.get(name)
        if found is not None:
            counts.update({k: v or 0 for k, v in found.asDict().items()})
    staged = spark.read.schema(flagged.schema).parquet(f"{target}/staged")
    return StreamRun(contract, staged, dict(counts), len(reports))
