"""The greatest rows of each group, ties included, by the value that the last of them has.

Each task keeps a bounded number of values per group and passes the rest by. What tasks keep is merged
in two steps. The value that decides is then looked up by the rows, so no group comes together anywhere.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions import ref
from ledgerlane.operators.lookups import ROWS_PER_TASK, left_lookup, run_measure
from ledgerlane.sinks import stage, staging_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Values that a task holds before it drops those that are not among the greatest.
VALUES_HELD = 1 << 18
#: Parts that a group's values are merged in first.
MERGE_PARTS = 256


def greatest(table: pa.Table, k: int) -> pa.Table:
    """The k greatest values of each group, sorted by group."""
    order = pc.sort_indices(table, [("key", "ascending"), ("value", "descending")])
    table = table.take(order).combine_chunks()
    if not table.num_rows:
        return table
    key = table.column("key")
    key = key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key
    before, after = key.slice(0, len(key) - 1), key.slice(1)
    changed = pc.or_(pc.fill_null(pc.not_equal(before, after), False), pc.xor(pc.is_null(before), pc.is_null(after)))
    starts = np.concatenate([[0], np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1])
    place = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
    return table.filter(pa.array(place < k))


def _kept(df: DataFrame, k: int) -> DataFrame:
    """(key, value) of each task's k greatest values of a group, in as many rounds as its groups need."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = greatest(pa.Table.from_batches([batch]), k)
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows > VALUES_HELD:
                held = greatest(held, k)
                if held.num_rows > VALUES_HELD // 2:
                    yield from held.to_batches()
                    held = None
        if held is not None:
            yield from greatest(held, k).to_batches()

    return df.mapInArrow(keep, df.schema)


def run_top(df: DataFrame, group: str, value: str, k: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rows whose value is among the k greatest of their group: those that fewer than k rows of it exceed.

    Ties are kept, so a group may have more than k rows. Null values come last and count only where a group
    has fewer than k others; a null group is a group. Runs jobs over both columns.
    """
    if k < 1:
        raise ValueError("k is at least 1")
    pairs = df.where(ref(value).isNotNull()).select(ref(group).alias("key"), ref(value).alias("value"))

    def merged(values, *keys):
        best = F.slice(F.sort_array(F.flatten(F.collect_list(values)), asc=False), 1, k)
        return lambda rows: rows.groupBy(*keys).agg(best.alias("best"))

    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)).alias("part")
    parts = merged(F.array("value"), "key", "part")(_kept(pairs, k).select("key", "value", part))
    whole = merged(F.col("best"), "key")(parts)
    # A group with fewer values than k has no least one.
    least = whole.where(F.size("best") == k).select(F.col("key").alias(group), F.element_at("best", k).alias("__least"))
    least = stage(least, f"{staging_folder(df.sparkSession)}/least")
    known = least.where(ref(group).isNotNull())
    null_least = least.where(ref(group).isNull()).select("__least").first()
    (limits,) = run_measure((known, group), fact=df, rows_per_task=rows_per_task)
    rows = left_lookup(df, limits)
    limit = F.col("__least") if null_least is None else F.when(ref(group).isNull(), F.lit(null_least[0])).otherwise(F.col("__least"))
    kept = limit.isNull() | F.coalesce(ref(value) >= limit, F.lit(False))
    return rows.where(kept).select(*map(ref, df.columns))
