"""Bounded tables of 64-bit keys that tasks map into memory: which keys may be there, and counts of frequent ones."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.storage import share_file
from ledgerlane.llm.wordspace import mixed

#: Bits that tell whether a key may be there, so many per key and at most so many. With more keys they tell
#: less, never anything wrong.
BITS_PER_KEY = 8
BITS = 1 << 27
#: Keys of a table of counts; others are left to a join.
KEYS = 1 << 20
#: Classes of counts per doubling; a class is in the table as a whole.
COUNT_STEPS = 16


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    return mixed(keys) & np.uint64(size - 1)


def run_bits(keys: DataFrame) -> str:
    """Shares the bits of the keys in the only column; at most BITS / 64 rows come to the driver."""
    (name,) = keys.columns
    size = min(BITS, max(64, 1 << (BITS_PER_KEY * keys.count() - 1).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = _slots(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), size)
            bit = np.uint64(1) << (slots & np.uint64(63))
            yield pa.RecordBatch.from_arrays(
                [pa.array((slots >> np.uint64(6)).astype(np.int32)), pa.array(bit.view(np.int64))], names=["block", "bits"]
            )

    blocks = keys.mapInArrow(mark, "block int, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(size // 64, dtype="<i8")
    bits[blocks.column("block").to_numpy()] = blocks.column("bits").to_numpy()
    return share_file(keys.sparkSession, f"bits-{name}", bits.tobytes())


class Bits:
    def __init__(self, name: str):
        self.bytes = np.memmap(SparkFiles.get(name), dtype=np.uint8, mode="r")

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        """False for keys that are certainly not there."""
        slots = _slots(keys, 8 * len(self.bytes))
        return self.bytes[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1 == 1


def run_counts(counts: DataFrame, key: str, count: str) -> str:
    """Shares the counts of at most KEYS keys, the most frequent ones, chosen by a histogram of counts."""
    sized = counts.select(key, count, F.floor(F.log2(count) * COUNT_STEPS).alias("size"))
    least, taken = None, 0
    for row in sized.groupBy("size").agg(F.count(F.lit(1)).alias("keys")).orderBy(F.desc("size")).collect():
        taken += row["keys"]
        if taken > KEYS:
            break
        least = row["size"]
    chosen = (sized.where(F.col("size") >= least) if least is not None else sized.where("false")).select(key, count).toArrow()
    keys = chosen.column(0).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    content = keys[order].tobytes() + chosen.column(1).to_numpy()[order].astype("<i8").tobytes()
    return share_file(counts.sparkSession, f"counts-{key}", content)


class Counts:
    def __init__(self, name: str):
        both = np.memmap(SparkFiles.get(name), dtype=np.uint64, mode="r") if _size(name) else np.zeros(0, np.uint64)
        self.keys, self.counts = both[: len(both) // 2], both[len(both) // 2 :].view(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the keys, 0 for those that are not in the table."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.counts[at], 0)


def _size(name: str) -> int:
    with open(SparkFiles.get(name), "rb") as file:
        return file.seek(0, 2)
