"""Key filters: what a reference certainly lacks is told without a shuffle of the lines that ask.

A filter is a table of blocks of 512 bits. A key belongs to one block and sets eight of its bits, so a
lookup is one hash join on the block. Filters of parts of a reference are merged by OR, so each load
keeps its own, and a rerun replaces it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions import ref
from ledgerlane.operators.lookups import BROADCAST_BYTES, row_bytes
from ledgerlane.sinks import all_batches, stage, staging_folder, write_batch

WORDS = [f"w{i}" for i in range(8)]
BLOCK_BITS = 64 * len(WORDS)
#: About one key in 500 that is absent looks present at so many bits a key.
BITS_PER_KEY = 12
#: Blocks of a filter at most, 64 MB of bits. With more keys it tells less, never anything wrong.
MOST_BLOCKS = 1 << 20


@dataclass(frozen=True, eq=False)
class KeyFilter:
    """(block, w0 ... w7) rows; blocks without any key are left out."""

    blocks: DataFrame
    count: int
    kinds: tuple[str, ...]  # SQL types of the keys


def blocks_for(keys: int) -> int:
    """Blocks for so many keys."""
    return min(MOST_BLOCKS, max(1, math.ceil(keys * BITS_PER_KEY / BLOCK_BITS)))


def _kinds(df: DataFrame, keys: Sequence[str]) -> tuple[str, ...]:
    kinds = {f.name: f.dataType for f in df.schema}
    for key in keys:
        if isinstance(kinds[key], (T.MapType, T.ArrayType, T.StructType)):
            raise ValueError(f"{key} is no plain key")
    return tuple(kinds[key].simpleString() for key in keys)


def _hashed(df: DataFrame, keys: Sequence[str], seed: int) -> Column:
    """Equal keys have equal hashes: both zeros of a double are one, as for a join."""
    kinds = dict(zip(keys, _kinds(df, keys)))
    plain = [ref(k) + F.lit(0).cast(kinds[k]) if kinds[k] in ("double", "float") else ref(k) for k in keys]
    return F.xxhash64(F.lit(seed), *plain)


def _block(df: DataFrame, keys: Sequence[str], count: int) -> Column:
    return F.pmod(_hashed(df, keys, 0), F.lit(count).cast("long")).cast("int")


def _masks(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    bits = _hashed(df, keys, 1)
    # Six bits of the hash choose the bit of a word.
    chosen = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(63).cast("int") for i in range(len(WORDS))]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), bit) for bit in chosen]


def _present(keys: Sequence[str]) -> Column:
    return reduce(and_, [ref(k).isNotNull() for k in keys])


def key_filter(reference: DataFrame, keys: str | Sequence[str], count: int) -> KeyFilter:
    """A filter of `count` blocks over the keys of a table; rows that lack a key match nothing and are left out.

    Combines on the map side: a task sends each block it met once.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    masks = [mask.alias(w) for w, mask in zip(WORDS, _masks(reference, names))]
    marked = reference.where(_present(names)).select(_block(reference, names, count).alias("block"), *masks)
    return KeyFilter(_merged(marked), count, _kinds(reference, names))


def _merged(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def merge_filters(*filters: KeyFilter) -> KeyFilter:
    """The filter of all their keys together."""
    first = filters[0]
    if any((f.count, f.kinds) != (first.count, first.kinds) for f in filters):
        raise ValueError("Filters of different sizes or key types can't be merged")
    return KeyFilter(_merged(reduce(DataFrame.union, [f.blocks for f in filters])), first.count, first.kinds)


def write_key_filter(found: KeyFilter, table: str, batch: str, path: str | None = None) -> None:
    """Keeps the filter of one load; a rerun of the load replaces it."""
    held = found.blocks.withColumns({"count": F.lit(found.count), "kinds": F.lit(",".join(found.kinds))})
    write_batch(held, table, batch, path=path)


def read_key_filter(spark: SparkSession, table: str) -> KeyFilter | None:
    """The filter of all loads of a table together; None before the first row."""
    held = all_batches(spark, table)
    known = held.select("count", "kinds").distinct().limit(2).collect()
    if not known:
        return None
    if len(known) > 1:
        raise ValueError(f"{table} holds filters of different sizes or key types")
    return KeyFilter(_merged(held), known[0]["count"], tuple(known[0]["kinds"].split(",")))


def with_maybe_known(fact: DataFrame, keys: Sequence[str], known: KeyFilter, name: str) -> DataFrame:
    """Adds whether the filter may hold the key; false is certain. Lines are not shuffled."""
    if _kinds(fact, keys) != known.kinds:
        raise ValueError(f"Keys are {', '.join(_kinds(fact, keys))}, those of the filter {', '.join(known.kinds)}")
    words = [f"__{w}" for w in WORDS]
    blocks = known.blocks.toDF("__block", *words)
    asked = fact.join(F.broadcast(blocks), _block(fact, keys, known.count) == F.col("__block"), "left")
    hits = [F.col(w).bitwiseAND(mask) == mask for w, mask in zip(words, _masks(fact, keys))]
    maybe = F.coalesce(reduce(and_, hits), F.lit(False)) & _present(keys)
    return asked.withColumn(name, maybe).drop("__block", *words)


def run_orphans(
    fact: DataFrame, reference: DataFrame, keys: str | Sequence[str], known: KeyFilter | None = None, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Lines whose key, of any number of columns, a reference too large to broadcast lacks; a null key is lacked.

    What the filter (made here if not given; it has to cover the whole reference) excludes is an orphan
    at once. Of all other lines only the different keys are shuffled, combined on the map side, and looked
    up in the reference. The keys that it lacks all the same are few, one in hundreds of the orphans' keys;
    they are written, measured, and broadcast to the lines, or joined if they pass `limit` bytes. Keys of
    both sides need the same types. Runs jobs over the keys.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    if known is None:
        distinct = reference.select(F.approx_count_distinct(_hashed(reference, names, 0))).first()[0]
        known = key_filter(reference, names, blocks_for(distinct))
        blocks = stage(known.blocks, f"{staging_folder(fact.sparkSession)}/key_filter")
        known = KeyFilter(blocks, known.count, known.kinds)
    maybe = "__maybe"
    flagged = with_maybe_known(fact, names, known, maybe)
    asked = flagged.where(F.col(maybe)).select(*map(ref, names)).distinct()
    lacking = asked.join(reference.select(*map(ref, names)), names, "left_anti")
    lacking = stage(lacking, f"{staging_folder(fact.sparkSession)}/lacking_keys")
    size = lacking.agg(F.sum(row_bytes(lacking))).first()[0] or 0
    aliases = [f"__key_{i}" for i in range(len(names))]
    keyed = lacking.toDF(*aliases).withColumn("__lacking", F.lit(True))
    same = reduce(and_, [ref(k) == F.col(a) for k, a in zip(names, aliases)])
    joined = flagged.join(F.broadcast(keyed) if size <= limit else keyed, same, "left")
    return joined.where(~F.col(maybe) | F.col("__lacking")).drop(maybe, "__lacking", *aliases)
