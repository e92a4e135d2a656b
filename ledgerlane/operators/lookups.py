"""Left lookups from a large fact into dimensions, and the row copies duplicate keys cause."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions import quoted, ref
from ledgerlane.operators.quality import duplicate_keys

SALT = "__salt"
HOT_KEY = "__hot_key"
SALTS = "__salts"
MEET = "__meet"
SIDE = "__side"
HAS_KEY = "__has_key"
LINE = "__line"
BROADCAST_BYTES = 64 * 1024 * 1024
# The sketch returns so many keys, and counts so many to find them, which bounds what a task sends of
# each to some 200 KB. A key that is not among them has less than a thousandth of the rows; what skew it
# still causes is left to Spark's splitting.
HOT_KEYS_KEPT = 1000
KEYS_COUNTED = 12_000
# A key with more rows than one task should read is hot, and gets a salt per so many rows.
ROWS_PER_TASK = 4_000_000
# Rows without a key match nothing, so they can be spread as far as there are tasks.
NULL_PARTS = 1 << 20


@dataclass(frozen=True, eq=False)
class Dimension:
    """A table to look up by `key`, with what is known about it. Unknown means not assumed."""

    df: DataFrame
    key: str
    unique: bool = False  # no key occurs twice (null keys never match and do not count)
    small: bool = False  # its measured size fits a broadcast
    hot: Mapping[Any, int] = field(default_factory=dict)  # frequent fact keys -> number of salts
    few_repeated: bool = False  # its repeated keys with their counts fit a broadcast

    def of(self, df: DataFrame) -> Dimension:
        """Same knowledge about a narrower or renamed version of the table."""
        return replace(self, df=df)


def dimension(table: DataFrame | Dimension, key: str) -> Dimension:
    return table if isinstance(table, Dimension) else Dimension(table, key)


def run_measure(
    *tables: tuple[DataFrame, str],
    fact: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> list[Dimension]:
    """Dimensions with measured size and key uniqueness; one job over all (table, key) pairs.

    Given the `fact`, one more job finds its hot keys for tables too large to broadcast, if any.
    """
    measures = []
    for number, (df, key) in enumerate(tables):
        # Each repeated key has a row more than needed at least, so there are no more such keys than surplus rows.
        size, surplus = F.sum(row_bytes(df)), F.count(ref(key)) - F.count_distinct(ref(key))
        counted = F.max(row_bytes(df.select(ref(key)))) + 16
        measures.append(
            df.agg(F.lit(number).alias("number"), size.alias("bytes"), surplus.alias("surplus"), counted.alias("counted"))
        )
    found = sorted(reduce(DataFrame.union, measures).collect())  # one row per table
    known = [
        Dimension(
            df,
            key,
            unique=row["surplus"] == 0,
            small=(row["bytes"] or 0) <= limit,
            few_repeated=row["surplus"] * (row["counted"] or 0) <= limit,
        )
        for (df, key), row in zip(tables, found)
    ]
    large = [table.key for table in known if not table.small]
    hot = run_hot_keys(fact, large, rows_per_task) if fact is not None and large else {}
    return [replace(table, hot=hot.get(table.key, {})) for table in known]


def run_measure_unique(table: DataFrame, key: str, limit: int = BROADCAST_BYTES) -> Dimension:
    """A table known to hold each key once, with its measured size.

    Where all columns have a fixed width the number of rows tells it, which a written table has at hand.
    """
    fixed = not any(
        isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in table.schema
    )
    size = table.count() * (16 + 16 * len(table.columns)) if fixed else table.agg(F.sum(row_bytes(table))).first()[0]
    return Dimension(table, key, unique=True, small=(size or 0) <= limit)


def row_bytes(df: DataFrame) -> Column:
    """Approximate bytes of a row: texts by their length, arrays, maps and structs by their JSON text
    twice over, everything else by a fixed width."""
    total = F.lit(16).cast("bigint")
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + 8 + F.coalesce(F.octet_length(ref(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + 16 + 2 * F.coalesce(F.octet_length(F.to_json(ref(f.name))), F.lit(0))
        else:
            total = total + 16
    return total


def left_lookup(fact: DataFrame, table: Dimension) -> DataFrame:
    """`fact LEFT JOIN table USING (key)`; every fact row stays, duplicate keys fan out.

    A measured small table is broadcast. Otherwise Spark chooses by its own statistics and splits
    skewed partitions at run time. Where keys are known to be hot, their fact rows and rows
    without a key are spread by a salt, and only the table rows of those keys are repeated.
    """
    return _match(fact, table, "left")


def can_meet(fact: DataFrame, key: str) -> bool:
    """Whether `meeting` takes this key: whole numbers and texts can stand in for a missing one."""
    return isinstance(fact.schema[key].dataType, (T.LongType, T.StringType))


def meeting(fact: DataFrame, key: str) -> DataFrame:
    """The fact shuffled by its key once, for a lookup of what is summed from these same rows.

    Rows without a key go anywhere and have HAS_KEY false. All columns lie in one that is opened behind the
    shuffle, so that Spark asks less of it for neither reader and sees that it is the same for both.
    """
    others = [f for f in fact.schema if f.name != key]
    kind = fact.schema[key].dataType
    # Not pmod, which might be null: what may be null is filtered before the shuffle for one of the readers only.
    anywhere = F.xxhash64(*map(_hashable, others)).bitwiseAND(F.lit(NULL_PARTS - 1).cast("bigint")).cast(kind)
    columns = [*[ref(f.name) for f in others], ref(key).isNotNull().alias(HAS_KEY)]
    shuffled = fact.select(F.coalesce(ref(key), anywhere).alias(MEET), F.struct(*columns).alias(LINE)).repartition(MEET)
    return shuffled.select(MEET, F.inline(F.array(LINE)))


def rows_met(met: DataFrame, key: str) -> DataFrame:
    """The rows with a key, where they meet."""
    return met.where(HAS_KEY).withColumnRenamed(MEET, key).drop(HAS_KEY)


def left_lookup_met(met: DataFrame, table: Dimension) -> DataFrame:
    """`left_lookup` for what `meeting` returned."""
    side = table.df.withColumnRenamed(table.key, SIDE)
    joined = met.join(side, (F.col(MEET) == F.col(SIDE)) & F.col(HAS_KEY), "left")
    return joined.withColumn(table.key, F.when(F.col(HAS_KEY), F.col(MEET))).drop(MEET, SIDE, HAS_KEY)


def orphans(fact: DataFrame, reference: DataFrame | Dimension, keys: str | Sequence[str]) -> DataFrame:
    """Fact rows whose key is absent from the reference; a null key is always absent.

    A single-key reference may be a `Dimension`, and is then broadcast or salted like a lookup.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    table = reference if isinstance(reference, Dimension) else Dimension(reference, names[0])
    known = table.df.select(*[ref(k) for k in names])
    if len(names) > 1 or not (table.small or table.hot):
        # Left as a plain shuffled table: behind a distinct, Spark could not split a hot fact key.
        return fact.join(known, names, "left_anti")
    return _match(fact, table.of(known if table.unique else known.distinct()), "left_anti")


def _match(fact: DataFrame, table: Dimension, how: str) -> DataFrame:
    if table.small:
        return fact.join(F.broadcast(table.df), table.key, how)
    if not table.hot:
        return fact.join(table.df, table.key, how)
    # At most HOT_KEYS_KEPT keys with their salts, looked up by hash on both sides.
    kind = next(f.dataType for f in fact.schema if f.name == table.key)
    fields = [T.StructField(HOT_KEY, kind), T.StructField(SALTS, T.IntegerType())]
    hot = F.broadcast(fact.sparkSession.createDataFrame(list(table.hot.items()), T.StructType(fields)))
    known = F.coalesce(F.col(SALTS), F.lit(1))
    fact_salts = F.when(ref(table.key).isNull(), F.lit(NULL_PARTS)).otherwise(known)
    # Hashing the row, unlike a random salt, gives a rerun task the same answer. Exact copies of a
    # row share a salt; very many of them are split by Spark when it reads the shuffle.
    spread = F.pmod(F.xxhash64(*[_hashable(f) for f in fact.schema]), fact_salts).cast("int")
    salted_fact = fact.join(hot, fact[quoted(table.key)] == hot[HOT_KEY], "left").withColumn(SALT, spread).drop(HOT_KEY, SALTS)
    salted_table = (
        table.df.join(hot, table.df[quoted(table.key)] == hot[HOT_KEY], "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0), known - 1)))
        .drop(HOT_KEY, SALTS)
    )
    return salted_fact.join(salted_table, [table.key, SALT], how).drop(SALT)


def _hashable(field: T.StructField) -> Column:
    """The column, as text where it may hold a map."""
    nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(ref(field.name)) if nested else ref(field.name)


def heavy_hitters(key: str, kept: int = HOT_KEYS_KEPT) -> Column:
    """Aggregate: the most frequent keys as array<struct<item,count>>, from a mergeable sketch.

    Bounded however many keys there are. It only decides which keys are salted; results do not depend on it.
    Not for `observe`: each task would send its whole sketch to the driver.
    """
    return F.call_function("approx_top_k", ref(key), F.lit(kept), F.lit(KEYS_COUNTED))


def key_hash(key: str) -> Column:
    return F.when(ref(key).isNotNull(), F.xxhash64(ref(key)))


def heavy_hashes(key: str, kept: int = HOT_KEYS_KEPT) -> Column:
    """Like `heavy_hitters`, by the hashes of the keys: numbers cost a sketch less than texts do."""
    return F.call_function("approx_top_k", key_hash(key), F.lit(kept), F.lit(KEYS_COUNTED))


def run_keys_of_hashes(fact: DataFrame, key: str, hot: Mapping[int, int]) -> dict[Any, int]:
    """The keys behind hot hashes, of which there are a bounded number; one pass over the key column if there are any."""
    if not hot:
        return {}
    hashed = fact.select(ref(key).alias("item"), key_hash(key).alias("hash"))
    found = {row["hash"]: row["item"] for row in hashed.where(F.col("hash").isin(list(hot))).distinct().collect()}
    return {found[number]: salts for number, salts in hot.items() if number in found}


def run_hot_keys_by_hash(fact: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> dict[str, dict[Any, int]]:
    """Like `run_hot_keys` where the keys are texts: one pass over their hashes, one more for a key that has hot ones."""
    if not keys:
        return {}
    found = fact.agg(*[heavy_hashes(k).alias(k) for k in keys]).first()
    return {k: run_keys_of_hashes(fact, k, hot_keys(found[k], rows_per_task)) for k in keys}


def hot_keys(hitters: Sequence[Any], rows_per_task: int = ROWS_PER_TASK) -> dict[Any, int]:
    """Keys with more than `rows_per_task` rows, with a salt for each that many."""
    return {
        h["item"]: math.ceil(h["count"] / rows_per_task)
        for h in hitters or []
        if h["item"] is not None and h["count"] > rows_per_task
    }


def run_hot_keys(
    fact: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> dict[str, dict[Any, int]]:
    """One pass over the fact's key columns; combines on the map side, returns a bounded answer."""
    found = fact.agg(*[heavy_hitters(k).alias(k) for k in keys]).first()
    return {k: hot_keys(found[k], rows_per_task) for k in keys}


def with_copies(fact: DataFrame, tables: Sequence[Dimension], name: str = "copies") -> DataFrame:
    """How often the left lookups of `tables` would repeat each fact row, without doing them.

    Only keys that occur twice or more are joined, usually a handful. Sums and averages over the
    fanned-out rows then become weighted ones over the fact, and no pairs are ever produced.
    """
    product = F.lit(1).cast("bigint")
    helpers = []
    for number, table in enumerate(tables):
        helper = f"__copies_{number}"
        helpers.append(helper)
        repeated = duplicate_keys(table.df.filter(ref(table.key).isNotNull()), [table.key], helper)
        fact = left_lookup(fact, replace(table.of(repeated), small=table.small or table.few_repeated))
        product = product * F.coalesce(F.col(helper), F.lit(1))
    return fact.withColumn(name, product).drop(*helpers)
