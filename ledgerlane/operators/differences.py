"""What changed between two loads of a table: rows with their number of copies, and columns by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions import ref

COPIES = "copies"


def _plain(field: T.StructField) -> Column:
    """The column, as JSON where it can't be grouped."""
    return F.to_json(ref(field.name)) if isinstance(field.dataType, (T.MapType, T.VariantType)) else ref(field.name)


def _row_hash(df: DataFrame, seed: int) -> Column:
    """A null and the next column's value are no other null's and value's: which columns are null is hashed too."""
    plain = [_plain(f) for f in df.schema]
    nulls = F.concat(*[F.when(c.isNull(), "0").otherwise("1") for c in plain])
    return F.xxhash64(F.lit(seed), nulls, *plain)


def row_differences(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that one load has more often than the other, with the difference in `copies`: above 0 if the new one has.

    As EXCEPT ALL in both directions: nulls are equal, copies count. First only a hash of 128 bits and a
    number per different row are shuffled, combined on the map side; rows are read again where numbers
    differ, and compared in full. Columns go by name and need the same types.
    """
    kinds = {f.name: f.dataType for f in old.schema}
    if kinds != {f.name: f.dataType for f in new.schema}:
        raise ValueError("Both loads need the same columns and types")
    if COPIES in kinds:
        raise ValueError(f"Rows can't have a column {COPIES}")
    new = new.select(*map(ref, old.columns))

    def hashed(df: DataFrame, sign: int) -> DataFrame:
        return df.withColumns({"__h1": _row_hash(df, 1), "__h2": _row_hash(df, 2), COPIES: F.lit(sign).cast("long")})

    both = hashed(old, -1).union(hashed(new, 1))
    numbers = both.groupBy("__h1", "__h2").agg(F.sum(COPIES).alias("__n")).where("__n <> 0").drop("__n")
    changed = both.join(numbers, ["__h1", "__h2"], "left_semi")
    grouped = [_plain(f).alias(f"__g{i}") for i, f in enumerate(old.schema)]
    whole = F.any_value(F.struct(*map(ref, old.columns))).alias("__row")
    return changed.groupBy(*grouped).agg(whole, F.sum(COPIES).alias(COPIES)).where(F.col(COPIES) != 0).select("__row.*", COPIES)


def key_changes(old: DataFrame, new: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """(keys, change, removed, added, columns): for every key with a difference what became of it.

    `change` is "added" or "removed" if one of the loads lacks the key, else "changed"; `removed` and `added`
    count rows, copies included, that only one of them has. `columns` are those whose values, with their
    number, differ among these rows. Keys may repeat and be null.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    others = [f for f in old.schema if f.name not in names]
    found = row_differences(old, new)
    weight = F.col(COPIES).cast("decimal(18,0)")
    # Values of one number on both sides cancel out.
    sums = [F.sum(F.xxhash64(F.lit(7), _plain(f).isNull(), _plain(f)).cast("decimal(20,0)") * weight).alias(f"__d{i}") for i, f in enumerate(others)]
    by_key = found.groupBy(*map(ref, names)).agg(
        F.sum(F.when(F.col(COPIES) < 0, -F.col(COPIES)).otherwise(0)).alias("removed"),
        F.sum(F.when(F.col(COPIES) > 0, F.col(COPIES)).otherwise(0)).alias("added"),
        *sums,
    )
    listed = F.array_compact(F.array(*[F.when(F.col(f"__d{i}") != 0, F.lit(f.name)) for i, f in enumerate(others)]).cast("array<string>"))

    def held(df: DataFrame, name: str) -> DataFrame:
        """Of the changed keys those that a load has, without their rows."""
        aliases = [f"__{name}_{i}" for i in range(len(names))]
        asked = by_key.select(*[ref(k).alias(a) for k, a in zip(names, aliases)])
        same = reduce(and_, [ref(k).eqNullSafe(F.col(a)) for k, a in zip(names, aliases)])
        return df.join(asked, same, "left_semi").select(*[ref(k).alias(a) for k, a in zip(names, aliases)]).distinct().withColumn(name, F.lit(True))

    for name, df in (("was", old), ("is", new)):
        known = held(df, name)
        same = reduce(and_, [ref(k).eqNullSafe(F.col(f"__{name}_{i}")) for i, k in enumerate(names)])
        by_key = by_key.join(known, same, "left").drop(*[f"__{name}_{i}" for i in range(len(names))])
    change = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").otherwise("changed")
    return by_key.select(*map(ref, names), change.alias("change"), "removed", "added", listed.alias("columns"))
