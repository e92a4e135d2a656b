"""Exact distinct counts that can be added up over loads.

The values of a key are held as words of 64 bits, a bit per whole number. Words of several loads are
merged by OR, and a count is the number of bits. A word has one row at most per key, so a dense key
takes a bit per value, a sparse one a row per value, as a plain list would.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.functions import ref

PART, BITS = "part", "bits"
WORD_BITS = 6


def distinct_parts(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    """(keys, part, bits): the different values of each key; null values are left out, null keys are a key.

    Whole numbers share words. Values of other types are a part each, with one bit. Rows combine on the
    map side, and the words of a hot key are spread over all tasks.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    if {PART, BITS} & set(names):
        raise ValueError(f"Keys can't be named {PART} or {BITS}")
    if isinstance(df.schema[value].dataType, T.IntegralType):
        number = ref(value).cast("long")
        part = F.shiftright(number, WORD_BITS)
        bits = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND((1 << WORD_BITS) - 1).cast("int"))
    else:
        part, bits = ref(value), F.lit(1).cast("long")
    rows = df.where(ref(value).isNotNull()).select(*map(ref, names), part.alias(PART), bits.alias(BITS))
    return merge_parts(rows)


def merge_parts(*parts: DataFrame) -> DataFrame:
    """The different values of all of them together; without keys in common the rows just come together."""
    rows = reduce(DataFrame.unionByName, parts)
    keys = [c for c in rows.columns if c not in (PART, BITS)]
    return rows.groupBy(*map(ref, keys), PART).agg(F.bit_or(BITS).alias(BITS))


def distinct_counts(parts: DataFrame, name: str) -> DataFrame:
    """(keys, name) from merged parts: how many different values each key has."""
    keys = [c for c in parts.columns if c not in (PART, BITS)]
    return parts.groupBy(*map(ref, keys)).agg(F.sum(F.bit_count(BITS)).alias(name))
