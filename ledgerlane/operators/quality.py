"""Data-quality operators: rule evaluation, quarantine, key, null and reference reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.functions import quoted, ref
from ledgerlane.operators.rules import Rule, TypeRule

RAW = "_raw"
FAILED_RULES = "failed_rules"
FIRST_FAILED = "first_failed_rule"

# A key with this many rows is worth keeping out of a shuffle.
HOT_ROWS = 4_000_000
# At most so many such keys are broadcast.
HOT_KEYS_SENT = 10_000


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds typed values, `failed_rules`, `first_failed_rule` and the untouched row in `_raw`.

    One projection serves every rule and both sides of the split: the verdicts come out of a
    generator, which the optimizer neither copies into later filters nor evaluates twice. Rules keep
    their order, so `first_failed_rule` is the rule that would have caught the row had they run one
    after another. Rules of one name are one rule that needs all their conditions.
    """
    typed: dict[str, Column] = {}
    for rule in rules:
        if isinstance(rule, TypeRule):
            typed[rule.column] = rule.parse(df.schema[rule.column].dataType).alias(rule.column)
    shaped = df.select(
        F.struct(*[ref(c) for c in df.columns]).alias(RAW),
        *[typed.get(c, ref(c)) for c in df.columns],
    )
    if not rules:
        return shaped.withColumns(
            {FAILED_RULES: F.array().cast("array<string>"), FIRST_FAILED: F.lit(None).cast("string")}
        )
    met: dict[str, Column] = {}
    for rule in rules:
        ok = F.coalesce(rule.condition(shaped.schema), F.lit(False))
        met[rule.name] = met[rule.name] & ok if rule.name in met else ok
    # array_remove and coalesce both compile; a filtering lambda would drop out of codegen.
    failed = F.array_remove(F.array(*[F.when(ok, "").otherwise(name) for name, ok in met.items()]), "")
    first = F.coalesce(*[F.when(~ok, name) for name, ok in met.items()])
    verdict = F.struct(failed.alias(FAILED_RULES), first.alias(FIRST_FAILED))
    return shaped.select("*", F.inline(F.array(verdict)))


def valid(flagged: DataFrame, forgiving: Iterable[str] = ()) -> DataFrame:
    """Rows that met every rule; `forgiving` names rules whose failure is overlooked."""
    return flagged.filter(_passed(forgiving)).drop(RAW, FAILED_RULES, FIRST_FAILED)


def _passed(forgiving: Iterable[str]) -> Column:
    passed = F.col(FIRST_FAILED).isNull()
    forgiven = list(forgiving)
    if forgiven:
        passed = passed | (F.size(F.array_except(FAILED_RULES, F.array(*map(F.lit, forgiven)))) == 0)
    return passed


def rejected(flagged: DataFrame) -> DataFrame:
    """Rows that failed, as they were read, with their reasons."""
    return flagged.filter(F.col(FIRST_FAILED).isNotNull()).select(f"{RAW}.*", FAILED_RULES, FIRST_FAILED)


def quarantine(flagged: DataFrame, dataset: str) -> DataFrame:
    """Rejected rows in one layout for all datasets: the raw row becomes a map of texts."""
    fields = flagged.schema[RAW].dataType.fieldNames()
    pairs = [part for name in fields for part in (F.lit(name), F.col(RAW).getField(name).cast("string"))]
    return flagged.filter(F.col(FIRST_FAILED).isNotNull()).select(
        F.lit(dataset).alias("dataset"),
        FIRST_FAILED,
        FAILED_RULES,
        F.create_map(*pairs).alias("raw"),
    )


def without_raw_of_valid(flagged: DataFrame) -> DataFrame:
    """The same verdicts with the raw row kept for rejected rows only, for writing."""
    return flagged.withColumn(RAW, F.when(F.col(FIRST_FAILED).isNotNull(), F.col(RAW)))


def without_values_of_rejected(flagged: DataFrame, forgiving: Iterable[str] = ()) -> DataFrame:
    """The same verdicts with values kept only for rows that `valid` returns with the same `forgiving`, for writing."""
    kept = _passed(forgiving)
    verdicts = (RAW, FAILED_RULES, FIRST_FAILED)
    return flagged.select(*[ref(c) if c in verdicts else F.when(kept, ref(c)).alias(c) for c in flagged.columns])


def split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where the condition is true, all other rows): null counts as failed."""
    return df.filter(condition), df.filter(~F.coalesce(condition, F.lit(False)))


def rule_counters(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates for `DataFrame.observe`: rows, rows kept and rows caught first by each rule."""
    counters = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(FIRST_FAILED).isNull()).alias("kept")]
    return counters + [
        F.count_if(F.col(FIRST_FAILED).eqNullSafe(rule.name)).alias(rule.name) for rule in rules
    ]


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "copies") -> DataFrame:
    """Keys held by more than one row, null keys included, with their number of rows."""
    counted = df.groupBy(*[ref(k) for k in keys]).agg(F.count(F.lit(1)).alias(count_name))
    return counted.filter(ref(count_name) > 1)


def duplicate_rows(df: DataFrame, keys: str | Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row whose key occurs more than once; empty when the key is unique.

    Counting combines on the map side, so only one row per key and task is shuffled; rows then go
    back through a null-safe join. Rows of a key with `hot_rows` or more copies would all meet in
    one task there, even with a salt if they are exact copies. Such keys are told apart by a
    broadcast of at most HOT_KEYS_SENT of them, the most frequent, and their rows never shuffled;
    further ones are left to Spark's splitting of skewed joins.
    Helper names cannot clash with the data's own.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    aliases = [f"__key_{i}" for i in range(len(names))]
    counted = df.select(*[ref(k).alias(a) for k, a in zip(names, aliases)]).groupBy(*aliases)
    repeated = counted.agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > 1)
    by_size = [F.desc("__rows"), *aliases]
    hot = repeated.filter(F.col("__rows") >= hot_rows).orderBy(*by_size).limit(HOT_KEYS_SENT)
    sent = hot.select(*[F.col(a).alias(f"{a}_hot") for a in aliases], F.lit(True).alias("__hot"))
    told = reduce(and_, [ref(k).eqNullSafe(F.col(f"{a}_hot")) for k, a in zip(names, aliases)])
    flagged = df.join(F.broadcast(sent), told, "left").drop(*[f"{a}_hot" for a in aliases])
    same = reduce(and_, [ref(k).eqNullSafe(F.col(a)) for k, a in zip(names, aliases)])
    kept = flagged.filter("__hot").drop("__hot")
    others = flagged.filter("__hot is null").drop("__hot").join(repeated, same, "left_semi")
    return kept.union(others)


def keys_are_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """Runs a job over the key columns only."""
    return duplicate_keys(df, keys, "__rows").isEmpty()


def run_has_rows(df: DataFrame) -> bool:
    """Whether a report holds any row; the job ends at the first one it finds."""
    return not df.isEmpty()


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count) for columns that hold at least one null; one pass, lazy."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count_if(ref(c).isNull()).alias(c) for c in names])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), ref(c).alias("null_count")) for c in names]
    )
    return counted.select(F.inline(pairs)).filter(F.col("null_count") > 0)


def null_counts_wide(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with a null count for every column."""
    return df.agg(*[F.count_if(ref(c).isNull()).alias(c) for c in columns or df.columns])


def run_null_report(df: DataFrame) -> DataFrame:
    """One row holding only the columns that have nulls. Runs a job to learn which those are."""
    counts = null_counts_wide(df).first().asDict()
    kept = {name: number for name, number in counts.items() if number}
    return df.sparkSession.createDataFrame(
        [tuple(kept.values())], ", ".join(f"{quoted(name)} bigint" for name in kept)
    )
