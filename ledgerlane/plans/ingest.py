"""Files to clean tables, a quarantine table and quality reports."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession

from ledgerlane.contracts import CONTRACTS, DatasetContract
from ledgerlane.operators.key_filters import run_orphans
from ledgerlane.operators.lookups import Dimension, orphans, run_hot_keys_by_hash, run_measure
from ledgerlane.operators.rules import ReadableRule
from ledgerlane.operators.quality import (
    duplicate_rows,
    evaluate,
    null_counts,
    quarantine,
    rule_counters,
    valid,
    without_raw_of_valid,
    without_values_of_rejected,
)
from ledgerlane.operators.shape import conform
from ledgerlane.settings import Settings
from ledgerlane.sinks import all_batches, stage, staging_folder, write_batch, write_table
from ledgerlane.sources import read_dataset
from ledgerlane.sources.files import CORRUPT

# Columns of a dataset that later serve as lookup keys.
LOOKUP_KEYS = {"orders": ("customer_id", "product_id")}


@dataclass
class Ingested:
    """One dataset after ingestion. The frames are lazy and read written tables."""

    contract: DatasetContract
    table: str
    clean: DataFrame
    counts: dict[str, int]
    duplicates: DataFrame
    nulls: DataFrame
    quarantine: DataFrame
    hot: dict[str, dict[Any, int]] = field(default_factory=dict)


def _write(df: DataFrame, name: str, path: str | None, batch: str | None) -> DataFrame:
    """The table after this load: of its rows only, or, if loads are named, of all loads."""
    if batch is None:
        write_table(df, name, path=path)
        return df.sparkSession.table(name)
    write_batch(df, name, batch, path=path)
    return all_batches(df.sparkSession, name)


def ingest(
    spark: SparkSession, contract: DatasetContract, settings: Settings, staging: str | None = None
) -> Ingested:
    """Reads a source once and writes its clean table, or its batch of that table if the load is named and the table grows.

    The source text is parsed in a single pass into a staged table that carries the verdicts;
    row and rule counters are observed on the way. Everything after that reads columns of the staged
    table, also the frequent lookup keys: their sketches are merged by a task, the driver gets the keys
    with more rows than a task should read. Counts, repeated keys, rejected rows and hot keys are those of
    this load; the clean table, and the nulls counted in it, are of all loads.
    """
    source = read_dataset(
        spark,
        settings.sources[contract.name],
        contract,
        fmt=settings.formats.get(contract.name),
        **settings.read_options.get(contract.name, {}),
    )
    rules = ([ReadableRule(CORRUPT)] if CORRUPT in source.columns else []) + list(contract.rules)
    flagged = evaluate(source, rules)
    keys = LOOKUP_KEYS.get(contract.name, ())
    seen = Observation(f"ingest {contract.name}")
    observed = flagged.observe(seen, *rule_counters(rules))
    needed = without_values_of_rejected(without_raw_of_valid(observed), contract.rules_after_key_report)
    staged = stage(needed, f"{staging or staging_folder(spark)}/{contract.name}")
    counts = dict(seen.get)
    # Keys without a valid row need no salt: the clean table does not hold them.
    hot = run_hot_keys_by_hash(valid(staged), keys)

    table = settings.table(contract.name)
    batch = settings.batch if contract.name in settings.growing else None
    clean = _write(conform(valid(staged), contract.schema), table, settings.path(contract.name), batch)
    keyed = conform(valid(staged, contract.rules_after_key_report), contract.schema)
    return Ingested(
        contract=contract,
        table=table,
        clean=clean,
        counts=counts,
        duplicates=duplicate_rows(keyed, contract.keys),
        nulls=null_counts(clean),
        quarantine=quarantine(staged, contract.name),
        hot=hot,
    )


@dataclass
class Store:
    """The three ingested datasets, ready for enrichment."""

    orders: Ingested
    customers: Ingested
    products: Ingested
    _dimensions: tuple[Dimension, Dimension] | None = field(default=None, repr=False)

    def missing_products(self) -> DataFrame:
        return self._missing(self.dimensions()[1])

    def missing_customers(self) -> DataFrame:
        return self._missing(self.dimensions()[0])

    def _missing(self, table: Dimension) -> DataFrame:
        """Order lines whose key a dimension lacks; lines are shuffled for none, however large it is."""
        if table.small:
            return orphans(self.orders.clean, table, table.key)
        return run_orphans(self.orders.clean, table.df, table.key)

    def dimensions(self) -> tuple[Dimension, Dimension]:
        """Customers and products with their measured size and the orders' hot keys; a job the first time."""
        if self._dimensions is None:
            self._dimensions = self._run_dimensions()
        return self._dimensions

    def _run_dimensions(self) -> tuple[Dimension, Dimension]:
        measured = run_measure((self.customers.clean, "customer_id"), (self.products.clean, "product_id"))
        customers, products = (d if d.small else replace(d, hot=self.orders.hot[d.key]) for d in measured)
        return customers, products


def run_ingest(spark: SparkSession, settings: Settings) -> Store:
    """Ingests all three datasets.

    Without a name for the load all tables are replaced; with one, of growing tables and the quarantine only
    what a load of that name wrote before. Either way a rerun repeats no rows.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {settings.catalog}.{settings.schema}")
    staging = staging_folder(spark)
    store = Store(**{name: ingest(spark, contract, settings, staging) for name, contract in CONTRACTS.items()})
    rejected = store.orders.quarantine.union(store.customers.quarantine).union(store.products.quarantine)
    _write(rejected, settings.quarantine_table, settings.path("quarantine"), settings.batch)
    return store
