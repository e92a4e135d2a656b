from ledgerlane.operators.key_filters import (
    KeyFilter,
    blocks_for,
    key_filter,
    merge_filters,
    read_key_filter,
    run_orphans,
    write_key_filter,
)
from ledgerlane.operators.lookups import (
    Dimension,
    left_lookup,
    orphans,
    run_hot_keys,
    run_measure,
    run_measure_unique,
    with_copies,
)
from ledgerlane.operators.measures import order_info, order_measures, wide_fact
from ledgerlane.operators.metrics import customer_metrics, product_metrics, summarize
from ledgerlane.operators.quality import (
    duplicate_keys,
    duplicate_rows,
    evaluate,
    keys_are_unique,
    null_counts,
    null_counts_wide,
    quarantine,
    rejected,
    run_has_rows,
    run_null_report,
    split,
    valid,
)
from ledgerlane.operators.rules import CompareColumnsRule, CompareRule, EmailRule, Rule, ReadableRule, TypeRule
from ledgerlane.operators.shape import conform

__all__ = [
    "CompareColumnsRule",
    "CompareRule",
    "Dimension",
    "EmailRule",
    "KeyFilter",
    "Rule",
    "ReadableRule",
    "TypeRule",
    "blocks_for",
    "conform",
    "customer_metrics",
    "duplicate_keys",
    "duplicate_rows",
    "evaluate",
    "key_filter",
    "keys_are_unique",
    "left_lookup",
    "merge_filters",
    "null_counts",
    "null_counts_wide",
    "order_info",
    "order_measures",
    "orphans",
    "product_metrics",
    "quarantine",
    "read_key_filter",
    "rejected",
    "run_hot_keys",
    "run_measure",
    "run_measure_unique",
    "run_has_rows",
    "run_orphans",
    "run_null_report",
    "split",
    "summarize",
    "valid",
    "wide_fact",
    "write_key_filter",
    "with_copies",
]
