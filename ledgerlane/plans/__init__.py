from ledgerlane.plans.enrichment import customer_table, fully_enriched, product_table
from ledgerlane.plans.profit import PROFIT_TABLES, profit_grains, profit_table, profit_totals
from ledgerlane.plans.sql_texts import PROFIT_SQL, profit_sql, register_view

__all__ = [
    "PROFIT_SQL",
    "PROFIT_TABLES",
    "customer_table",
    "fully_enriched",
    "product_table",
    "profit_grains",
    "profit_sql",
    "profit_table",
    "profit_totals",
    "register_view",
]
