from ledgerlane.sinks.batches import BATCH, all_batches, batch_rows, write_batch
from ledgerlane.sinks.staging import stage, staging_folder
from ledgerlane.sinks.tables import table_format, write_table

__all__ = ["BATCH", "all_batches", "batch_rows", "stage", "staging_folder", "table_format", "write_batch", "write_table"]
