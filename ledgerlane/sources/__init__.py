from ledgerlane.sources.files import read_dataset, read_files
from ledgerlane.sources.workbooks import decode_workbooks, read_workbooks

__all__ = ["decode_workbooks", "read_dataset", "read_files", "read_workbooks"]
