"""Reading and writing: CSV in and out, and the layer tables as versioned Parquet folders."""

from triptych.sources.csv import LOST, MALFORMED, read_csv, write_csv
from triptych.sources.layers import (
    StoredTable,
    create_table,
    manifest,
    publish_tables,
    read_table,
    read_tables,
    stage_table,
    stored_counts,
    table_path,
    write_table,
)

__all__ = [
    "LOST",
    "MALFORMED",
    "StoredTable",
    "create_table",
    "manifest",
    "publish_tables",
    "read_csv",
    "read_table",
    "read_tables",
    "stage_table",
    "stored_counts",
    "table_path",
    "write_csv",
    "write_table",
]
