"""Readers and writers."""

from tallymill.sources.files import read_csv, write_csv
from tallymill.sources.sharded import read_sharded, write_sharded
from tallymill.sources.tables import describe_schema, load_table, preview, register_tables

__all__ = [
    "describe_schema",
    "load_table",
    "preview",
    "read_csv",
    "read_sharded",
    "register_tables",
    "write_csv",
    "write_sharded",
]
