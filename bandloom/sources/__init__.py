from .extract import export_query
from .files import read_rows, read_table, write_table
from .metadata import Metadata, load_metadata
from .store import BenchmarkStore

__all__ = [
    "BenchmarkStore",
    "Metadata",
    "export_query",
    "load_metadata",
    "read_rows",
    "read_table",
    "write_table",
]
