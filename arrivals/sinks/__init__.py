"""Sinks: layout-aware Parquet writes and warehouse table loads."""

from arrivals.sinks.parquet import (
    write_by_column,
    write_by_copy,
    write_fact,
    write_new,
    write_overwrite,
    write_partitioned,
)
from arrivals.sinks.tables import Warehouse

__all__ = [
    "Warehouse", "write_by_column", "write_by_copy", "write_fact", "write_new",
    "write_overwrite", "write_partitioned",
]
