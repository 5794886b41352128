"""Sinks: versioned Parquet tables with a catalog name, dated snapshots, ledger."""

from tabulon.sinks.tables import TableStore

__all__ = ["TableStore"]
