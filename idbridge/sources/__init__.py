"""Readers and logical schemas of the reconciled tables."""

from idbridge.sources.readers import (BalancedRanges, CatalogTables, FixtureTables, JdbcConnection, JdbcTables,
                                      KeyRanges, ParquetTables, Partitioning, Tables)
from idbridge.sources.schemas import MEMBER_INSERT, SCHEMAS, check_schema, check_target

__all__ = ["BalancedRanges", "CatalogTables", "FixtureTables", "JdbcConnection", "JdbcTables", "KeyRanges", "ParquetTables",
           "Partitioning", "Tables", "MEMBER_INSERT", "SCHEMAS", "check_schema", "check_target"]
