"""Where the four clickstream tables come from."""

from clickscope.sources.adapter import from_driver_tables
from clickscope.sources.catalog import prepare_driver_tables
from clickscope.sources.jdbc import read_jdbc_table
from clickscope.sources.tables import (
    ClickstreamTables,
    along_curve,
    read_catalog_tables,
    read_parquet_tables,
    write_bucketed_tables,
    write_parquet_tables,
)

__all__ = [
    "ClickstreamTables",
    "along_curve",
    "from_driver_tables",
    "prepare_driver_tables",
    "read_catalog_tables",
    "read_jdbc_table",
    "read_parquet_tables",
    "write_bucketed_tables",
    "write_parquet_tables",
]
