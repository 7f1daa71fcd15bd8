"""Store the four tables once, for a caller who will run many jobs on them.

The original application wrote its four tables once (a generator saved them
to the metastore) and every job then read them by name.  This is the same
step for tables derived from a folder of driver files: they are written as
parquet under the session's shared checkpoint folder, laid out by ``date``.
It is optional and explicit; jobs and registered queries work on any
``ClickstreamTables``, derived or stored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from clickscope.session import ensure_checkpoint_dir
from clickscope.sources.adapter import from_driver_tables
from clickscope.sources.tables import ClickstreamTables, read_parquet_tables, write_parquet_tables


def prepare_driver_tables(spark: SparkSession, sf_dir: str) -> ClickstreamTables:
    """Derive the tables from ``sf_dir``, store them in a folder of their own, read them back.

    Every call writes a new folder, so what it returns is always the state of
    ``sf_dir`` at the time of the call.  Adaptive execution sizes the files.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    root = f"{base}/clickscope-tables/{uuid.uuid4().hex}"
    write_parquet_tables(from_driver_tables(spark, sf_dir), root)
    return read_parquet_tables(spark, root)
