"""Result tables: append each run's rows under one task id, read them back.

The original wrote each result set to a database in one batch from the driver
and drew a fresh random id per row in two of its three writers.  Here one
``task_id`` names a whole run, rows are written by the executors in
parallel, and a failed write raises instead of being printed and dropped.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickscope import schemas

TASK_ID = "task_id"
_VERSION = "version"
_FOLDER_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def new_task_id() -> str:
    return str(uuid.uuid4())


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    """Prefix every row with the run's id (one literal, no per-row UUID)."""
    return df.select(F.lit(task_id).alias(TASK_ID), *[F.col(c) for c in df.columns])


# Column layout of each result table, in the original insert order.
RESULT_COLUMNS = {
    name: [f.name for f in schema.fields if f.name != TASK_ID]
    for name, schema in schemas.RESULT_SCHEMAS.items()
}


def as_result(name: str, df: DataFrame) -> DataFrame:
    """Project a job's output onto the columns of result table ``name``."""
    schema = schemas.RESULT_SCHEMAS[name]
    return df.select(
        [F.col(f.name).cast(f.dataType) for f in schema.fields if f.name != TASK_ID]
    )


@dataclass(frozen=True)
class ResultStore:
    """Result tables as folders under one shared root, each run whole or absent.

    A write goes to a staged folder of its own,
    ``<root>/<table>/task_id=<id>/version=<new>``, and counts only when its
    commit marker, one row in ``<root>/_commits/<table>``, is there.  Readers
    take the version that each task id committed last.  So a write that fails
    midway leaves the run before it readable, a reader never meets half a run,
    re-running under the same id leaves the last run's rows (none, if it had
    none), and other runs are never touched.
    """

    root: str
    format: str = "parquet"

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _commits(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_commits/{name}"

    def stage(self, name: str, df: DataFrame, task_id: str) -> str:
        """Write ``df`` as a new version of the run; nobody reads it yet."""
        if not _FOLDER_NAME.fullmatch(task_id):
            raise ValueError(f"task id {task_id!r} cannot name a folder")
        version = uuid.uuid4().hex
        df.write.format(self.format).save(f"{self.path(name)}/{TASK_ID}={task_id}/{_VERSION}={version}")
        return version

    def commit(self, spark: SparkSession, name: str, task_id: str, version: str) -> None:
        """Make a staged version the run's: one file, there or not there."""
        marker = spark.range(1).select(
            F.lit(task_id).alias(TASK_ID), F.lit(version).alias(_VERSION), F.lit(time.time_ns()).alias("at")
        )
        marker.coalesce(1).write.mode("append").parquet(self._commits(name))

    def append(self, name: str, df: DataFrame, task_id: str) -> None:
        self.commit(df.sparkSession, name, task_id, self.stage(name, df, task_id))

    def committed(self, spark: SparkSession, name: str) -> DataFrame:
        """``task_id, version``: what each run committed last."""
        markers = spark.read.schema(f"{TASK_ID} string, {_VERSION} string, at long").parquet(self._commits(name))
        return markers.groupBy(TASK_ID).agg(F.expr(f"max_by({_VERSION}, struct(at, {_VERSION})) as {_VERSION}"))

    def read(self, spark: SparkSession, name: str, task_id: str | None = None) -> DataFrame:
        schema = schemas.RESULT_SCHEMAS.get(name)
        versions = self.committed(spark, name)
        if task_id is not None:
            versions = versions.where(F.col(TASK_ID) == F.lit(task_id))
        reader = spark.read.format(self.format)
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField(_VERSION, T.StringType())]))
        df = reader.load(self.path(name))
        if task_id is not None:
            df = df.where(F.col(TASK_ID) == F.lit(task_id))
        columns = [f.name for f in schema.fields] if schema is not None else [c for c in df.columns if c != _VERSION]
        # one row for each run, so the join prunes folders
        return df.join(versions, [TASK_ID, _VERSION], "left_semi").select(*columns)

    def prune(self, spark: SparkSession, name: str) -> int:
        """Delete versions that are not, or no longer, committed; how many.

        Not while another process may still write or read an older version.
        """
        keep = {(r[TASK_ID], r[_VERSION]) for r in self.committed(spark, name).collect()}  # a row for each run
        jvm = spark.sparkContext._jvm
        hadoop = jvm.org.apache.hadoop.fs.Path(self.path(name))
        files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        gone = 0
        for found in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/{TASK_ID}=*/{_VERSION}=*")):
            folder = found.getPath()
            run, version = folder.getParent().getName().split("=", 1)[1], folder.getName().split("=", 1)[1]
            if (run, version) not in keep:
                files.delete(folder, True)
                gone += 1
        return gone


@dataclass(frozen=True)
class JdbcResultStore:
    """Result tables in a relational database, written over JDBC.

    The result tables exist beforehand, as the original's did.  A run's rows
    (a top-k or one row for each step of the flow) are written by one task, in
    one transaction, so they are there whole or not at all; an id that has
    rows already is refused, so a re-run takes a new id and never doubles rows.
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    batch_size: int = 1000

    def append(self, name: str, df: DataFrame, task_id: str) -> None:
        props = dict(self.properties)
        props.setdefault("batchsize", str(self.batch_size))
        if not self.read(df.sparkSession, name, task_id).isEmpty():
            raise ValueError(f"{name} has rows of task {task_id!r} already")
        with_task_id(df, task_id).coalesce(1).write.jdbc(self.url, name, mode="append", properties=props)

    def read(self, spark: SparkSession, name: str, task_id: str | None = None) -> DataFrame:
        df = spark.read.jdbc(self.url, name, properties=dict(self.properties))
        if task_id is not None:
            # A plain comparison, pushed into the database's WHERE clause.
            df = df.where(F.col(TASK_ID) == F.lit(task_id))
        return df


def publish_table(
    df: DataFrame, name: str, partition_by: list[str] | None = None, location: str | None = None
) -> str:
    """Q13: make ``df`` what readers of ``name`` see; returns the version's own name.

    The rows are written as a new table ``<name>__v_<id>``, and only when that
    is whole does the view ``name`` switch to it, one change in the catalog.  So
    no reader meets a dropped table, and a failed publish keeps the old version.
    ``location`` is a folder for the versions (default: managed tables in the
    warehouse).  A table of that name becomes the first version.
    """
    spark = df.sparkSession
    version = f"{name}__v_{uuid.uuid4().hex[:12]}"
    writer = df.write.format("parquet")
    if location is not None:
        writer = writer.option("path", f"{location.rstrip('/')}/{version.rpartition('.')[2]}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(version)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__v_{uuid.uuid4().hex[:12]}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    return version


def drop_old_versions(spark: SparkSession, name: str, current: str) -> int:
    """Drop every version of ``name`` but ``current``; how many.  Not while
    readers of an older one may still run."""
    database, _, table = name.rpartition(".")
    mark, keep = f"{table}__v_", current.rpartition(".")[2]
    found = spark.catalog.listTables(database or None, f"{mark}*")
    old = [t.name for t in found if t.name.startswith(mark) and t.name != keep]
    for t in old:
        spark.sql(f"DROP TABLE {database + '.' if database else ''}{t}")
    return len(old)


def preview(df: DataFrame, rows: int = 100) -> DataFrame:
    """The first rows of a table, for a look (the original showed 100)."""
    return df.limit(rows)
