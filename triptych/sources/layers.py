"""The layer tables below a base URI, and the commits that say which files they are.

Every write of a table goes to a folder of its own, which nobody reads yet.  A commit
is one small numbered file with the folder and the row count of every table; readers
take the newest complete commit.  A job that stops at any point leaves the earlier
commit, and with it a whole earlier set of tables, in place.  Nothing is renamed, so
this also holds for object stores.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from triptych.config import LAYER_PATHS, REJECTS_PATH, REJECTS_TABLE
from triptych.operators import known_counts

_PATHS = {**LAYER_PATHS, REJECTS_TABLE: REJECTS_PATH}
_COMMITS = "_commits"
_ATTEMPTS = 20

#: Folders named by this many of the newest commits stay, for readers that have begun.
KEPT_COMMITS = 2


@dataclass(frozen=True)
class StoredTable:
    """A written table: its folder below the base, and its rows."""

    table: str
    folder: str
    rows: int


class _Files:
    """Small files of a folder, by the file system that its URI names."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._folder = folder
        path = self._path("")
        self._system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{name}" if name else self._folder)

    def names(self) -> list[str]:
        if not self._system.exists(self._path("")):
            return []
        return sorted(status.getPath().getName() for status in self._system.listStatus(self._path("")))

    def read(self, name: str) -> str:
        stream = self._system.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """False if the file exists already."""
        try:
            stream = self._system.create(self._path(name), False)
        except Py4JJavaError as error:
            if self._system.exists(self._path(name)):
                return False
            raise error
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def delete(self, name: str) -> None:
        self._system.delete(self._path(name), True)


def run_folder() -> str:
    """A folder name that no other run uses; names sort by time."""
    return f"run-{datetime.datetime.now(datetime.UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def table_path(base: str, table: str) -> str:
    """Where the folders of all runs of a table lie."""
    return f"{base.rstrip('/')}/{_PATHS[table]}"


def _commits(spark: SparkSession, base: str) -> tuple[_Files, list[tuple[int, dict[str, StoredTable]]], int]:
    """The folder of the commits, the complete ones from oldest to newest, and the next number."""
    files = _Files(spark, f"{base.rstrip('/')}/{_COMMITS}")
    found, following = [], 1
    for name in files.names():
        if not name.endswith(".json"):
            continue
        number = int(name.removesuffix(".json"))
        following = number + 1
        try:
            tables = json.loads(files.read(name))["tables"]
        except json.JSONDecodeError:
            continue  # its writer stopped before the end
        found.append((number, {table: StoredTable(table, **entry) for table, entry in tables.items()}))
    return files, found, following


def manifest(spark: SparkSession, base: str) -> dict[str, StoredTable]:
    """The current tables with their folders and row counts; empty before the first commit."""
    _, commits, _ = _commits(spark, base)
    return commits[-1][1] if commits else {}


def stage_table(df: DataFrame, base: str, table: str) -> StoredTable:
    """Write the table to a new folder that no reader knows yet, and count its rows meanwhile."""
    folder = f"{_PATHS[table]}/{run_folder()}"
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.option("compression", "snappy").parquet(f"{base.rstrip('/')}/{folder}")
    return StoredTable(table, folder, seen.get["rows"])


def publish_tables(
    spark: SparkSession, base: str, staged: Iterable[StoredTable], *, removed: Iterable[str] = ()
) -> dict[str, StoredTable]:
    """Make staged tables current, all at once; returns the new set of tables.

    Other tables stay as they are.  Jobs that publish at the same time follow one after
    the other: the number of a commit can be taken once only.  Folders that none of the
    newest commits names are then deleted.
    """
    staged, removed = {entry.table: entry for entry in staged}, set(removed)
    for _ in range(_ATTEMPTS):
        files, commits, number = _commits(spark, base)
        before = commits[-1][1] if commits else {}
        tables = {name: entry for name, entry in before.items() if name not in removed} | staged
        entries = {name: {"folder": entry.folder, "rows": entry.rows} for name, entry in tables.items()}
        if files.create(f"{number:012d}.json", json.dumps({"tables": entries}, indent=1)):
            _drop_old(spark, base)
            return tables
    raise RuntimeError(f"other jobs took all commit numbers below {base}")


def _drop_old(spark: SparkSession, base: str) -> None:
    files, commits, _ = _commits(spark, base)
    old, kept = commits[:-KEPT_COMMITS], commits[-KEPT_COMMITS:]
    used = {entry.folder for _, tables in kept for entry in tables.values()}
    below = _Files(spark, base.rstrip("/"))
    for folder in sorted({entry.folder for _, tables in old for entry in tables.values()} - used):
        below.delete(folder)
    # A commit goes after its folders: stopped in between, the next run finishes the work.
    for number, _ in old:
        files.delete(f"{number:012d}.json")


def read_table(spark: SparkSession, base: str, table: str) -> DataFrame:
    return read_tables(spark, base, [table])[table]


def read_tables(spark: SparkSession, base: str, tables: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Tables of one and the same commit; by default all of them."""
    current = manifest(spark, base)
    wanted = list(current) if tables is None else list(tables)
    missing = [table for table in wanted if table not in current]
    if missing:
        raise FileNotFoundError(f"not stored below {base}: {', '.join(missing)}")
    return {table: spark.read.parquet(f"{base.rstrip('/')}/{current[table].folder}") for table in wanted}


def stored_counts(spark: SparkSession, base: str, tables: Iterable[str] = tuple(LAYER_PATHS)) -> DataFrame:
    """layer and record_count of the current tables, from the commit alone."""
    current = manifest(spark, base)
    return known_counts(spark, {table: current[table].rows for table in tables if table in current})


def write_table(df: DataFrame, base: str, table: str) -> str:
    """Write the table from the executors and make it current; returns its folder."""
    spark = df.sparkSession
    staged = stage_table(df, base, table)
    publish_tables(spark, base, [staged])
    return f"{base.rstrip('/')}/{staged.folder}"


def create_table(df: DataFrame, name: str, location: str, *, replace: bool = False) -> bool:
    """Create the catalog table ``name`` from ``df``; says whether anything was written.

    A table that exists stays as it is, and ``df`` is not evaluated, unless ``replace``
    is set.  Files go to a new folder below ``location``; replacing a table of the same
    columns then moves it there in one step, so its readers always find a whole table.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists and not replace:
        return False
    folder = f"{location.rstrip('/')}/{run_folder()}"
    writer = df.write.format("parquet").option("compression", "snappy")
    if exists and spark.table(name).dtypes == df.dtypes:
        writer.save(folder)
        quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
        spark.catalog.refreshTable(name)
    else:
        writer.option("path", folder).mode("overwrite" if replace else "ignore").saveAsTable(name)
    return True

