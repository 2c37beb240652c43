"""Tables kept as parquet versions behind one list of what is current.

A rebuild writes beside the live version. Only a commit, one new small file that names the
current version of every table, makes it visible, so several tables change together and a
run that fails leaves the last good output in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmart.schemas import LOADED


class ConcurrentCommitError(RuntimeError):
    """Another run committed first."""


class Folder:
    """The few file operations the store needs, on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._make = jvm.org.apache.hadoop.fs.Path
        self._bytes = jvm.org.apache.commons.io.IOUtils
        self.path = path.rstrip("/")
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._make(self.path).getFileSystem(conf)

    def names(self, folder: str = "") -> list[str]:
        where = self._make(f"{self.path}/{folder}" if folder else self.path)
        if not self._fs.exists(where):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(where))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._make(f"{self.path}/{name}"))
        try:
            return self._bytes.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a new file; fails when the name is taken."""
        stream = self._fs.create(self._make(f"{self.path}/{name}"), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self._fs.delete(self._make(f"{self.path}/{name}"), True)


class Transaction(Mapping):
    """New versions of some tables, over the current versions of the others."""

    def __init__(self, store: TableStore):
        self._store = store
        self._base = store.commit_number()
        self._current = store.current()

    def write(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write a new version and return it as read back.

        Rows say when they were loaded, in ``loaded_at``; those that already do keep their time.
        """
        if LOADED not in df.columns:
            df = df.withColumn(LOADED, F.current_timestamp())
        version = self._store.new_version(table)
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self._store.path}/{version}")
        return self.adopt(table, version)

    def adopt(self, table: str, version: str) -> DataFrame:
        """Make an already written folder under the store the new version of a table."""
        self._current[table] = version
        return self[table]

    def __getitem__(self, table: str) -> DataFrame:
        return self._store.open(self._current[table])

    def __contains__(self, table: object) -> bool:
        return table in self._current

    def __iter__(self) -> Iterator[str]:
        return iter(self._current)

    def __len__(self) -> int:
        return len(self._current)

    def commit(self) -> None:
        self._store._commit(self._base, self._current)


class TableStore(Mapping):
    """Current versions of named tables under one folder; reads as table name to DataFrame."""

    COMMITS = "_commits"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._folder = Folder(spark, path)
        self._opened: dict[str, DataFrame] = {}
        self.path = self._folder.path

    def new_version(self, table: str) -> str:
        """A folder under the store for a version about to be written."""
        return f"{table}/{uuid.uuid4().hex}"

    def commit_number(self) -> int:
        names = self._folder.names(self.COMMITS)
        return int(names[-1].split(".")[0]) if names else 0

    def current(self, number: int | None = None) -> dict[str, str]:
        number = self.commit_number() if number is None else number
        if not number:
            return {}
        return json.loads(self._folder.read(f"{self.COMMITS}/{number:012d}.json"))

    def __getitem__(self, table: str) -> DataFrame:
        return self.open(self.current()[table])

    def open(self, version: str) -> DataFrame:
        """A frame over one version. Versions never change, so each is looked up once."""
        if version not in self._opened:
            self._opened[version] = self.spark.read.parquet(f"{self.path}/{version}")
        return self._opened[version]

    def __contains__(self, table: object) -> bool:
        return table in self.current()

    def __iter__(self) -> Iterator[str]:
        return iter(self.current())

    def __len__(self) -> int:
        return len(self.current())

    @contextmanager
    def transaction(self) -> Iterator[Transaction]:
        """Commit on a normal exit; an exception leaves everything as it was."""
        work = Transaction(self)
        yield work
        work.commit()

    def write(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Replace one table."""
        with self.transaction() as work:
            return work.write(table, df, partition_by)

    def _commit(self, base: int, current: dict[str, str]) -> None:
        if self.commit_number() != base:
            raise ConcurrentCommitError(f"commit {base + 1} of {self.path} is taken")
        name = f"{self.COMMITS}/{base + 1:012d}.json"
        self._folder.create(name, json.dumps(current, indent=1, sort_keys=True))

    def stale(self, keep: int = 1) -> list[str]:
        """Version folders that none of the newest ``keep`` commits names."""
        newest = self.commit_number()
        kept = {
            version
            for number in range(max(1, newest - keep + 1), newest + 1)
            for version in self.current(number).values()
        }
        tables = [name for name in self._folder.names() if not name.startswith("_")]
        found = [f"{table}/{name}" for table in tables for name in self._folder.names(table)]
        return [version for version in found if version not in kept]

    def prune(self, keep: int = 1) -> int:
        """Delete stale versions. Call it after a successful rebuild, never before."""
        stale = self.stale(keep)
        for version in stale:
            self._opened.pop(version, None)
            self._folder.remove(version)
        return len(stale)
