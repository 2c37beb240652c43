"""The shared folder for intermediate tables, and staging into it.

A staged table cuts lineage and survives the loss of any executor, because it is read back
from shared storage. The folder is the one the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder. A local master without the setting gets a new folder."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="kinmart-"))
        named = context.getCheckpointDir()
    return f"{named.rstrip('/')}/kinmart/{context.applicationId}"


def new_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a frame that reads it back."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    if _open:
        _open[-1].made.append((spark, path))
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system Spark itself uses for it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables staged inside a ``scratch`` block."""

    def __init__(self):
        self.made: list[tuple[SparkSession, str]] = []

    def keep(self, df: DataFrame) -> DataFrame:
        """Let this staged table outlive the block, or pass it on to the block around it."""
        path = df.staged_at
        own = [x for x in self.made if x[1] == path]
        self.made = [x for x in self.made if x[1] != path]
        outer = _open[_open.index(self) - 1] if self in _open and _open.index(self) else None
        if outer:
            outer.made.extend(own)
        return df


_open: list[Scratch] = []


@contextmanager
def scratch() -> Iterator[Scratch]:
    """Tables staged inside the block are deleted when it ends, but for those it keeps.

    Only for blocks that run all they read: a frame that still has to read a staged table must
    not leave the block, unless it was staged and kept itself.
    """
    held = Scratch()
    _open.append(held)
    try:
        yield held
    finally:
        _open.remove(held)
        for spark, path in held.made:
            remove_dir(spark, path)


def estimated_bytes(df: DataFrame) -> int:
    """Size of ``df`` as the optimizer estimates it; runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def scan_tasks(df: DataFrame) -> int:
    """About how many tasks reading ``df`` takes."""
    split = df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes", "128MB")
    unit = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    text = split.lower().rstrip("b") or "0"
    size = int(text[:-1]) * unit[text[-1]] if text[-1] in unit else int(text)
    return max(1, -(-estimated_bytes(df) // max(1, size)))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a small input to every core before a step that is dear per row.

    A file of a few megabytes is one split, so one core would do all the work. An input
    that already fills the cores is left where it is: moving it would cost a shuffle. What
    is moved is therefore never more than one split per core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if scan_tasks(df) >= cores else df.repartition(2 * cores, key)
