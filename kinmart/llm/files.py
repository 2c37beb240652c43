"""Files that tasks write and read themselves, in the folder all executors share.

A task names its files with a fresh id and returns one manifest row for each. The manifest is
staged as a table, so the rows of failed or speculative attempts never appear in it, and only
files that a manifest names are read. ``pyarrow.fs`` reaches local and mounted folders, S3,
GCS and HDFS.
"""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Iterator
from functools import wraps

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from kinmart.workspace import new_dir, stage

MANIFEST = "path string, part int, serial int, n_records long, n_units long, n_bytes long"


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``uri`` and the path in it."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def create(folder: str, suffix: str):
    """A new file in ``folder``: its address and an open output stream."""
    uri = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, path = locate(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None)


def open_stream(uri: str):
    system, path = locate(uri)
    return system.open_input_stream(path, compression=None)


def open_random(uri: str):
    system, path = locate(uri)
    return system.open_input_file(path)


#: Rows in a batch that Spark hands to a task, and what it takes unless told otherwise.
BATCH_ROWS, MODEST_ROWS, USUAL_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000, "10000"


def modest_batches(spark: SparkSession) -> None:
    """Smaller batches of whole documents, unless the session has a size of its own.

    Ten thousand texts with their columns are some hundred megabytes, held by the executor and
    by the worker at once and by each for every core.
    """
    if spark.conf.get(BATCH_ROWS, USUAL_ROWS) == USUAL_ROWS:
        spark.conf.set(BATCH_ROWS, str(MODEST_ROWS))


def giving_back(work):
    """``work`` on batches, after which the worker returns free memory to the system.

    Workers outlive tasks, and what the allocators keep of one operator is of no use to the next.
    """

    @wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def folder_for(df: DataFrame, name: str) -> str:
    return new_dir(df.sparkSession, name)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch as Python values, some at a time, so that long texts are not held twice."""
    for start in range(0, batch.num_rows, 128):
        yield from batch.slice(start, 128).to_pylist()


def manifest_batch(made: list[tuple]) -> pa.RecordBatch:
    """What a task has written: (path, part, serial, n_records, n_units, n_bytes) for each file."""
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = [list(x) for x in zip(*made)] or [[] for _ in kinds]
    names = [x.split()[0] for x in MANIFEST.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(x, kind) for x, kind in zip(columns, kinds)], names=names
    )


def one_task_each(manifest: DataFrame) -> DataFrame:
    """The rows of a staged manifest, dealt out over as many tasks as there are files."""
    return manifest.repartition(max(1, manifest.count()))


def staged_manifest(written: DataFrame, name: str) -> DataFrame:
    """Run the writing tasks once and keep what they report."""
    return stage(written, name)
