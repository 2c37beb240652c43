"""Upsert by key without rewriting the table: append batches, read the newest row per key.

Appending costs what the batch costs. So that reading doesn't slow down with every batch, full
groups of neighbours are folded into one run, runs of one size into a larger one, and so on:
after n batches there are at most ``FAN_IN`` pieces of each of log(n) sizes, and a row is
written again once for each size. A run holds the newest row of each key of its batches, in
ranges of the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmart.operators.ranking import latest_per_key
from kinmart.schemas import LOADED
from kinmart.sources.store import Folder

BATCH, ARRIVAL = "_batch", "_arrival"
RUNS = "runs"
FAN_IN = 8


def append_batch(batch: DataFrame, path: str, number: int, keys: Sequence[str]) -> None:
    """Add one batch. Writing the same number again replaces it, so a retry adds nothing.

    ``batch`` carries its rows' order in ``_arrival``; a key that occurs twice keeps its
    last row. ``loaded_at`` is when a row was written; the newest row of a key brings its own,
    so an upsert refreshes it. The cost is that of the batch, whatever the table already holds.
    """
    newest = latest_per_key(batch, keys, ARRIVAL).withColumn(LOADED, F.current_timestamp())
    newest.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{BATCH}={number}")


@dataclass(frozen=True, order=True)
class Piece:
    """A batch, or a run of neighbouring ones: its first and last, how many, and its folder."""

    first: int
    last: int
    batches: int
    path: str


def pieces(spark: SparkSession, path: str) -> list[Piece]:
    """What a table consists of, in order.

    A finished run stands for the batches and runs it was folded from, which may still be there.
    """
    folder = Folder(spark, path)
    found = []
    for name in folder.names():
        if name.startswith(f"{BATCH}="):
            number = int(name.split("=")[1])
            found.append(Piece(number, number, 1, f"{path}/{name}"))
    for name in folder.names(RUNS):
        if "_SUCCESS" in folder.names(f"{RUNS}/{name}"):
            found.append(Piece(*map(int, name.split("-")), f"{path}/{RUNS}/{name}"))
    # Of pieces that overlap one holds the other: the wider one counts.
    live: list[Piece] = []
    for piece in sorted(found, key=lambda p: (p.first, -p.last, -p.batches)):
        if not live or piece.first > live[-1].last:
            live.append(piece)
    return live


def read_pieces(spark: SparkSession, some: Sequence[Piece]) -> DataFrame:
    """Rows of some pieces with the number of the last batch of each."""
    schema = spark.read.parquet(some[0].path).schema
    parts = [
        spark.read.schema(schema).parquet(p.path).withColumn(BATCH, F.lit(p.last).cast("bigint"))
        for p in some
    ]
    return reduce(DataFrame.unionByName, parts)


def read_latest(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    recency: Sequence[str] = (BATCH, ARRIVAL),
) -> DataFrame:
    """The newest row of every key over all batches, with the time it was loaded."""
    rows = read_pieces(spark, pieces(spark, path))
    return latest_per_key(rows, keys, *recency).drop(BATCH, ARRIVAL)


def fold(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    recency: Sequence[str] = (BATCH, ARRIVAL),
    fan_in: int = FAN_IN,
) -> int:
    """Fold full groups of neighbouring pieces of one size into runs; returns how many.

    The newest piece is left alone, as its batch may have to run again. What a run stands for
    is deleted only when the next ``fold`` begins, so a reader that has listed the pieces
    before still finds them. A run that fails leaves no ``_SUCCESS`` and counts for nothing.
    """
    folder, folded = Folder(spark, path), 0
    live = pieces(spark, path)
    kept = {piece.path for piece in live}
    for name in [*folder.names(), *(f"{RUNS}/{n}" for n in folder.names(RUNS))]:
        if (name.startswith(f"{BATCH}=") or "/" in name) and f"{path}/{name}" not in kept:
            folder.remove(name)
    # A piece of n batches has size log(n); a full group of neighbours of one size is folded.
    while True:
        sizes = []
        for piece in live[:-1]:
            size, batches = 0, piece.batches
            while batches >= fan_in:
                size, batches = size + 1, batches // fan_in
            sizes.append(size)
        start = next(
            (k for k in range(len(sizes) - fan_in + 1) if len(set(sizes[k : k + fan_in])) == 1), None
        )
        if start is None:
            return folded
        group = live[start : start + fan_in]
        first, last = group[0].first, group[-1].last
        batches = sum(piece.batches for piece in group)
        target = f"{path}/{RUNS}/{first:019d}-{last:019d}-{batches}"
        newest = latest_per_key(read_pieces(spark, group), keys, *recency).drop(BATCH)
        ranged = newest.repartitionByRange(*keys).sortWithinPartitions(*keys)
        ranged.write.mode("overwrite").option("compression", "zstd").parquet(target)
        live[start : start + fan_in] = [Piece(first, last, batches, target)]
        folded += 1


def upsert(existing: DataFrame, batch: DataFrame, keys: Sequence[str], *recency: str) -> DataFrame:
    """Existing rows with the batch folded in; a row of the batch wins over an existing one.

    Within the batch the row with the highest ``recency`` wins. Existing rows are only
    filtered by key, so the fold reads them once and never sorts them. If the existing rows say
    when they were loaded, those of the batch are loaded now.
    """
    newest = latest_per_key(batch, keys, *recency) if recency else batch
    if LOADED in existing.columns:
        newest = newest.withColumn(LOADED, F.current_timestamp())
    kept = existing.join(batch.select(*keys), list(keys), "left_anti")
    return kept.unionByName(newest.select(*existing.columns))


def compact(spark: SparkSession, path: str, keys: Sequence[str], target: str) -> None:
    """Fold all batches into one, written to ``target`` as its batch zero."""
    rows = latest_per_key(read_pieces(spark, pieces(spark, path)), keys, BATCH, ARRIVAL)
    rows.drop(BATCH).write.option("compression", "zstd").parquet(f"{target}/{BATCH}=0")
