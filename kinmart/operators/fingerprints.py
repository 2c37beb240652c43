"""Bit fingerprints at library scale: build, reject, pack, plan shards, publish."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmart.config import Settings
from kinmart.functions.bits import popcount
from kinmart.functions.features import MAKERS, hashed_bits, sign_bits, usable
from kinmart.workspace import spread, stage

LIBRARY_DDL = "item_id string, fp array<bigint>, pc int"

BatchMaker = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _word_batch(ids: pa.Array, bits: np.ndarray) -> pa.RecordBatch:
    """Pack a rows-by-bits boolean matrix into 64-bit words, lowest bit first."""
    words = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
    offsets = np.arange(0, words.size + 1, words.shape[1], dtype=np.int32)
    packed = pa.ListArray.from_arrays(offsets, words.reshape(-1))
    counts = pa.array(bits.sum(axis=1, dtype=np.int32))
    return pa.RecordBatch.from_arrays([ids, packed, counts], ["item_id", "fp", "pc"])


def pack_positions(positions: DataFrame, n_bits: int) -> DataFrame:
    """(item_id, bits) to (item_id, fp, pc), inside each task.

    The bit positions come from Spark expressions; only their packing leaves the JVM. Doing
    it with explode and bit_or would shuffle the library once more for the same words.
    """
    width = (n_bits + 63) // 64 * 64

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bits = batch.column("bits")
            lengths = np.diff(bits.offsets.to_numpy())
            matrix = np.zeros((batch.num_rows, width), dtype=bool)
            matrix[np.repeat(np.arange(batch.num_rows), lengths), bits.flatten().to_numpy()] = True
            yield _word_batch(batch.column("item_id"), matrix)

    return positions.select("item_id", "bits").mapInArrow(pack, LIBRARY_DDL)


def text_fingerprints(
    items: DataFrame,
    item_id: str,
    structure: str,
    settings: Settings = Settings(),
    features: str = "ngrams",
) -> DataFrame:
    """Fingerprints of every item whose structure can be used: item_id, fp, pc."""
    text = F.col("structure")
    given = items.select(
        F.col(item_id).cast("string").alias("item_id"), F.col(structure).alias("structure")
    ).where(usable(text))
    positions = spread(given, "item_id").select(
        "item_id",
        hashed_bits(
            MAKERS[features](text, settings.radius), settings.n_bits, settings.hashing
        ).alias("bits"),
    )
    return pack_positions(positions, settings.n_bits)


def text_rejects(items: DataFrame, item_id: str, structure: str) -> DataFrame:
    """The items no fingerprint can be made of, each with its reason."""
    text = F.col(structure)
    return items.where(~usable(text)).select(
        F.col(item_id).cast("string").alias("item_id"),
        F.when(text.isNull(), "structure is missing")
        .otherwise("structure is blank")
        .alias("reason"),
    )


def vector_fingerprints(items: DataFrame, item_id: str, vector: str, n_dims: int) -> DataFrame:
    """Fingerprints of numeric vectors: one bit per dimension, set where it is positive."""
    positions = items.where(F.col(vector).isNotNull()).select(
        F.col(item_id).cast("string").alias("item_id"), sign_bits(F.col(vector)).alias("bits")
    )
    return pack_positions(positions, n_dims)


def custom_fingerprints(
    items: DataFrame, item_id: str, structure: str, maker: BatchMaker, n_bits: int
) -> tuple[DataFrame, DataFrame]:
    """Fingerprints from a caller's own toolkit, and the items it could not handle.

    ``maker`` maps Arrow batches (item_id, structure) to (item_id, fingerprint), where the
    fingerprint is packed bytes or null. It runs once: its output is staged.
    """
    given = items.select(
        F.col(item_id).cast("string").alias("item_id"), F.col(structure).alias("structure")
    )
    made = stage(given.mapInArrow(maker, "item_id string, fingerprint binary"), "made")
    library = from_packed_bytes(made.where(F.col("fingerprint").isNotNull()), n_bits)
    rejects = given.join(library.select("item_id"), "item_id", "left_anti").select(
        "item_id", F.lit("structure is unusable").alias("reason")
    )
    return library, rejects


def from_packed_bytes(packed: DataFrame, n_bits: int) -> DataFrame:
    """(item_id, fingerprint bytes, first bit highest) to (item_id, fp, pc).

    Raises when a fingerprint is not exactly ``n_bits`` wide.
    """
    n_bytes, width = n_bits // 8, (n_bits + 63) // 64 * 64

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            column = batch.column("fingerprint")
            widths = set(pa.compute.binary_length(column).unique().to_pylist())
            if widths != {n_bytes}:
                found = sorted(w for w in widths if w != n_bytes)
                raise ValueError(f"expected {n_bytes} fingerprint bytes, found {found}")
            raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(rows, n_bytes)
            bits = np.zeros((rows, width), dtype=bool)
            bits[:, :n_bits] = np.unpackbits(raw, axis=1)
            yield _word_batch(batch.column("item_id"), bits)

    return packed.select("item_id", "fingerprint").mapInArrow(unpack, LIBRARY_DDL)


def to_packed_bytes(library: DataFrame, n_bits: int) -> DataFrame:
    """(item_id, fp) to (item_id, fingerprint bytes), the layout for exchange with others."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            words = batch.column("fp").flatten().to_numpy().reshape(rows, -1)
            bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")[:, :n_bits]
            raw = np.packbits(bits, axis=1)
            fingerprints = pa.array([row.tobytes() for row in raw], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), fingerprints], ["item_id", "fingerprint"]
            )

    return library.select("item_id", "fp").mapInArrow(
        pack, "item_id string, fingerprint binary"
    )


def wrong_width(library: DataFrame, n_bits: int) -> DataFrame:
    """Rows whose words or stored bit count do not fit the library."""
    fits = (F.size("fp") == (n_bits + 63) // 64) & (popcount(F.col("fp")) == F.col("pc"))
    return library.where(~F.coalesce(fits, F.lit(False)))


def range_sorted(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Contiguous, non-overlapping key ranges, each sorted.

    Range partitioning runs its input twice, once to sample the keys, so pass a frame that
    is cheap to read, such as a staged one.
    """
    return df.repartitionByRange(max(1, partitions), key).sortWithinPartitions(key)


def shard_count(rows: int, shard_size: int) -> int:
    """Shards a complete library of ``rows`` holds."""
    return -(-rows // shard_size)


def _placed(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """``df`` staged in ranges of ``key``, with each row's place in the whole order: ``row``.

    A global row_number would move every row to one task. Here the sorted ranges are staged
    with each row's place in its range, and one count per range gives the offset.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stage(
        range_sorted(df, key, partitions)
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", place),
        "ranges",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("part")
        .count()
        .select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    )
    row = (F.col("offset") + F.col("place")).alias("row")
    return placed.join(offsets, "part").select(*df.columns, row)


def shard_plan(items: DataFrame, item_id: str, shard_size: int, partitions: int) -> DataFrame:
    """Exact key ranges of ``shard_size`` items: shard, first_id, next_id (null for the last).

    Only the first key of each shard is left to pair up.
    """
    first = (
        _placed(items.select(F.col(item_id).alias("key")), "key", partitions)
        .where(F.col("row") % shard_size == 0)
        .select((F.col("row") / shard_size).cast("bigint").alias("shard"), "key")
    )
    following = first.select((F.col("shard") - 1).alias("shard"), F.col("key").alias("next_id"))
    return first.join(following, "shard", "left").select(
        "shard", F.col("key").alias("first_id"), "next_id"
    )


def in_range(key: Column, first_id: str, next_id: str | None) -> Column:
    """Half-open key range, open at the end for the last shard. Prunes range-sorted files."""
    lower = key >= first_id
    return lower if next_id is None else lower & (key < next_id)


def publish_library(fingerprints: DataFrame, path: str, settings: Settings = Settings()) -> int:
    """Write the library in exact shards and return its row count.

    Shard k holds rows k * shard_size to (k + 1) * shard_size of the order by identifier, as
    ``shard_plan`` has it, in one sorted file in the folder ``shard=k``, written by one task.
    The fingerprints are staged first: they are dear to compute and range partitioning would
    compute them twice.
    """
    staged = stage(fingerprints, "fingerprints")
    rows = staged.count()
    placed = _placed(staged, "item_id", max(1, shard_count(rows, settings.shard_size)))
    shard = (F.col("row") / settings.shard_size).cast("bigint").alias("shard")
    sharded = placed.select("item_id", "fp", "pc", shard)
    sharded = sharded.repartition("shard").sortWithinPartitions("shard", "item_id")
    written = sharded.write.mode("overwrite").option("compression", "zstd")
    written.partitionBy("shard").parquet(path)
    if not rows:
        none = staged.sparkSession.createDataFrame([], LIBRARY_DDL)
        none.write.mode("overwrite").parquet(f"{path}/shard=0")
    return rows


def by_popcount(library: DataFrame, path: str, rows_per_file: int = 250_000) -> DataFrame:
    """A copy of the library for searching, in ranges of bit counts, read back from ``path``.

    A search needs rows of certain bit counts only. Sorted by them, and in row groups of some
    ten thousand rows, whole files and row groups of others are skipped by their statistics.
    """
    rows = library.select("item_id", "fp", "pc")
    ranges = max(1, shard_count(library.count(), rows_per_file))
    ranged = rows.repartitionByRange(ranges, "pc", "item_id").sortWithinPartitions("pc", "item_id")
    written = ranged.write.mode("overwrite").option("compression", "zstd")
    written.option("parquet.block.size", 8 << 20).parquet(path)
    return library.sparkSession.read.schema(LIBRARY_DDL).parquet(path)


def library_summary(library: DataFrame, rejects: DataFrame, settings: Settings) -> DataFrame:
    """One row: shards, fingerprints written, items rejected, packed bytes."""
    written = library.agg(F.count("*").alias("fingerprints"))
    rejected = rejects.agg(F.count("*").alias("rejected"))
    counts = written.withColumn("rejected", rejected.scalar())
    return counts.select(
        F.ceil(F.col("fingerprints") / settings.shard_size).cast("bigint").alias("shards"),
        "fingerprints",
        "rejected",
        (F.col("fingerprints") * settings.n_bytes).alias("packed_bytes"),
    )
