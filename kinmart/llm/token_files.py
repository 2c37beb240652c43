"""Token ids in binary files: fixed-width bit packing in blocks, with random access.

Layout of a file, all numbers little-endian:

    8 bytes   magic
    blocks    BLOCK ids each (the last may be shorter), each id in ``width`` bits, most
              significant bit first, a block padded to whole bytes
    footer    uint64 byte offset of every block and of their end, int64 key of every document,
              uint8 flag of every document whose key is null, uint64 first id of every document
              and the number of ids
    32 bytes  width, ids in a block, number of blocks, number of documents, as uint64

``width`` is the least number of bits that holds every id of the vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from kinmart.llm import files
from kinmart.llm.files import giving_back
from kinmart.llm.tokens import BLOCK_BYTES, blocks_of, encoder, vocabulary_size, with_end
from kinmart.workspace import stage

MAGIC = b"KMTOKEN1"
BLOCK = 8192
READ_BLOCKS = 64


def bits_for(n_ids: int) -> int:
    """Least width in bits for ids from 0 to ``n_ids``, exclusive."""
    return max(1, int(n_ids - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids to ``width`` bits each."""
    ids = np.ascontiguousarray(ids, dtype=">u4")
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(bits[:, 32 - width :]).tobytes()


def unpack(data: bytes, n: int, width: int, first: int = 0) -> np.ndarray:
    """``n`` ids from the ``first`` on of packed ``data``: one gather of five bytes each."""
    raw = np.frombuffer(data + bytes(8), dtype=np.uint8)
    bit = (np.arange(n, dtype=np.int64) + first) * width
    at, value = bit >> 3, np.zeros(n, dtype=np.uint64)
    for k in range(5):
        value = (value << np.uint64(8)) | raw[at + k].astype(np.uint64)
    shift = (40 - width - (bit & 7)).astype(np.uint64)
    return ((value >> shift) & np.uint64((1 << width) - 1)).astype(np.uint32)


class TokenWriter:
    """Streams documents into one file; holds a few blocks and 17 bytes for each document."""

    def __init__(self, stream, width: int):
        self.stream, self.width = stream, width
        self.offsets, self.at = [len(MAGIC)], len(MAGIC)
        self.keys, self.nulls, self.starts = [], [], []
        self.n_docs, self.n_ids, self.held, self.n_held = 0, 0, [], 0
        stream.write(MAGIC)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.add_many([key or 0], [key is None], ids, np.array([0, len(ids)]))

    def add_many(self, keys, nulls, ids: np.ndarray, starts: np.ndarray) -> None:
        """Documents whose ids lie end to end in ``ids``, each from one of ``starts`` to the next."""
        self.keys.append(np.asarray(keys, np.int64))
        self.nulls.append(np.asarray(nulls, bool))
        self.starts.append(np.asarray(starts[:-1], np.int64) + self.n_ids)
        self.n_docs += len(keys)
        self.n_ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= 16 * BLOCK:
            self.flush(self.n_held // BLOCK * BLOCK)

    def flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for start in range(0, n, BLOCK):
            self.put(pack(ids[start : min(n, start + BLOCK)], self.width))
            self.offsets.append(self.at)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def close(self) -> int:
        self.flush(self.n_held)
        for values, kind in (
            ([self.offsets], "<u8"),
            (self.keys, "<i8"),
            (self.nulls, "u1"),
            ([*self.starts, [self.n_ids]], "<u8"),
            ([[self.width, BLOCK, len(self.offsets) - 1, self.n_docs]], "<u8"),
        ):
            for part in values:
                self.put(np.asarray(part, dtype=kind).tobytes())
        self.stream.close()
        return self.at

    def put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)


class TokenReader:
    """Random access to one file through its block offsets."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        end = np.frombuffer(file.read_at(32, size - 32), "<u8").astype(int)
        self.width, self.block, n_blocks, n_docs = (int(x) for x in end)
        need = 8 * (n_blocks + 1) + 17 * n_docs + 8
        if file.read_at(len(MAGIC), 0) != MAGIC or need > size:
            raise ValueError("not a token file")
        footer = file.read_at(need, size - 32 - need)
        a, b = 8 * (n_blocks + 1), 8 * (n_blocks + 1) + 8 * n_docs
        self.offsets = np.frombuffer(footer[:a], "<u8").astype(np.int64)
        self.keys = np.frombuffer(footer[a:b], "<i8")
        self.nulls = np.frombuffer(footer[b : b + n_docs], "u1").astype(bool)
        self.starts = np.frombuffer(footer[b + n_docs :], "<u8").astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (exclusive) of the file; reads only the blocks they lie in."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        out = []
        first, last = start // self.block, (stop - 1) // self.block
        data = self.file.read_at(
            int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first])
        )
        for k in range(first, last + 1):
            low, high = max(start, k * self.block), min(stop, (k + 1) * self.block)
            base = int(self.offsets[k] - self.offsets[first])
            piece = data[base : base + int(self.offsets[k + 1] - self.offsets[k])]
            out.append(unpack(piece, high - low, self.width, low - k * self.block))
        return np.concatenate(out)

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    file_ids: int = 1 << 27,
) -> DataFrame:
    """Encode every document and write the ids in ascending order of ``doc_id``.

    Returns the staged manifest, one row for each file: its partition and place in it, its
    documents and ids, and ``start``, the number of ids in all files before it. ``end_id`` is
    appended to each document. A null text is empty; null ids come first; documents of one id
    keep the order of their texts. An empty table writes no file. ``file_ids`` is where a task
    begins its next file, after the block of documents (at most 8 MiB of text and twice as many
    bytes as ids, or one text) at hand.
    """
    width = bits_for(max(vocabulary_size(tokenizer), end_id + 1))

    @giving_back
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, part = encoder(tokenizer), TaskContext.get().partitionId()
        made, out = [], None

        def close():
            size = out[1].close()
            made.append((out[0], part, len(made), out[1].n_docs, out[1].n_ids, size))

        for batch in batches:
            at = 0
            for block in blocks_of(batch.column(1), min(BLOCK_BYTES, 2 * file_ids)):
                if out is None:
                    uri, stream = files.create(folder, ".tokens")
                    out = (uri, TokenWriter(stream, width))
                keys = batch.column(0).slice(at, len(block))
                at += len(block)
                nulls = keys.is_null().to_numpy(zero_copy_only=False)
                numbers = pc.fill_null(keys, 0).to_numpy(zero_copy_only=False)
                ids, starts = with_end(*texts.encode_block(block), end_id)
                out[1].add_many(numbers, nulls, ids, starts)
                if out[1].n_ids >= file_ids:
                    close()
                    out = None
        if out is not None:
            close()
        yield files.manifest_batch(made)

    keyed = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    ordered = keyed.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = files.staged_manifest(ordered.mapInArrow(write, files.MANIFEST), "token-files")
    before = Window.orderBy("part", "serial").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_units").over(before), F.lit(0)).cast("long")
    return stage(made.withColumn("start", start), "token-starts")


def read_digests(manifest: DataFrame) -> DataFrame:
    """One row for each document in the files: id, first id over all files, length, checksum.

    ``ids_crc32`` is the unsigned crc32 of the document's ids as little-endian unsigned 32-bit
    integers, computed from what the file holds. A task reads one file, some blocks at a time.
    """

    @giving_back
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_random(row["path"]) as file:
                    reader = TokenReader(file)
                    sums, step = [], READ_BLOCKS * reader.block
                    base, held = 0, np.zeros(0, np.uint32)
                    total = int(reader.starts[-1])
                    for start, stop in zip(reader.starts[:-1].tolist(), reader.starts[1:].tolist()):
                        crc = 0
                        while start < stop:
                            if start >= base + len(held):
                                base = start // reader.block * reader.block
                                held = reader.ids(base, min(total, base + step))
                            take = held[start - base : stop - base]
                            crc = zlib.crc32(take.astype("<u4").tobytes(), crc)
                            start += len(take)
                        sums.append(crc)
                n = len(reader.keys)
                starts = reader.starts
                for low in range(0, n, 10_000):
                    high = min(n, low + 10_000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.keys[low:high], mask=reader.nulls[low:high]),
                            pa.array(starts[low:high] + row["start"]),
                            pa.array(starts[low + 1 : high + 1] - starts[low:high]),
                            pa.array(sums[low:high], pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return files.one_task_each(manifest.select("path", "start")).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
