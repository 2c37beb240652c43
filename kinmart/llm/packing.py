"""Mixture-controlled packing of documents into sequences, by deficit round-robin.

Each source is a queue of its documents in id order. In every round a queue is given a quantum
of tokens, its share of a window, and sends packets (stretches of at most ``packet`` tokens of
one document) as long as its deficit, what it has been given less what it has sent, covers the
next one. What it could not send is carried on. A queue whose packet ends ``c`` tokens into the
queue can send it in the first round whose quanta sum up to ``c``, so the round is ``ceil(c /
quantum)`` and no loop over windows is needed: deficits carry over windows and tasks through
the running totals alone. The packets, in order of round and queue, are laid end to end and cut
at window ends, so only the last window has padding. When a queue is empty, the windows are
filled by the others in their proportions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinmart.llm.files import giving_back, rows_of
from kinmart.llm.running import with_total_before
from kinmart.llm.tokens import blocks_of, encoder, vocabulary_size, with_end
from kinmart.workspace import stage

PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, source string, ids binary"
)


def binaries(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A binary value for each stretch of ``ids``, without a copy for each."""
    offsets = (starts * ids.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
    )


def encoded(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str, text: str, source: str):
    """(uid, doc_id, source, queue, n_tokens, ids), staged; ids take 2 bytes if they can."""
    kind = "<u2" if max(vocabulary_size(tokenizer), end_id + 1) <= 1 << 16 else "<u4"

    @giving_back
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = encoder(tokenizer)
        for batch in batches:
            at = 0
            for block in blocks_of(batch.column("text")):
                own, at = batch.slice(at, len(block)), at + len(block)
                ids, starts = with_end(*texts.encode_block(block), end_id)
                columns = [own.column(c) for c in ("uid", "doc_id", "source", "queue")]
                counts = pa.array(np.diff(starts), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*columns, counts, binaries(ids.astype(kind), starts)],
                    names=["uid", "doc_id", "source", "queue", "n_tokens", "ids"],
                )

    name = F.col(source).cast("string")
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(doc_id).cast("long").alias("doc_id"),
        name.alias("source"),
        F.when(name.isNull(), "").otherwise(F.concat(F.lit("="), name)).alias("queue"),
        F.col(text).cast("string").alias("text"),
    )
    schema = "uid long, doc_id long, source string, queue string, n_tokens long, ids binary"
    return stage(rows.mapInArrow(make, schema), "pack-ids"), kind


def quanta(
    lengths: DataFrame, mixture: Mapping[str, float] | None, window: int, temperature: float
) -> DataFrame:
    """(queue, quantum): tokens a queue is given in a round; a round gives about one window.

    ``mixture`` maps a source to its target share of the tokens. A source that it does not name
    gets a share in proportion to its tokens to the power of 1 / ``temperature``: at 1 its
    natural one, so that all queues end together, at 2 its square root, which gives small
    sources more of the early windows.
    """
    if temperature <= 0 or any(not share > 0 for share in (mixture or {}).values()):
        raise ValueError("shares and temperature must be positive")
    tokens = stage(lengths.groupBy("queue").agg(F.sum("n_tokens").alias("tokens")), "pack-queues")
    power = F.pow(F.col("tokens").cast("double"), F.lit(1.0 / temperature))
    total = tokens.agg(F.sum(power).alias("all")).first()["all"] or 1.0
    weight = power / F.lit(total)
    if mixture:
        named = F.create_map(*(F.lit(x) for k, v in mixture.items() for x in ("=" + k, float(v))))
        weight = F.coalesce(F.element_at(named, F.col("queue")), weight)
    return tokens.select("queue", (weight * window).alias("quantum"))


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    mixture: Mapping[str, float] | None = None,
    window: int = 2048,
    packet: int = 512,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    with_ids: bool = False,
    temperature: float = 1.0,
) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, source, ids).

    Every token lies in exactly one piece; the pieces of a sequence are gapless from offset 0.
    Ids are those of the whole text, then ``end_id``; a null text is only ``end_id``. A null
    source is a queue of its own, rows that share an id are documents of their own, null ids
    come first. An empty table gives no piece. ``ids`` (little-endian, 32 bits each) is filled
    only ``with_ids``; ``sequences`` joins them to whole windows.
    """
    tokens, kind = encoded(docs, tokenizer, end_id, doc_id, text, source)
    lengths = tokens.select("uid", "doc_id", "queue", "n_tokens")
    share = quanta(lengths, mixture, window, temperature)
    queued = with_total_before(lengths, "queue", ["doc_id", "uid"], "n_tokens")
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.lit(packet)))
    packets = queued.select("*", first.alias("start"))
    size = F.least(F.lit(packet), F.col("n_tokens") - F.col("start")).cast("long")
    packets = packets.withColumn("size", size).join(share, "queue")
    end = F.col("before") + F.col("start") + F.col("size")
    packets = packets.select(
        F.lit(0).alias("all"),
        F.ceil(end / F.col("quantum")).alias("round"),
        "queue",
        end.alias("end"),
        "uid",
        "start",
        "size",
    )
    laid = with_total_before(packets, "all", ["round", "queue", "end"], "size")
    whole, at = F.lit(window), F.col("before")
    windows = F.sequence(
        F.floor(at / whole), F.floor((at + F.col("size") - 1) / whole)
    )
    cut = laid.select("*", F.explode(windows).alias("sequence_id"))
    low = F.greatest(at, F.col("sequence_id") * whole)
    high = F.least(at + F.col("size"), (F.col("sequence_id") + 1) * whole)
    pieces = cut.select(
        "uid",
        F.struct(
            (F.col("start") + low - at).alias("start"),
            (high - low).alias("length"),
            "sequence_id",
            (low - F.col("sequence_id") * whole).alias("offset"),
        ).alias("piece"),
    )
    by_doc = pieces.groupBy("uid").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    joined = tokens.join(by_doc, "uid").select("doc_id", "source", "n_tokens", "ids", "pieces")

    @giving_back
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PIECE.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names
            )

        for batch in batches:
            out = []
            for row in rows_of(batch):
                ids, merged = np.frombuffer(row["ids"], kind), []
                for p in row["pieces"]:
                    last = merged[-1] if merged else None
                    if last and last[2] == p["sequence_id"] and last[3] + last[1] == p["offset"]:
                        last[1] += p["length"]
                    else:
                        merged.append([p["start"], p["length"], p["sequence_id"], p["offset"]])
                for start, length, sequence, offset in merged:
                    data = ids[start : start + length].astype("<u4").tobytes()
                    out.append(
                        (
                            row["doc_id"],
                            start,
                            length,
                            zlib.crc32(data),
                            row["n_tokens"],
                            sequence,
                            offset,
                            row["source"],
                            data if with_ids else None,
                        )
                    )
                if len(out) >= 4096:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

    return joined.mapInArrow(check, PIECE)


def sequences(pieces: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids): every window whole, padded at its end. Needs pieces with ids."""
    held = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("held")
    )

    @giving_back
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in rows_of(batch):
                ids = np.frombuffer(b"".join(x["ids"] for x in row["held"]), "<u4")
                out.append(np.pad(ids, (0, window - len(ids)), constant_values=pad_id))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array(out, pa.list_(pa.int64()))],
                names=["sequence_id", "ids"],
            )

    return held.mapInArrow(join, "sequence_id long, ids array<long>")
