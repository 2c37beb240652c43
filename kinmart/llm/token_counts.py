"""Token counts of whole documents; huge ones are encoded in overlapping chunks.

A byte-pair encoding is the only sequence of tokens of a text in which every two neighbours are
what the two encode to together: no merge crosses a border of the final tokens, and merges on
either side keep their order whatever lies beyond. So if the encodings of two overlapping
chunks share one token (same first character, same length), that token is a proven border: the
first chunk's tokens up to it and the second chunk's from it on are the tokens of both chunks
together, and neither the cut ends nor the blank the library puts before every text matter.

Chunks of one document are encoded by different tasks and matched at each junction by a join on
the numbers of both. Where a junction shares no token, all chunks of its document are widened:
four become one, overlapping the next by a whole old chunk. In the last round a document is
one chunk, which is the library's own answer; every round costs its documents one encoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinmart.llm.tokens import blocks_of, encoder
from kinmart.workspace import stage

#: Text handed to the library at a time, and bytes of chunks in one batch.
BLOCK_BYTES, BATCH_BYTES = 1 << 20, 8 << 20
LENGTH_BITS = 16
WIDER = 4


@dataclass(frozen=True)
class Chunks:
    """Chunks of ``chars`` characters, each beginning ``step`` after the one before."""

    chars: int = 16_384
    step: int = 16_384 - 512

    def __post_init__(self):
        if not 0 < 2 * (self.chars - self.step) <= self.step:
            raise ValueError("an overlap must be positive and at most half a step")

    @property
    def overlap(self) -> int:
        return self.chars - self.step

    def number(self, n_chars: int) -> int:
        return max(1, -(-(n_chars - self.overlap) // self.step))

    def wider(self) -> Chunks:
        return Chunks(WIDER * self.step + self.chars, WIDER * self.step)


class PieceModel:
    """A sentencepiece model, and the characters each of its tokens stands for."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        held = sentencepiece_model_pb2.ModelProto()
        held.ParseFromString(self.library.serialized_model_proto())
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        plain = {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}
        bpe = held.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        #: Whether the proof above holds: merges alone decide, and texts are taken as they are.
        self.splices = bpe and all(piece.type in plain for piece in held.pieces)
        self.splices &= not held.normalizer_spec.precompiled_charsmap
        self.splices &= not held.normalizer_spec.remove_extra_whitespaces
        self.sizes = np.zeros(len(held.pieces), np.int64)
        self.whole = np.zeros(len(held.pieces), bool)
        for k, piece in enumerate(held.pieces):
            if piece.type == kinds.BYTE:
                # Bytes of a character count where the character begins.
                self.sizes[k] = not 0x80 <= int(piece.piece[3:5], 16) < 0xC0
            elif piece.type == kinds.NORMAL:
                self.sizes[k], self.whole[k] = len(piece.piece), True
        self.prefix = int(held.normalizer_spec.add_dummy_prefix)

    def counts(self, texts: list[str]) -> list[int]:
        return list(map(len, self.library.encode(texts, num_threads=1)))

    def borders(self, text: str, first: int, overlap: int) -> tuple[int, list[int], list[int]]:
        """(tokens, head, tail): codes of the tokens that lie in the first and last ``overlap``.

        A code holds a token's first character, counted from the document's start, and its
        length; -1 stands for one that can't be matched.
        """
        ids = np.array(self.library.encode(text), np.int64)
        sizes = self.sizes[ids]
        starts = np.cumsum(sizes) - sizes - self.prefix
        if len(ids) and starts[-1] + sizes[-1] != len(text):
            return len(ids), [], []
        codes = (starts + first) << LENGTH_BITS | sizes
        codes[~self.whole[ids] | (starts < 0) | (sizes >> LENGTH_BITS > 0)] = -1
        head = int(np.searchsorted(starts + sizes, overlap, "right"))
        tail = int(np.searchsorted(starts, len(text) - overlap))
        return len(ids), codes[:head].tolist(), codes[tail:].tolist()


@lru_cache(maxsize=1)
def piece_model(path: str) -> PieceModel:
    """One model in a worker; it outlives a task and keeps nothing of the texts."""
    return PieceModel(path)


def counted_or_cut(docs: DataFrame, tokenizer: str, chunks: Chunks) -> DataFrame:
    """(uid, doc_id, n_bytes, n_tokens, n_chunks, chunk, text), staged.

    One row for each document, without n_tokens if it is cut, and one for each chunk of it.
    """
    schema = (
        "uid long, doc_id long, n_bytes long, n_tokens long, n_chunks long, chunk long, text string"
    )
    kinds = [pa.int64()] * 6 + [pa.string()]
    names = [part.split()[0] for part in schema.split(", ")]

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = [pa.array(list(x), kind) for x, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer.endswith(".json"):
            model = encoder(tokenizer)
            sizes_of = lambda block: np.diff(model.encode_block(block)[1]).tolist()
            longest = None
        else:
            model = piece_model(tokenizer)
            sizes_of = lambda block: model.counts(block.to_pylist())
            longest = chunks.chars if model.splices else None
        for batch in batches:
            at, rows, held = 0, [], 0
            for block in blocks_of(batch.column("text"), BLOCK_BYTES):
                keys = [
                    batch.column(name).slice(at, len(block)).to_pylist()
                    for name in ("uid", "doc_id", "n_bytes")
                ]
                at += len(block)
                long = {}
                if longest and (max(keys[2]) > longest):
                    texts = block.to_pylist()
                    long = {k: t for k, t in enumerate(texts) if len(t) > longest}
                    block = pa.array(["" if k in long else t for k, t in enumerate(texts)])
                for k, (*key, n) in enumerate(zip(*keys, sizes_of(block))):
                    if k not in long:
                        rows.append((*key, n, None, None, None))
                        continue
                    n = chunks.number(len(long[k]))
                    rows.append((*key, None, n, None, None))
                    for j in range(n):
                        part = long[k][j * chunks.step : j * chunks.step + chunks.chars]
                        rows.append((key[0], None, None, None, n, j, part))
                        held += len(part)
                        if held >= BATCH_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
            if rows:
                yield batch_of(rows)

    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        "doc_id",
        F.octet_length(whole).cast("long").alias("n_bytes"),
        whole.alias("text"),
    )
    return stage(rows.mapInArrow(count, schema), "token-counts")


def encoded(parts: DataFrame, tokenizer: str, chunks: Chunks) -> DataFrame:
    """(uid, n_chunks, chunk, n, head, tail) of (uid, n_chunks, chunk, text) rows, staged."""
    step, overlap = chunks.step, chunks.overlap

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts, numbers = part.column("text"), part.column("chunk").to_pylist()
                made = [
                    model.borders(text.as_py(), k * step, overlap)
                    for text, k in zip(texts, numbers)
                ]
                kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                columns = [pa.array(list(x), kind) for x, kind in zip(zip(*made), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("uid", "n_chunks", "chunk")] + columns,
                    names=["uid", "n_chunks", "chunk", "n", "head", "tail"],
                )

    schema = "uid long, n_chunks long, chunk long, n long, head array<long>, tail array<long>"
    # Chunks of one document go to many tasks.
    dealt = parts.select("uid", "n_chunks", "chunk", "text").repartition("uid", "chunk")
    return stage(dealt.mapInArrow(encode, schema), "token-chunks")


def spliced(found: DataFrame) -> DataFrame:
    """(uid, n_tokens): the sum over chunks of what lies between their borders, staged.

    ``n_tokens`` is null if a junction of the document shares no token.
    """
    after = found.where("chunk > 0").select("uid", (F.col("chunk") - 1).alias("chunk"), "head")
    before = found.where("chunk < n_chunks - 1").select("uid", "chunk", "tail")
    shared = F.array_except(F.array_intersect("tail", "head"), F.array(F.lit(-1).cast("long")))
    border = F.try_element_at(shared, F.lit(1))
    # Tokens from the border on in the first chunk, and before it in the second, count once.
    twice = (
        F.size("tail") - F.array_position("tail", border) + F.array_position("head", border)
    )
    junctions = before.join(after, ["uid", "chunk"]).select("uid", (-twice).alias("n"))
    parts = found.select("uid", "n").unionByName(junctions)
    total = F.when(F.count("n") == F.count(F.lit(1)), F.sum("n")).alias("n_tokens")
    return stage(parts.groupBy("uid").agg(total), "token-totals")


def widened(parts: DataFrame, chunks: Chunks) -> DataFrame:
    """The chunks of the next round: each joins ``WIDER`` of these and the one after them."""
    last = F.greatest(F.lit(1), F.ceil((F.col("n_chunks") - 1) / WIDER)).cast("long")
    own = F.floor(F.col("chunk") / WIDER)
    tail_of = F.when((F.col("chunk") % WIDER == 0) & (own > 0), F.array(own - 1, own))
    dealt = parts.select(
        "uid",
        last.alias("n_chunks"),
        F.explode(F.coalesce(tail_of, F.array(own))).alias("wide"),
        "chunk",
        "text",
    ).where("wide < n_chunks")
    held = F.sort_array(F.collect_list(F.struct("chunk", "text")))
    rest = F.lit(chunks.overlap + 1)
    text = F.array_join(
        F.transform(
            "held", lambda x, k: F.when(k == 0, x["text"]).otherwise(F.substring(x["text"], rest, F.lit(chunks.chars)))
        ),
        "",
    )
    grouped = dealt.groupBy("uid", "n_chunks", "wide").agg(held.alias("held"))
    return grouped.select("uid", "n_chunks", F.col("wide").cast("long").alias("chunk"), text.alias("text"))


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 4096,
    chunks: Chunks = Chunks(),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    ``n_tokens`` is what the library gives for the whole text, without special tokens of its
    own; ``over_limit`` is whether it exceeds ``limit``. A null text is empty and has none. Null
    ids and repeated rows are documents of their own, other columns are not read, and an empty
    table gives no rows. Files ending in ``.json`` are for the tokenizers library, others for
    sentencepiece. Of a model that is not plain byte-pair merging every text is encoded whole.
    A task holds one text and its chunks a few megabytes at a time; only a text without any
    shared token at its junctions, such as one letter repeated, is at last encoded whole.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    held = counted_or_cut(rows, tokenizer, chunks)
    heads = held.where("chunk is null").drop("chunk", "text")
    open_parts, totals = held.where("chunk is not null"), None
    while not open_parts.isEmpty():
        sums = spliced(encoded(open_parts, tokenizer, chunks))
        done = sums.where("n_tokens is not null")
        totals = done if totals is None else totals.unionByName(done)
        failed = sums.where("n_tokens is null").select("uid")
        again = open_parts.select("uid", "n_chunks", "chunk", "text").join(failed, "uid", "left_semi")
        open_parts = stage(widened(again, chunks), "token-wider")
        chunks = chunks.wider()
    if totals is not None:
        long = heads.where("n_tokens is null").drop("n_tokens").join(totals, "uid")
        heads = heads.where("n_tokens is not null").unionByName(long.select(heads.columns))
    return heads.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
