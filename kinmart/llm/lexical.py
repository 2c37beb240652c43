"""Ranked lexical search: every item of a query set against every document, exactly.

One pass over the texts counts terms, document frequencies and lengths, and keeps of each
document its length and how often it holds each term of the items. Scores are then found block
by block of documents. In a block every item's documents are grouped by presence mask, the set
of its terms they hold: a bit for each term, set for all documents of a term at once. A mask's
highest possible score is what its terms would give at their best places in the block. Masks
are evaluated by that score, highest first, some documents at a time, until it is below the last score of the item's list
so far: what is left can't enter it any more. Lists carry on from block to block of a task and
are merged in two steps, so no task sees more than a list of each task of its share.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from kinmart.llm.tokens import blocks_of
from kinmart.workspace import scratch, stage

#: Term weights are in thousandths, impacts in millionths; lengths count for three quarters.
WEIGHT, IMPACT, LENGTH_SHARE = 1000, 1_000_000_000, 75
#: Characters of items searched at a time, documents grouped at a time, lists merged first.
BLOCK_CHARS, BLOCK_DOCS, MERGED = 8 << 20, 8192, 256

#: A-Z are lowered, all other ASCII signs but letters and digits divide terms.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of one text, in order."""
    return (text or "").encode().translate(_LETTERS).split()


def numbered_terms(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct, which, starts): the terms of a block of texts, numbered, and where texts begin."""
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    low, high = int(offsets[0]), int(offsets[-1])
    plain = data[low:high].to_pybytes().translate(_LETTERS) if high > low else b""
    same = pa.StringArray.from_buffers(
        len(texts), pa.py_buffer((offsets - low).astype(np.int32)), pa.py_buffer(plain)
    )
    lists = pc.ascii_split_whitespace(same)
    numbered = lists.flatten().dictionary_encode()
    starts = lists.offsets.to_numpy(zero_copy_only=False)
    return (
        numbered.dictionary.to_pylist(),
        numbered.indices.to_numpy(zero_copy_only=False),
        starts - starts[0],
    )


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list]:
    """The items in blocks of about BLOCK_CHARS characters, one of them on the driver at a time."""
    rows = items.select(
        F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")
    ).where("text is not null")
    size = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-size // BLOCK_CHARS))
    for k in range(n):
        own = rows.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(n)) == k)
        yield [(r["item_id"], Counter(terms_of(r["text"]))) for r in own.collect()]


POSTINGS = "doc_id long, n long, terms binary, times binary, term long, df long"


def postings(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """Rows (doc_id, n, terms, times) of documents with terms, and (term, df) of each task; staged."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in POSTINGS.split(", ")]

    def batch_of(columns: list) -> pa.RecordBatch:
        n = max(len(c) for c in columns if c is not None)
        made = [pa.nulls(n, k) if c is None else c.cast(k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(made, names=names)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        df = np.zeros(len(known), np.int64)
        for batch in batches:
            at = 0
            for block in blocks_of(batch.column("text")):
                keys = batch.column("doc_id").slice(at, len(block))
                at += len(block)
                distinct, which, starts = numbered_terms(block)
                # An empty string is what splitting leaves at the ends of a text.
                numbers = np.fromiter(
                    (-2 if not t else known.get(t, -1) for t in distinct), np.int64, len(distinct)
                )[which]
                before = np.concatenate([[0], np.cumsum(numbers != -2)])
                n = np.diff(before[starts])
                own = np.repeat(np.arange(len(block)), np.diff(starts))[numbers >= 0]
                found, times = np.unique(
                    own * max(1, len(known)) + numbers[numbers >= 0], return_counts=True
                )
                doc, term = np.divmod(found, max(1, len(known)))
                df += np.bincount(term, minlength=len(df)) if len(df) else 0
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(block)))])
                offsets = pa.py_buffer((4 * ends).astype(np.int32))
                column = lambda values: pa.BinaryArray.from_buffers(
                    pa.binary(), len(block), [None, offsets, pa.py_buffer(values.astype("<u4"))]
                )
                made = batch_of([keys, pa.array(n), column(term), column(times), None, None])
                yield made.filter(pa.array(n > 0))
        held = np.flatnonzero(df)
        yield batch_of([None] * 4 + [pa.array(held), pa.array(df[held])])

    try:
        return stage(docs.select("doc_id", "text").mapInArrow(make, POSTINGS), "lexical-postings")
    finally:
        shared.destroy()


@dataclass(frozen=True)
class Query:
    """One item: its distinct terms and what a unit of impact of each is worth."""

    key: int
    item_id: int | None
    terms: np.ndarray
    worth: np.ndarray


class Best:
    """The first documents of an item so far, by score, then id; those without id come last."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.nulls, self.ids = (
            np.zeros(0, np.int64),
            np.zeros(0, bool),
            np.zeros(0, np.int64),
        )

    @property
    def least(self) -> int:
        """A score below this can't enter the list."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def offer(self, scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray) -> None:
        ok = scores >= max(1, self.least)
        scores = np.concatenate([self.scores, scores[ok]])
        nulls = np.concatenate([self.nulls, nulls[ok]])
        ids = np.concatenate([self.ids, ids[ok]])
        order = np.lexsort((ids, nulls, -scores))[: self.top]
        self.scores, self.nulls, self.ids = scores[order], nulls[order], ids[order]


class Block:
    """Some documents' postings, sorted by term, with the impact of each."""

    def __init__(self, ids, nulls, n, terms, times, doc, n_docs: int, n_terms: int):
        self.ids, self.nulls, self.size = ids, nulls, len(ids)
        if LENGTH_SHARE * int(n.max(initial=0)) * n_docs >= 1 << 63:
            n = n.astype(object)
        length = (100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // n_terms).astype(np.int64)
        impact = IMPACT * times // (1000 * times + 8 * length[doc])
        order = np.argsort(terms, kind="stable")
        self.terms, self.doc, self.impact = terms[order], doc[order], impact[order]
        self.seen = 0

    def search(self, query: Query, best: Best) -> None:
        """Offer to ``best`` every document of the block that may belong there."""
        low = np.searchsorted(self.terms, query.terms, "left")
        high = np.searchsorted(self.terms, query.terms, "right")
        held = np.flatnonzero(high > low)
        if not len(held):
            return
        low, high, worth = low[held], high[held], query.worth[held]
        peak = np.array([self.impact[a:b].max() for a, b in zip(low, high)], np.int64) * worth
        if int(peak.sum()) < best.least:
            return
        masks = np.zeros((-(-len(held) // 64), self.size), np.uint64)
        for k, (a, b) in enumerate(zip(low, high)):
            masks[k >> 6, self.doc[a:b]] |= np.uint64(1 << (k & 63))
        live = np.flatnonzero(masks.any(axis=0))
        group = np.zeros(len(live), np.int64)
        for word in masks[:, live]:
            distinct, number = np.unique(word, return_inverse=True)
            group = np.unique(group * len(distinct) + number, return_inverse=True)[1]
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(group[order]) > 0])
        shown = masks[:, live[order[starts]]]
        bound = np.zeros(len(starts), np.int64)
        for k in range(len(held)):
            bound += peak[k] * (shown[k >> 6] >> np.uint64(k & 63) & np.uint64(1)).astype(np.int64)
        ranked = np.argsort(-bound, kind="stable")
        counts = np.diff(np.r_[starts, len(order)])
        doc = np.concatenate([self.doc[a:b] for a, b in zip(low, high)])
        gain = np.concatenate([w * self.impact[a:b] for w, a, b in zip(worth, low, high)])
        held_by = np.cumsum(counts[ranked])
        at, wanted_docs = 0, best.top
        while at < len(ranked) and bound[ranked[at]] >= best.least:
            some = ranked[at : 1 + int(np.searchsorted(held_by, wanted_docs))]
            at += len(some)
            some = some[bound[some] >= best.least]
            places = np.repeat(starts[some] - np.cumsum(counts[some]) + counts[some], counts[some])
            chosen = live[order[places + np.arange(len(places))]]
            wanted = np.zeros(self.size, bool)
            wanted[chosen] = True
            part = wanted[doc]
            scores = np.zeros(self.size, np.int64)
            np.add.at(scores, doc[part], gain[part])
            best.offer(scores[chosen], self.nulls[chosen], self.ids[chosen])
            self.seen += len(chosen)
            wanted_docs = 4 * int(held_by[at - 1])


def blocks_from(batch: pa.RecordBatch, n_docs: int, n_terms: int) -> Iterator[Block]:
    for start in range(0, batch.num_rows, BLOCK_DOCS):
        part = batch.slice(start, BLOCK_DOCS)
        lists = [part.column(c).to_pylist() for c in ("terms", "times")]
        terms, times = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in lists)
        doc = np.repeat(np.arange(part.num_rows), [len(x) >> 2 for x in lists[0]])
        keys = part.column("doc_id")
        yield Block(
            pc.fill_null(keys, 0).to_numpy(zero_copy_only=False),
            keys.is_null().to_numpy(zero_copy_only=False),
            part.column("n").to_numpy(zero_copy_only=False),
            terms,
            times,
            doc,
            n_docs,
            n_terms,
        )


FOUND = "key long, item_id long, part int, doc_id long, score long"


def searched(held: DataFrame, queries: list[Query], n_docs: int, n_terms: int, top: int):
    """The first documents of each item; (item_id, rank, doc_id, score), staged."""
    spark = held.sparkSession
    shared = spark.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        lists = [Best(top) for _ in asked]
        for batch in batches:
            for block in blocks_from(batch, n_docs, n_terms):
                for query, best in zip(asked, lists):
                    block.search(query, best)
        rows = [
            (query.key, query.item_id, None if null else int(doc), int(score))
            for query, best in zip(asked, lists)
            for score, null, doc in zip(best.scores, best.nulls, best.ids)
        ]
        columns = [pa.array(list(x), pa.int64()) for x in zip(*rows)] or [pa.nulls(0, pa.int64())] * 4
        yield pa.RecordBatch.from_arrays(columns, names=["key", "item_id", "doc_id", "score"])

    found = held.select("doc_id", "n", "terms", "times").mapInArrow(
        search, "key long, item_id long, doc_id long, score long"
    )
    found = found.withColumn("part", F.spark_partition_id() % MERGED)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["key", "part"], ["key"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", place).where(F.col("rank") <= top)
    try:
        return stage(found.select("item_id", "rank", "doc_id", "score"), "lexical-found")
    finally:
        shared.destroy()


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` highest-scoring documents.

    Only scores above 0 count; equal scores are ranked by ascending id, documents without id
    last. Every row of either table is an item or document of its own, whatever its id. Null
    texts and texts without terms match nothing, and such documents are not counted. Other
    columns are not read. An empty table on either side gives no rows. Items are searched in
    blocks of bounded size, each against all documents.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    found = None
    for block in item_blocks(items, item_id, item_text):
        vocabulary = {t.decode(): k for k, t in enumerate(sorted({t for _, c in block for t in c}))}
        with scratch() as kept:
            made = postings(rows, vocabulary)
            held = made.where("n is not null")
            total = held.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms")).first()
            n_docs, n_terms = total["n"], total["terms"] or 0
            df = made.where("term is not null").groupBy("term").agg(F.sum("df").alias("df"))
            # At most one row for each term of the block of items.
            weights = np.zeros(len(vocabulary), np.int64)
            for row in df.collect():
                ratio = (2 * n_docs + 2) / (2 * row["df"] + 1)
                weights[row["term"]] = math.floor(WEIGHT * math.log(ratio))
            queries = []
            for key, (name, counts) in enumerate(block):
                terms = np.array(sorted(vocabulary[t.decode()] for t in counts), np.int64)
                times = np.zeros(len(vocabulary), np.int64)
                for t, n in counts.items():
                    times[vocabulary[t.decode()]] = n
                worth = times[terms] * weights[terms]
                queries.append(Query(key, name, terms[worth > 0], worth[worth > 0]))
            own = kept.keep(searched(held, queries, n_docs, n_terms, top))
        found = own if found is None else found.unionByName(own)
    return found
