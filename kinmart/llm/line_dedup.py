"""Line dedup over a growing and shrinking corpus: sharded cuckoo filters, exact counts behind.

The index holds three tables. ``postings`` has a row for each document and key, ``refs`` the
exact reference count of each key with its first and last document, ``filters`` one cuckoo
filter for each shard of the key space. A filter holds a key once if one document has it and
twice if more have, so it answers both "seen before?" and "repeated?" from two bytes a key;
only keys it lets through are looked up in ``refs``. Removing documents takes back their
counts and fingerprints, which restores the lines of those that follow them.

Keys are 128-bit hashes (two 64-bit integers) of the normalised line.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from kinmart.llm.cuckoo import CuckooFilter, Full
from kinmart.llm.files import giving_back, rows_of
from kinmart.workspace import stage

KEYS_PER_SHARD = 1 << 18
LEAST_SHARDS = 64
KEY = ["k1", "k2"]


def line_key(line: bytes, min_chars: int) -> tuple[int, int] | None:
    """Hash of the line, blanks stripped and A-Z lowered, or None if it is too short."""
    line = line.strip().lower()
    if len(line) < min_chars or (len(line) < 4 * min_chars and len(line.decode()) < min_chars):
        return None
    whole = xxhash.xxh3_128_intdigest(line)
    return (whole >> 64) - (1 << 63), (whole & (1 << 64) - 1) - (1 << 63)


def keys_of(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(doc_id, k1, k2): each key of a row once. Rows without id have none."""

    @giving_back
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, one, two = [], [], []
            for row in rows_of(batch):
                lines = set((row["text"] or "").encode().split(b"\n"))
                for key in {line_key(line, min_chars) for line in lines} - {None}:
                    ids.append(row["doc_id"])
                    one.append(key[0])
                    two.append(key[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (ids, one, two)], names=["doc_id", *KEY]
            )

    return (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        .where("doc_id is not null and length(text) >= 1")
        .mapInArrow(make, "doc_id long, k1 long, k2 long")
    )


def counted(postings: DataFrame) -> DataFrame:
    """Exact references of each key; summed in each task before the shuffle."""
    return postings.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("doc_id").alias("first"),
        F.max("doc_id").alias("last"),
    )


def copies():
    """Times a filter holds a key: once for one document, twice for more."""
    return F.when(F.col("n").isNull() | (F.col("n") <= 0), 0).when(
        F.col("first") < F.col("last"), 2
    ).otherwise(1)


@dataclass(frozen=True)
class LineIndex:
    """One state of the index. Changes return a new state and leave this one readable.

    A line belongs to the document with the smallest id that holds its key. Rows that share an
    id are one document. Documents without id are not indexed and keep all their lines. Keys of
    fewer than ``min_chars`` code points are never dropped.
    """

    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    min_chars: int = 10

    @classmethod
    def build(
        cls, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 10
    ) -> LineIndex:
        """The index of a first batch of documents, possibly none."""
        postings = stage(keys_of(docs, doc_id, text, min_chars), "line-postings")
        refs = stage(counted(postings), "line-refs")
        return cls(postings, refs, refs, 0, min_chars).with_new_filters()

    def with_new_filters(self) -> LineIndex:
        """Filters made anew from the exact counts, as many shards as the keys ask for."""
        shards = max(LEAST_SHARDS, -(-self.refs.count() // KEYS_PER_SHARD))
        spark = self.refs.sparkSession
        none = spark.range(shards).select(
            F.col("id").cast("int").alias("shard"), F.lit(None).cast("binary").alias("slots")
        )
        empty = replace(self, shards=shards, filters=none)
        return replace(empty, filters=empty.changed(self.refs.select(*KEY, copies().alias("d"))))

    def sharded(self, keys: DataFrame) -> DataFrame:
        return keys.withColumn("shard", F.pmod("k2", F.lit(self.shards)).cast("int"))

    def changed(self, deltas: DataFrame) -> DataFrame:
        """Filters after ``d`` more (or fewer) copies of each key; a full one is made larger."""

        def change(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            if not len(old):
                return pd.DataFrame({"shard": [], "slots": []})
            slots, hashes, d = old["slots"].iloc[0], keys["k1"].to_numpy(), keys["d"].to_numpy()
            more = np.repeat(hashes, np.maximum(d, 0))
            held = CuckooFilter.sized(len(more)) if slots is None else CuckooFilter.load(slots)
            held.remove(np.repeat(hashes, np.maximum(-d, 0)))
            while True:
                try:
                    held.insert(more)
                    return pd.DataFrame({"shard": old["shard"], "slots": [held.dump()]})
                except Full:
                    if slots is not None:
                        return pd.DataFrame({"shard": old["shard"], "slots": [b""]})
                    held = CuckooFilter(2 * len(held.table))

        return stage(
            self.filters.groupBy("shard")
            .cogroup(self.sharded(deltas).groupBy("shard"))
            .applyInPandas(change, "shard int, slots binary"),
            "line-filters",
        )

    def probe(self, keys: DataFrame, least: int) -> DataFrame:
        """Those of distinct ``keys`` that their filter holds at least so often."""

        def look(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            keys = keys[KEY]
            if not len(filters) or not len(keys):
                return keys
            held = CuckooFilter.load(filters["slots"].iloc[0])
            return keys[held.count(keys["k1"].to_numpy()) >= least]

        return (
            self.filters.groupBy("shard")
            .cogroup(self.sharded(keys).groupBy("shard"))
            .applyInPandas(look, "k1 long, k2 long")
        )

    def overfull(self) -> bool:
        return bool(self.filters.where("length(slots) = 0").limit(1).count())

    def settled(self, before: LineIndex, touched: DataFrame) -> LineIndex:
        """This state with filters brought up to date for ``touched``: keys, old and new counts."""
        if self.refs.count() > self.shards * KEYS_PER_SHARD:
            return self.with_new_filters()
        made = replace(self, filters=before.changed(touched))
        return made.with_new_filters() if made.overfull() else made

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
        """The state with more documents. Only keys the filters have seen meet the old counts."""
        batch = stage(keys_of(docs, doc_id, text, self.min_chars), "line-postings")
        added = stage(counted(batch), "line-refs")
        seen = self.probe(added.select(*KEY), 1)
        old = stage(self.refs.join(seen, KEY, "left_semi"), "line-met")
        both = old.unionByName(added).groupBy(*KEY)
        met = both.agg(
            F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")
        )
        met = stage(met, "line-refs")
        refs = stage(self.refs.join(old, KEY, "left_anti").unionByName(met), "line-refs")
        deltas = met.select(*KEY, copies().alias("now")).join(
            old.select(*KEY, copies().alias("was")), KEY, "left"
        )
        deltas = deltas.select(*KEY, (F.col("now") - F.coalesce("was", F.lit(0))).alias("d"))
        state = replace(self, postings=self.postings.unionByName(batch), refs=refs)
        return state.settled(self, deltas.where("d <> 0"))

    def delete(self, doc_ids: DataFrame, doc_id: str = "doc_id") -> LineIndex:
        """The state without these documents, as if they had never been inserted."""
        gone = doc_ids.select(F.col(doc_id).cast("long").alias("doc_id")).distinct()
        gone = stage(gone, "line-gone")
        touched = self.postings.join(gone, "doc_id", "left_semi").select(*KEY).distinct()
        touched = stage(touched, "line-touched")
        postings = stage(self.postings.join(gone, "doc_id", "left_anti"), "line-postings")
        met = stage(counted(postings.join(touched, KEY, "left_semi")), "line-refs")
        rest = self.refs.join(touched, KEY, "left_anti")
        refs = stage(rest.unionByName(met), "line-refs")
        was = self.refs.join(touched, KEY, "left_semi").select(*KEY, copies().alias("was"))
        deltas = was.join(met.select(*KEY, copies().alias("now")), KEY, "left")
        deltas = deltas.select(*KEY, (F.coalesce("now", F.lit(0)) - F.col("was")).alias("d"))
        return replace(self, postings=postings, refs=refs).settled(self, deltas.where("d <> 0"))

    def repeated(self, keys: DataFrame) -> DataFrame:
        """(k1, k2, first): those of ``keys`` that more than one document holds, exactly."""
        candidates = self.probe(keys.select(*KEY).distinct(), 2)
        shared = self.refs.where("first < last").select(*KEY, "first")
        return shared.join(candidates, KEY, "left_semi")

    def clean(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Documents without the lines that an earlier document owns.

        Returns (doc_id, text, n_lines, n_dropped, row), where ``text`` holds the kept lines
        joined by line feeds and ``row`` the other columns as they came. A null or empty text is
        one empty line. Lines of one key inside the owning document all stay.
        """
        keys = keys_of(docs, doc_id, text, self.min_chars)
        shared = stage(self.repeated(keys), "line-shared")
        drops = (
            keys.join(shared, KEY)
            .where(F.col("first") < F.col("doc_id"))
            .groupBy("doc_id")
            .agg(F.collect_list(F.struct(*KEY)).alias("drops"))
        )
        drops = stage(drops, "line-drops")
        rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
        whole = docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            F.col(text).cast("string").alias("text"),
            F.struct(*rest).alias("row"),
        )
        joined = whole.join(drops, "doc_id", "left").select("doc_id", "text", "drops", "row")
        min_chars = self.min_chars
        schema = whole.select(
            "doc_id",
            "text",
            F.lit(0).cast("long").alias("n_lines"),
            F.lit(0).cast("long").alias("n_dropped"),
            "row",
        ).schema

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept, n_lines, n_dropped = [], [], []
                for row in rows_of(batch.select(["text", "drops"])):
                    lines = (row["text"] or "").split("\n")
                    stay = lines
                    if row["drops"]:
                        drops = {(x["k1"], x["k2"]) for x in row["drops"]}
                        stay = [x for x in lines if line_key(x.encode(), min_chars) not in drops]
                    kept.append("\n".join(stay))
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(stay))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(kept, pa.string()),
                        pa.array(n_lines, pa.int64()),
                        pa.array(n_dropped, pa.int64()),
                        batch.column("row"),
                    ],
                    names=["doc_id", "text", "n_lines", "n_dropped", "row"],
                )

        return joined.mapInArrow(cut, schema)
