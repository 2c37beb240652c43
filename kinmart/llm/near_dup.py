"""Near duplicates: one-permutation MinHash, banded buckets, star-shaped candidate edges.

A document's set of word shingles is hashed once. The hash range is cut into bins, a bin keeps
its least value, and an empty bin borrows from the first non-empty one in a fixed random order
of its own (optimal densification). Bands of bins give buckets. In a bucket only the edges from
its first document to the others become candidates, so a bucket of m documents asks for m - 1
checks. Links are confirmed on the full sets.

Stars alone can miss a link between two members that are both unlike the star's centre. So
documents in buckets that still hold more than one component after the stars are looked at
again, through an exact prefix filter: with shingles in one order for all, rare ones first, two
sets of n and m shingles that are similar enough share one of the first n - ceil(0.8 n) + 1 of
the one and of the other. Only pairs of two components that share such a rare shingle are
checked. Pages that share a template and little else share none. A shingle that is rare for
very many documents of several components is worked off in blocks: every document outside its
largest component meets the others that share a bucket with it. After that every pair with a
common bucket is either confirmed, refuted or in one component.

With the default 32 bands of 5 rows, a pair at similarity 0.8 shares no bucket with a
probability of 3e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from kinmart.llm.components import components
from kinmart.llm.files import giving_back, rows_of
from kinmart.workspace import scratch, stage

ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
PROBES = 4096
#: Documents and bytes of sets in a block, on either side.
BLOCK, BLOCK_BYTES = 512, 16 << 20
#: Counters of how often shingles occur, and the longest list of documents of a rare shingle
#: whose pairs are named one by one.
COUNTERS, SHORT = 1 << 18, 128


@dataclass(frozen=True)
class NearDup:
    """``words`` a shingle, ``percent`` the least similarity, ``bands`` x ``rows`` bins."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5

    @property
    def bins(self) -> int:
        return self.bands * self.rows


@lru_cache(maxsize=4)
def probe_order(bins: int) -> np.ndarray:
    """For each bin (column) the order in which it asks others when it is empty."""
    return np.random.default_rng(20_170_806).integers(0, bins, (PROBES, bins))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * ODD[0]
    return h ^ (h >> np.uint64(29))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; of the whole sequence if it is shorter."""
    parts = text.encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    n = max(1, len(h) - words + 1)
    made = np.full(n, min(words, len(h)), np.uint64)
    for k in range(min(words, len(h))):
        made = mixed(made * ODD[1] + h[k : k + n])
    return np.unique(made)


def sketch(values: np.ndarray, bins: int) -> np.ndarray:
    """Least value of every bin of a sorted, non-empty set, empty bins filled."""
    at = (((values >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    found, full = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    full[at[starts]] = True
    found[at[starts]] = np.minimum.reduceat(values & np.uint64(0xFFFFFFFF), starts)
    empty, order = np.flatnonzero(~full), probe_order(bins)
    for t in range(0, PROBES, 64):
        if not len(empty):
            return found
        asked = order[t : t + 64, empty]
        holds = full[asked]
        some = holds.any(axis=0)
        first = asked[holds.argmax(axis=0), np.arange(len(empty))]
        found[empty[some]] = found[first[some]]
        empty = empty[~some]
    found[empty] = found[at[0]]
    return found


def band_keys(values: np.ndarray, job: NearDup) -> np.ndarray:
    """One 64-bit bucket for each band."""
    if not len(values):
        return np.zeros(0, np.int64)
    parts = sketch(values, job.bins).reshape(job.bands, job.rows)
    h = (np.arange(job.bands, dtype=np.uint64) + np.uint64(1)) * ODD[1]
    for k in range(job.rows):
        h = mixed(h ^ (parts[:, k] * ODD[1]))
    return h.view(np.int64)


def set_hash(values: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(values.tobytes())
    return (whole >> 64) - (1 << 63), (whole & (1 << 64) - 1) - (1 << 63)


def features(docs: DataFrame, job: NearDup, doc_id: str, text: str) -> DataFrame:
    """(node, doc_id, hash, n_shingles, s1, s2, bands), staged; a node is one row of ``docs``."""

    @giving_back
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in rows_of(batch.select(["text"])):
                values = shingles(row["text"] or "", job.words)
                out.append((len(values), *set_hash(values), band_keys(values, job).tobytes()))
            columns = list(zip(*out)) or [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("doc_id"), batch.column("hash")]
                + [pa.array(x, k) for x, k in zip(columns, kinds)],
                names=["node", "doc_id", "hash", "n_shingles", "s1", "s2", "bands"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("node"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text).cast("string")).alias("hash"),
        F.col(text).cast("string").alias("text"),
    )
    schema = "node long, doc_id long, hash long, n_shingles long, s1 long, s2 long, bands binary"
    return stage(rows.mapInArrow(make, schema), "dup-features")


def bucket_rows(found: DataFrame) -> DataFrame:
    """(key, node): a row for each band."""

    @giving_back
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            parts = [np.frombuffer(x.as_py(), np.int64) for x in batch.column("bands")]
            keys = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            repeated = np.repeat(nodes, [len(x) for x in parts])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(repeated.astype(np.int64))], names=["key", "node"]
            )

    return found.select("node", "bands").mapInArrow(split, "key long, node long")


class Forest:
    """Union of a few thousand nodes inside one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (above := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(above, above)
            x = above
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.root(a)] = self.root(b)


def confirmed(left: list, right: list, percent: int) -> list[tuple[int, int]]:
    """Links between two lists of (node, root, values, bands) that join different components.

    Pairs are checked if they share a bucket and are not connected yet.
    """
    forest, links = Forest(), []
    for node, root, _, _ in [*left, *right]:
        forest.join(node, -1 - root)
    bands = np.array([x[3] for x in right])
    sizes = np.array([len(x[2]) for x in right])
    for node, _, values, own in left:
        n = len(values)
        fits = (100 * np.minimum(sizes, n) >= percent * np.maximum(sizes, n)).nonzero()[0]
        meets = fits[(bands[fits] == own).any(axis=1)]
        for k in meets.tolist():
            other, _, theirs, _ = right[k]
            if forest.root(node) == forest.root(other):
                continue
            both = np.concatenate([values, theirs])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            if 100 * shared >= percent * (n + len(theirs) - shared):
                links.append((node, other))
                forest.join(node, other)
    return links


def compare(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): confirmed links of (block, is_left, node, root) rows, staged.

    A block holds some hundred rows and megabytes on either side, whatever the size of a group.
    """

    def check(group: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for flag in (True, False):
            rows = group[group["is_left"] == flag]
            sides.append(
                [
                    (int(n), int(r), np.frombuffer(v, np.uint64), np.frombuffer(b, np.int64))
                    for n, r, v, b in zip(rows["node"], rows["root"], rows["vals"], rows["bands"])
                ]
            )
        links = confirmed(*sides, percent) if sides[0] and sides[1] else []
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    joined = blocks.join(sets, "node")
    return stage(joined.groupBy("block").applyInPandas(check, "a long, b long"), "dup-links")


def candidate_sets(
    docs: DataFrame, wanted: DataFrame, job: NearDup, doc_id: str, text: str
) -> DataFrame:
    """(node, vals, bands) of the documents that have a candidate partner, staged.

    Made again from the text, so that only these sets are ever stored. Rows find their node by
    id and hash of the text; of rows that repeat both, which follow each other, one is taken.
    """

    @giving_back
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            out = []
            for row in rows_of(batch):
                if row["node"] == last:
                    continue
                values = shingles(row["text"] or "", job.words)
                if set_hash(values) == (row["s1"], row["s2"]):
                    last = row["node"]
                    out.append((last, values.tobytes(), band_keys(values, job).tobytes()))
            columns = list(zip(*out)) or [[]] * 3
            kinds = [pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds)], names=["node", "vals", "bands"]
            )

    whole = F.col(text).cast("string")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.xxhash64(whole).alias("h"), whole.alias("text")
    )
    # Texts always travel by id here: what is wanted grows with the corpus.
    same = rows["id"].eqNullSafe(wanted["doc_id"]) & (rows["h"] == wanted["hash"])
    met = rows.join(wanted.hint("merge"), same)
    made = met.select("node", "s1", "s2", "text")
    return stage(made.mapInArrow(make, "node long, vals binary, bands binary"), "dup-sets")


def blocks_for(count, size):
    """How many blocks hold so many rows of so many bytes of sets."""
    return F.greatest(F.ceil(count / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")


def star_blocks(buckets: DataFrame, sizes: DataFrame) -> DataFrame:
    """The first document of each bucket against the others, in blocks of members."""
    edges = buckets.where("node <> centre").select("centre", "node").distinct()
    edges = edges.join(sizes, "node").withColumn("part", F.pmod(F.xxhash64("node"), F.lit(1 << 20)))
    edges = stage(edges, "dup-edges")
    parts = blocks_for(F.count(F.lit(1)), F.sum("size")).alias("parts")
    edges = edges.join(stage(edges.groupBy("centre").agg(parts), "dup-centres"), "centre")
    edges = stage(edges, "dup-stars")
    block = F.concat_ws(".", "centre", F.col("part") % F.col("parts"))
    members = edges.select(
        block.alias("block"), F.lit(False).alias("is_left"), "node", F.col("node").alias("root")
    )
    centres = edges.select(
        block.alias("block"),
        F.lit(True).alias("is_left"),
        F.col("centre").alias("node"),
        F.col("centre").alias("root"),
    ).distinct()
    return members.unionByName(centres)


def undecided(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) of the documents in buckets that hold several components, staged."""
    known = buckets.join(roots, "node", "left").select(
        "key", "node", F.coalesce("root", "node").alias("root")
    )
    known = stage(known, "dup-known")
    spread = known.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")
    )
    spread = stage(spread.where("low < high and n > 2").select("key"), "dup-open")
    return stage(known.join(spread, "key").select("node", "root").distinct(), "dup-held")


def counter_of(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(46)).astype(np.int64)


def rare_shingles(held: DataFrame, percent: int) -> DataFrame:
    """(shingle, node, root, n): the shingles in each set's prefix, rare ones first; staged.

    Shingles are ordered by how often the counter they fall on is hit, then by value: one
    order for all sets, with counters of a fixed number whatever the corpus holds.
    """

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for values in batch.column("vals"):
                at = counter_of(np.frombuffer(values.as_py(), np.uint64))
                hits += np.bincount(at, minlength=COUNTERS) if len(at) > COUNTERS // 8 else 0
                if len(at) <= COUNTERS // 8:
                    np.add.at(hits, at, 1)
        used = np.flatnonzero(hits)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(hits[used])], ["at", "hits"])

    counted = held.select("vals").mapInArrow(count, "at long, hits long")
    summed = counted.groupBy("at").agg(F.sum("hits").alias("hits")).toArrow()
    table = np.zeros(COUNTERS, np.int64)
    table[summed.column("at").to_numpy()] = summed.column("hits").to_numpy()
    shared = held.sparkSession.sparkContext.broadcast(table)

    @giving_back
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                first, sizes = [], []
                for values in part.column("vals"):
                    own = np.frombuffer(values.as_py(), np.uint64)
                    n = len(own)
                    order = np.argsort(hits[counter_of(own)], kind="stable")
                    first.append(own[order[: n - -(-percent * n // 100) + 1]])
                    sizes.append(n)
                counts = [len(x) for x in first]
                columns = [np.concatenate(first).view(np.int64)]
                columns += [
                    np.repeat(part.column(c).to_numpy(zero_copy_only=False), counts)
                    for c in ("node", "root")
                ]
                columns.append(np.repeat(np.array(sizes, np.int64), counts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["shingle", "node", "root", "n"]
                )

    made = held.select("node", "root", "vals").mapInArrow(
        prefixes, "shingle long, node long, root long, n long"
    )
    try:
        return stage(made, "dup-rare")
    finally:
        shared.destroy()


def short_lists(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of two components on a list of at most SHORT documents, of fitting sizes."""

    def pairs_of(group: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
        node, root, n = (np.concatenate(x) for x in group)
        a, b = np.triu_indices(len(node), 1)
        low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        fits = (root[a] != root[b]) & (100 * low >= percent * high)
        a, b = node[a[fits]], node[b[fits]]
        return np.minimum(a, b), np.maximum(a, b)

    @giving_back
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, out = None, ([], [], []), []

        def done(least: int) -> Iterator[pa.RecordBatch]:
            if sum(len(x[0]) for x in out) > least:
                columns = [pa.array(np.concatenate(x)) for x in zip(*out)]
                out.clear()
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("shingle").to_numpy()
            columns = [batch.column(c).to_numpy() for c in ("node", "root", "n")]
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for low, high in zip(cuts, cuts[1:]):
                if at is not None and keys[low] != at:
                    out.append(pairs_of(held))
                    held = ([], [], [])
                at = keys[low]
                for kept, column in zip(held, columns):
                    kept.append(column[low:high])
            yield from done(1 << 16)
        if at is not None:
            out.append(pairs_of(held))
        yield from done(0)

    dealt = lists.repartition("shingle").sortWithinPartitions("shingle")
    made = dealt.select("shingle", "node", "root", "n").mapInArrow(pair, "a long, b long")
    return stage(made.distinct(), "dup-pairs")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs that are similar enough on their full sets."""

    @giving_back
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for left, right in zip(batch.column("x"), batch.column("y")):
                one, two = (np.frombuffer(v.as_py(), np.uint64) for v in (left, right))
                both = np.concatenate([one, two])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                ok.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("vals").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("vals").alias("y"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(check, "a long, b long")


def list_blocks(lists: DataFrame) -> DataFrame:
    """Long lists in blocks: each document outside a list's largest component meets them all."""
    rows = lists.select(F.col("shingle").alias("list"), "node", "root", (8 * F.col("n")).alias("size"))
    rows = stage(rows, "dup-rows")
    counts = rows.groupBy("list", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    main = counts.groupBy("list").agg(
        F.sum("n").alias("all"),
        F.sum("size").alias("all_size"),
        F.max_by(F.struct("root", "n", "size"), F.struct("n", "root")).alias("main"),
    )
    main = main.select(
        "list",
        F.col("main.root").alias("main"),
        blocks_for(F.col("all"), F.col("all_size")).alias("rights"),
        blocks_for(F.col("all") - F.col("main.n"), F.col("all_size") - F.col("main.size")).alias("lefts"),
    )
    rows = stage(rows.join(stage(main, "dup-main"), "list"), "dup-rows")
    place = F.xxhash64("node")
    name = lambda left, right: F.concat_ws(".", "list", left, right)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    right = rows.select("*", every("lefts").alias("l")).select(
        name(F.col("l"), F.pmod(place, F.col("rights"))).alias("block"),
        F.lit(False).alias("is_left"),
        "node",
        "root",
    )
    minor = rows.where("root <> main").select("*", every("rights").alias("r"))
    left = minor.select(
        name(F.pmod(place, F.col("lefts")), F.col("r")).alias("block"),
        F.lit(True).alias("is_left"),
        "node",
        "root",
    )
    return left.unionByName(right)


def closing_links(buckets: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): what stars can't decide, the links between documents of several components."""
    held = sets.join(undecided(buckets, roots), "node")
    rare = rare_shingles(held, percent)
    lists = rare.groupBy("shingle").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("m")
    )
    lists = stage(lists.where("low < high").select("shingle", "m"), "dup-lists")
    rows = stage(rare.join(lists, "shingle"), "dup-listed")
    pairs = short_lists(rows.where(F.col("m") <= SHORT), percent)
    near = verified(pairs, sets, percent)
    return near.unionByName(compare(list_blocks(rows.where(F.col("m") > SHORT)), sets, percent))


def near_duplicates(
    docs: DataFrame, job: NearDup = NearDup(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    ``component_id`` is the smallest id that links reach from the row, itself included, and a
    row is kept if that is its own. Rows of equal sets are one node in all that follows and
    are linked without a check. A text without words, or null, is linked with nothing. Rows
    without id take part and are kept only if no row with an id is reached; rows that repeat
    an id and text are kept together. An empty table gives no rows.
    """
    with scratch() as held:
        return held.keep(stage(_near_duplicates(docs, job, doc_id, text), "near-dup"))


def _near_duplicates(docs: DataFrame, job: NearDup, doc_id: str, text: str) -> DataFrame:
    found = features(docs, job, doc_id, text)
    filled = found.where("n_shingles > 0")
    copies = filled.groupBy("s1", "s2").agg(
        F.min("node").alias("rep"), F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")
    )
    copies = stage(copies, "dup-copies")
    several = copies.where("n > 1").select("s1", "s2", "rep")
    repeats = filled.join(several, ["s1", "s2"]).where("node <> rep").select("node")
    distinct = filled.select("node", "bands").join(stage(repeats, "dup-repeats"), "node", "left_anti")
    rows = bucket_rows(distinct)
    shared = rows.groupBy("key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
    shared = stage(shared.where("n > 1").select("key", "centre"), "dup-shared")
    buckets = stage(rows.join(shared.hint("merge"), "key"), "dup-buckets")
    wanted = filled.join(buckets.select("node").distinct(), "node", "left_semi")
    wanted = wanted.select("node", "doc_id", "hash", "s1", "s2", (8 * F.col("n_shingles")).alias("size"))
    wanted = stage(wanted, "dup-wanted")
    sets = candidate_sets(docs, wanted, job, doc_id, text)
    links = compare(star_blocks(buckets, wanted.select("node", "size")), sets, job.percent)
    roots = stage(components(links, "a", "b"), "dup-roots")
    more = closing_links(buckets, roots, sets, job.percent)
    chain = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
    roots = stage(components(chain, "a", "b"), "dup-roots")
    lows = copies.select(F.col("rep").alias("node"), "s1", "s2", "low").join(roots, "node", "left")
    lows = lows.select("s1", "s2", "low", F.coalesce("root", "node").alias("root"))
    least = lows.groupBy("root").agg(F.min("low").alias("component_id"))
    named = lows.join(stage(least, "dup-least"), "root").select("s1", "s2", "component_id")
    named = stage(named, "dup-named")
    plain = found.select("doc_id", "n_shingles", "s1", "s2")
    full = plain.where("n_shingles > 0").join(named, ["s1", "s2"])
    bare = plain.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    both = full.select(bare.columns).unionByName(bare)
    return both.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
