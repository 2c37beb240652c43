"""Prefix trie of conversations: what a set of conversations shares turn by turn.

A conversation is the sequence of its turns' keys (128-bit hashes of role and text). The
sequences are range-partitioned in byte order, those that are equal by conversation, so that
even one sequence that a third of all conversations repeat lies in many tasks. A task cuts its
sorted rows into shards of bounded size. In a shard the keys are dictionary-encoded in their
order and the distinct sequences inserted into a ternary search tree, the median first, so the
siblings of a node form a balanced tree. One pass over the nodes, children before parents,
accumulates members, leaves and savings without recursion.

Only nodes on the paths of a shard's first and last sequence can continue in other shards.
These boundary nodes are merged by key of their prefix: counts add up, a node that several
shards hold is counted once as a leaf and for its own saving (in the first shard that holds
it), and sums along the two paths of each shard carry this up to all ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from kinmart.workspace import stage

WORD = r"[^\x20\x09-\x0D]+"
KEY_BYTES = 16
SHARD_TURNS = 1 << 18
PIECE_IDS = 8192
NOTHING = hashlib.sha256().hexdigest()
BOTH, FIRST, LAST = 0, 1, 2


def turn_lists(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, turns): a conversation's turns in order, each (turn, key, words).

    Null turns come first, equal ones are ordered by key. A null role or text is empty. Rows
    without ``conv_id`` belong to no conversation. A conversation is one row of 40 bytes a turn.
    """
    said, who = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    key = F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said))
    words = F.regexp_count(said, F.lit(WORD)).cast("int")
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(F.col(turn).cast("long").alias("turn"), key.alias("key"), words.alias("words")).alias("t"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(lists: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations that open with turns of another: ``lists`` with their first turns replaced.

    Conversation c takes its first h turns from conversation c - c % every (all if there are
    fewer, none if there is no such one) and the rest from its own after the first h, where h is
    crc32(decimal c) % most.
    """
    own, h = F.col("conv_id"), (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    heads = lists.where(own % every == 0).select(
        own.alias("base"), F.slice("turns", 1, max(1, most - 1)).alias("head")
    )
    joined = lists.withColumn("base", own - own % every).join(heads, "base", "left")
    head = F.when(F.col("head").isNotNull() & (h > 0), F.slice("head", F.lit(1), h))
    rest = F.slice("turns", h + 1, F.size("turns") + 1)
    none = F.slice("turns", 1, 0)
    return joined.select("conv_id", F.concat(F.coalesce(head, none), rest).alias("turns"))


class SearchTree:
    """A ternary search tree: a node's ``down`` is a binary tree of its children by turn id."""

    def __init__(self):
        self.key, self.left, self.right, self.down, self.up = [-1], [-1], [-1], [-1], [-1]
        self.depth = [0]

    def _new(self, key: int, up: int) -> int:
        for column, value in (
            (self.key, key), (self.left, -1), (self.right, -1), (self.down, -1), (self.up, up)
        ):
            column.append(value)
        self.depth.append(self.depth[up] + 1)
        return len(self.key) - 1

    def insert(self, sequence: list[int]) -> list[int]:
        """The nodes of the sequence from the root on, made where there are none."""
        at, path = 0, [0]
        for key in sequence:
            node, above, side = self.down[at], at, self.down
            while node >= 0 and self.key[node] != key:
                side = self.left if key < self.key[node] else self.right
                node, above = side[node], node
            if node < 0:
                node = side[above] = self._new(key, at)
            path.append(node)
            at = node
        return path


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of each stretch before its halves."""
    open_ = [(0, n)]
    while open_:
        low, high = open_.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            open_ += [(middle + 1, high), (low, middle)]


SHARD = (
    "kind string, shard long, prefix binary, parent binary, path int, depth long, conv_id long, "
    "parent_conv_id long, n_convs long, n_words long, n_children long, n_leaves long, "
    "saved long, ends string, serial long"
)


def joined_ids(ids: list[int]) -> str:
    return ",".join(map(str, ids))


def shard_rows(shard: int, paths: list[bytes], words: list, convs: list[int]) -> Iterator[tuple]:
    """The nodes of one shard: whole ones, parts of boundary nodes, and who ends at the latter.

    ``paths`` are sorted, and equal ones by conversation.
    """
    starts = [k for k in range(len(paths)) if not k or paths[k] != paths[k - 1]]
    ends_of = dict(zip(starts, [*starts[1:], len(paths)]))
    keys = b"".join(paths[k] for k in starts)
    flat = np.frombuffer(keys, f"V{KEY_BYTES}") if keys else np.zeros(0)
    ids = np.unique(flat, return_inverse=True)[1].tolist()
    cuts = np.cumsum([0] + [len(paths[k]) // KEY_BYTES for k in starts]).tolist()
    tree, tails, n_words = SearchTree(), {}, [0]
    first = last = [0]
    for j in medians(len(starts)):
        k = starts[j]
        path = tree.insert(ids[cuts[j] : cuts[j + 1]])
        own = words[k]
        n_words.extend(own[len(path) - 1 - (len(tree.key) - len(n_words)) : len(path) - 1])
        tails[path[-1]] = convs[k : ends_of[k]]
        first, last = path if j == 0 else first, path if j == len(starts) - 1 else last
    size = len(tree.key)
    n_convs, low, leaves, saved, kids = ([0] * size for _ in range(5))
    low = [None] * size
    inner_kids, inner_leaves, inner_saved = ([0] * size for _ in range(3))
    shared = len([1 for a, b in zip(first, last) if a == b])
    place = {node: (FIRST, k) for k, node in enumerate(first)}
    place |= {node: (BOTH if k < shared else LAST, k) for k, node in enumerate(last)}
    # Parents are always made before their children.
    for node in range(size - 1, -1, -1):
        ends = tails.get(node, ())
        n_convs[node] += len(ends)
        if ends and (low[node] is None or ends[0] < low[node]):
            low[node] = ends[0]
        if not kids[node]:
            leaves[node] = 1
        saved[node] += (n_convs[node] - 1) * n_words[node]
        up = tree.up[node]
        if up < 0:
            continue
        kids[up] += 1
        n_convs[up] += n_convs[node]
        leaves[up] += leaves[node]
        saved[up] += saved[node]
        if low[up] is None or low[node] < low[up]:
            low[up] = low[node]
        if node not in place:
            inner_kids[up] += 1
            inner_leaves[up] += leaves[node]
            inner_saved[up] += saved[node]
    prefixes = {}
    for path, k in ((first, starts[0]), (last, starts[-1])):
        running = xxhash.xxh3_128()
        for depth, node in enumerate(path):
            if depth:
                running.update(paths[k][(depth - 1) * KEY_BYTES : depth * KEY_BYTES])
            prefixes[node] = running.digest()
    for node in range(size):
        ends, up = tails.get(node, ()), tree.up[node]
        if node not in place:
            inside = up not in place
            yield (
                "node", shard, None, None if inside else prefixes[up], None, tree.depth[node],
                low[node], low[up] if inside else None, n_convs[node], None, kids[node],
                leaves[node], saved[node],
                hashlib.sha256(joined_ids(ends).encode()).hexdigest() if ends else NOTHING, None,
            )
            continue
        yield (
            "part", shard, prefixes[node], prefixes[up] if up >= 0 else None, place[node][0],
            tree.depth[node], low[node], None, n_convs[node], n_words[node], inner_kids[node],
            inner_leaves[node], inner_saved[node], None, None,
        )
        for serial in range(0, len(ends), PIECE_IDS):
            yield (
                "ends", shard, prefixes[node], *[None] * 10,
                joined_ids(ends[serial : serial + PIECE_IDS]), serial,
            )


def shards(lists: DataFrame, shard_turns: int) -> DataFrame:
    """Rows of all shards, staged."""
    kinds = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}
    fields = [part.split() for part in SHARD.split(", ")]

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(x), kinds[kind]) for x, (_, kind) in zip(zip(*rows), fields)],
            names=[name for name, _ in fields],
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, serial = TaskContext.get().partitionId() << 32, 0
        paths, words, convs, held = [], [], [], 0

        def done() -> Iterator[pa.RecordBatch]:
            rows = []
            for row in shard_rows(base + serial, paths, words, convs):
                rows.append(row)
                if len(rows) == 1 << 14:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

        for batch in batches:
            columns = (batch.column(c) for c in ("path", "words", "conv_id"))
            for path, own, conv in zip(*columns):
                paths.append(path.as_py())
                words.append(own.as_py())
                convs.append(conv.as_py())
                held += 1 + len(words[-1])
                if held >= shard_turns:
                    yield from done()
                    serial += 1
                    paths, words, convs, held = [], [], [], 0
        if paths:
            yield from done()

    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), ""))
    words = F.transform("turns", lambda t: t["words"])
    rows = lists.select("conv_id", path.alias("path"), words.alias("words"))
    ranged = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    return stage(ranged.mapInArrow(build, SHARD), "trie-shards")


def ends_hashes(pieces: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of boundary nodes: pieces of ids hashed in order, one at a time."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running, out = None, None, []
        for batch in batches:
            for prefix, ends in zip(batch.column("prefix"), batch.column("ends")):
                if at is None or prefix.as_py() != at:
                    if at is not None:
                        out.append((at, running.hexdigest()))
                    at, running = prefix.as_py(), hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ends.as_py().encode())
        if at is not None:
            out.append((at, running.hexdigest()))
        columns = list(zip(*out)) or [(), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(columns[0]), pa.binary()), pa.array(list(columns[1]), pa.string())],
            names=["prefix", "ends_sha256"],
        )

    ordered = pieces.select("prefix", "shard", "serial", "ends").repartition("prefix")
    ordered = ordered.sortWithinPartitions("prefix", "shard", "serial")
    return ordered.select("prefix", "ends").mapInArrow(digest, "prefix binary, ends_sha256 string")


def merged_boundaries(parts: DataFrame, pieces: DataFrame) -> DataFrame:
    """Boundary nodes, whole, with ``prefix``; staged."""
    total = lambda c: F.sum(c).alias(c)
    merged = parts.groupBy("prefix").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.max("n_words").alias("n_words"),
        F.min("shard").alias("owner"),
        total("n_convs"),
        total("n_children"),
    )
    merged = stage(merged, "trie-merged")
    kids = merged.groupBy(F.col("parent").alias("prefix")).agg(F.count(F.lit(1)).alias("kids"))
    merged = merged.join(kids, "prefix", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))
    )
    merged = stage(
        merged.select(
            "prefix", "parent", "depth", "conv_id", "owner", "n_convs", "n_children",
            (F.col("n_children") == 0).cast("long").alias("own_leaf"),
            ((F.col("n_convs") - 1) * F.col("n_words")).alias("own_saved"),
        ),
        "trie-merged",
    )
    own = merged.select("prefix", "owner", "own_leaf", "own_saved")
    held = parts.select("prefix", "shard", "path", "depth", "n_leaves", "saved").join(own, "prefix")
    mine = F.col("owner") == F.col("shard")
    values = {
        "n_leaves": F.col("n_leaves") + F.when(mine, F.col("own_leaf")).otherwise(0),
        "saved": F.col("saved") + F.when(mine, F.col("own_saved")).otherwise(0),
    }
    held = held.select("prefix", "shard", "path", "depth", *(v.alias(k) for k, v in values.items()))
    # A shard's boundary nodes lie on two paths, no longer than its longest conversation.
    below = Window.partitionBy("shard", "path").orderBy(F.desc("depth"))
    below = below.rowsBetween(Window.unboundedPreceding, 0)
    branches = Window.partitionBy("shard")

    def reached(c: str):
        apart = F.sum(F.when(F.col("path") != BOTH, F.col(c)).otherwise(0)).over(branches)
        return F.sum(c).over(below) + F.when(F.col("path") == BOTH, apart).otherwise(0)

    sums = held.select("prefix", *(reached(c).alias(c) for c in values))
    sums = sums.groupBy("prefix").agg(total("n_leaves"), total("saved"))
    parents = merged.select(
        F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    whole = merged.join(sums, "prefix").join(ends_hashes(pieces), "prefix", "left")
    whole = whole.join(parents, "parent", "left")
    ends = F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")
    return stage(
        whole.select(
            "prefix", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            F.col("saved").alias("saved_tokens"), ends,
        ),
        "trie-boundary",
    )


def prefix_trie(lists: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    One row for each node of the trie of ``lists``, as ``turn_lists`` makes them: each distinct
    sequence of first ``depth`` turns, from the root without turns on. ``conv_id`` is its least
    member, so node and depth name its text. ``n_leaves`` and ``saved_tokens`` are sums over its
    subtree, the latter of (members - 1) x words of a node's last text: what is saved if shared
    turns are kept once. ``ends_sha256`` is the hash of the ids that end there, in order and
    comma-joined. A conversation without turns ends at the root. An empty table gives no rows.

    A shard holds ``shard_turns`` turns or one conversation. The ids that end at one node pass
    one hash in order, as the definition asks, in pieces of some thousand ids.
    """
    held = shards(lists, shard_turns)
    boundary = merged_boundaries(
        held.where("kind = 'part'"), held.where("kind = 'ends'")
    )
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    nodes = held.where("kind = 'node'").select(
        "shard", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
    inner = nodes.where("parent is null").select(columns)
    # Children of a boundary node find it by shard, so a node of very many children is no hot key.
    known = held.where("kind = 'part'").select("shard", "prefix").join(
        boundary.select("prefix", F.col("conv_id").alias("above")), "prefix"
    )
    known = stage(known.withColumnRenamed("prefix", "parent"), "trie-parents")
    outer = nodes.where("parent is not null").join(known, ["shard", "parent"])
    outer = outer.withColumn("parent_conv_id", F.col("above")).select(columns)
    return inner.unionByName(outer).unionByName(boundary.select(columns))
