"""Benchmark decontamination by pigeonhole edit matching.

An item of n characters may differ from a passage by n * percent / 100 edits. Cut into one piece
more than that, at least one piece must occur unchanged, so an automaton over all pieces finds
every candidate place in one walk over a text. Myers' bit-parallel distance then decides.

Texts are compared as their words, A-Z lowered, joined and enclosed by single spaces, so layout
does not count and items match whole words.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from kinmart.llm.files import giving_back, rows_of

BLOCK_CHARS = 8 << 20
MATCH = "array<struct<item_id:bigint,distance:bigint,first_word:bigint,n_words:bigint>>"


def normal(text: str | None) -> str:
    words = (text or "").encode().lower().split()
    return f" {b' '.join(words).decode()} " if words else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): ``budget`` + 1 stretches of nearly equal length that make up the item."""
    cuts = [k * len(item) // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' bit vectors of one string; a vector is a Python integer, so any length will do."""

    def __init__(self, text: str):
        self.size, self.masks = len(text), {}
        for k, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << k

    def distances(self, text: str, anchored: bool) -> Iterator[int]:
        """Edit distance of the pattern to the best stretch of ``text`` ending at each character.

        Anchored, the stretch begins where ``text`` does.
        """
        ones = (1 << self.size) - 1
        top = 1 << (self.size - 1)
        plus, minus, score = ones, 0, self.size
        for c in text:
            same = self.masks.get(c, 0)
            down = same | minus
            across = (((same & plus) + plus) ^ plus) | same
            more = minus | (ones & ~(across | plus))
            less = plus & across
            score += bool(more & top) - bool(less & top)
            more = (more << 1 | anchored) & ones
            less = less << 1 & ones
            plus = less | (ones & ~(down | more))
            minus = more & down
            yield score


class Item:
    def __init__(self, item_id: int | None, text: str, percent: float):
        self.item_id, self.text = item_id, text
        self.budget = int(len(text) * percent / 100)

    @property
    def forward(self) -> Pattern:
        if not hasattr(self, "_forward"):
            self._forward, self._backward = Pattern(self.text), Pattern(self.text[::-1])
        return self._forward

    def best(self, text: str, low: int, high: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of the nearest stretch inside the window, if near enough."""
        place = text.find(self.text, low, high)
        if place >= 0:
            return 0, place, place + len(self.text)
        if not self.budget:
            return None
        scores = list(self.forward.distances(text[low:high], False))
        distance = min(scores)
        if distance > self.budget:
            return None
        end = low + scores.index(distance) + 1
        back = text[max(low, end - len(self.text) - self.budget) : end][::-1]
        lengths = list(self._backward.distances(back, True))
        return distance, end - lengths.index(min(lengths)) - 1, end


class Matcher:
    """All items of one block and the automaton of their pieces."""

    def __init__(self, items: list[tuple[int | None, str]], percent: float):
        self.items = [Item(key, text, percent) for key, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, item in enumerate(self.items):
            for offset, piece in pieces(item.text, item.budget):
                places.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each item with a piece in the text: stretches it may lie in, joined if they overlap."""
        found: dict[int, list[list[int]]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for k, offset in where:
                item = self.items[k]
                low = max(0, end + 1 - size - offset - item.budget)
                high = end + 1 - size - offset + len(item.text) + item.budget
                found.setdefault(k, []).append([low, high])
        for k, spans in found.items():
            spans.sort()
            joined = [spans[0]]
            for low, high in spans[1:]:
                if low <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], high)
                else:
                    joined.append([low, high])
            found[k] = joined
        return found

    def matches(self, text: str) -> list[dict]:
        """The nearest and then first match of each item in a normalised text."""
        if not self.items or not text:
            return []
        out = []
        for k, spans in self.windows(text).items():
            item = self.items[k]
            near = [hit for span in spans if (hit := item.best(text, *span))]
            if near:
                distance, start, end = min(near)
                first = text.count(" ", 1, start + 1)
                words = len(text[start:end].split())
                out.append(
                    {
                        "item_id": item.item_id,
                        "distance": distance,
                        "first_word": first,
                        "n_words": words,
                    }
                )
        return sorted(out, key=lambda m: (m["first_word"], m["item_id"] is None, m["item_id"]))


_kept: dict[tuple, Matcher] = {}


def _matcher(name: str, shared, percent: float) -> Matcher:
    """The matcher of a block of items, known by its content; a worker keeps only one."""
    if (name, percent) not in _kept:
        _kept.clear()
        _kept[name, percent] = Matcher(shared.value, percent)
    return _kept[name, percent]


def match_block(docs: DataFrame, items: list, percent: float, text: str) -> DataFrame:
    """(row, matches): every document, its columns in ``row``, with its matches in this block."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    name = xxhash.xxh3_128_hexdigest(pickle.dumps(items))
    whole = docs.select(
        F.col(text).cast("string").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
    )
    schema = whole.select("row", F.lit(None).cast(MATCH).alias("matches")).schema
    kind = pa.list_(
        pa.struct([(x, pa.int64()) for x in ("item_id", "distance", "first_word", "n_words")])
    )

    @giving_back
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, shared, percent)
        for batch in batches:
            found = [matcher.matches(normal(r["text"])) for r in rows_of(batch.select(["text"]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(found, kind)], names=["row", "matches"]
            )

    return whole.mapInArrow(find, schema)


def blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list]:
    """The items in blocks of about BLOCK_CHARS characters; only one is on the driver at a time."""
    rows = benchmark.select(
        F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")
    ).where("text is not null")
    size = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-size // BLOCK_CHARS))
    for k in range(n):
        own = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        items = [(r["item_id"], normal(r["text"])) for r in own.collect()]
        yield sorted({x for x in items if x[1]}, key=lambda x: (x[1], x[0] is None, x[0] or 0))


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    percent: float = 5.0,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, distance, first_word, n_words): a row for each item found in a document.

    The nearest match of an item counts, the first of equals; places are counted in words. Null
    or blank texts and items match nothing, null ids are passed on, repeated rows are matched
    each. The items are searched in blocks of bounded size, each against all documents.
    """
    found = None
    for items in blocks(benchmark, item_id, item_text):
        rows = match_block(docs, items, percent, text)
        own = rows.select(
            F.col(f"row.`{doc_id}`").cast("long").alias("doc_id"), F.explode("matches").alias("m")
        ).select("doc_id", "m.*")
        found = own if found is None else found.unionByName(own)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, percent: float = 5.0) -> DataFrame:
    """The documents in which no benchmark item is found, with their columns. No shuffle."""
    for items in blocks(benchmark, "item_id", "text"):
        kept = match_block(docs, items, percent, "text").where(F.size("matches") == 0)
        docs = kept.select("row.*")
    return docs
