"""Tanimoto scoring of a source set against a library, and the checks before it.

The library is only ever scanned in place: each task scores its own rows against the source
fingerprints, which are broadcast in passes of a bounded size. Nothing pairs rows by a join.

Two fingerprints of a and b bits score at most min(a, b) / max(a, b). A search therefore scores
a sample of the library first: the score of a source's last match in it is a floor no match of
the whole library can lie below. A pass reads only the bit counts that can reach some floor,
which a library laid out by bit count (``fingerprints.by_popcount``) answers with few files, and
a block of rows is scored against those sources only that it can match.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinmart.config import Settings
from kinmart.operators.fingerprints import in_range, shard_plan
from kinmart.operators.ranking import best_scores, top_matches
from kinmart.schemas import TIE_FLAG
from kinmart.workspace import estimated_bytes, scan_tasks, spread, stage

_PAIRS_AT_ONCE = 1 << 20
_ROWS_AT_ONCE = 1024
_PAIRS_WORTH_MOVING = 20_000_000
#: Rows scored to find floors, and how many times as large a library must be to be worth it.
_SAMPLE_ROWS, _WORTH_SAMPLING = 1 << 16, 8
#: Stretches of sorted identifiers that are compared in one task.
_MOST_STRETCHES = 1_000_000

PAIR_DDL = "source_id string, target_id string, score double"
PASSES_DDL = "pass int, ids array<string>"
SCORES_DDL = "target_id string, scores array<float>"


class UnscorableSources(RuntimeError):
    """Some sources are not in the library, so no score of theirs would be right."""


class LibraryMismatch(RuntimeError):
    """Library, rejects and items disagree about what there is to score."""


def missing_fingerprints(sources: DataFrame, library: DataFrame) -> DataFrame:
    """Source ids the library does not hold.

    The library is filtered by the sources first, which are few: looking for absent sources
    in the whole library would shuffle every identifier of it.
    """
    held = library.select(F.col("item_id").alias("source_id")).join(
        sources.select("source_id"), "source_id", "left_semi"
    )
    return sources.select("source_id").join(held, "source_id", "left_anti")


def require_fingerprints(sources: DataFrame, library: DataFrame) -> None:
    """Raise, naming the first five, when any source has no fingerprint."""
    missing = missing_fingerprints(sources, library)
    named = [row[0] for row in missing.orderBy("source_id").limit(5).collect()]
    if named:
        raise UnscorableSources(
            f"{missing.count()} sources have no fingerprint: {', '.join(named)}"
        )


def library_gap(items: DataFrame, library: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row, ``observed``: how far fingerprints and rejects are from the items in number.

    Counts only, which parquet answers from its footers.
    """
    written, refused = (part.agg(F.count("*")).scalar() for part in (library, rejects))
    gap = F.abs(F.col("items") - written - refused).cast("double")
    return items.agg(F.count("*").alias("items")).select(gap.alias("observed"))


def _sorted_stretches(library: DataFrame) -> DataFrame:
    """(first, last, repeated): sorted stretches of identifiers as the tasks read them, and
    identifiers that are repeated within one. Nulls are left out. A file starts a stretch, as a
    task may read files that leave out others between them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = last_file = None
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("item_id")))
            ids, files = batch.column("item_id"), batch.column("file").to_numpy()
            if not len(ids):
                continue
            if last is not None:
                ids = pa.concat_arrays([pa.array([last], pa.string()), ids])
                files = np.concatenate([[last_file], files])
            ahead, behind = ids.slice(1), ids.slice(0, len(ids) - 1)
            less = pc.less(ahead, behind).to_numpy(zero_copy_only=False)
            falls = np.flatnonzero(less | (files[1:] != files[:-1]))
            same = ahead.filter(pc.equal(ahead, behind)).unique()
            first = ids[0].as_py() if first is None else first
            starts = [first, *(ids[int(k) + 1].as_py() for k in falls)]
            ends = [ids[int(k)].as_py() for k in falls]
            made = [*zip(starts, ends), *((None, None) for _ in same)]
            if made:
                yield _stretch_rows(made, [None] * len(ends) + same.to_pylist())
            first, last, last_file = starts[-1], ids[-1].as_py(), files[-1]
        if last is not None:
            yield _stretch_rows([(first, last)], [None])

    ddl = "first string, last string, repeated string"
    try:
        ids = library.select("item_id", F.xxhash64("_metadata.file_path").alias("file"))
    except AnalysisException:  # not read from files as it is
        ids = library.select("item_id", F.lit(0).cast("long").alias("file"))
    return stage(ids.mapInArrow(scan, ddl), "stretches")


def _stretch_rows(bounds: list[tuple], repeated: list) -> pa.RecordBatch:
    columns = [*zip(*bounds), repeated]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), pa.string()) for c in columns], ["first", "last", "repeated"]
    )


def repeated_ids(library: DataFrame) -> DataFrame:
    """Identifiers the library holds more than once.

    A published library lies sorted in its files, so an identifier's copies lie next to each
    other or at the border of two stretches, and one scan without a shuffle finds them. One
    that does not, whose stretches are many or overlap, is grouped by identifier instead.
    """
    found = _sorted_stretches(library)
    stretches = found.where("first is not null")
    order = Window.orderBy("first", "last")
    borders = stretches.withColumn("before", F.lag("last").over(order))
    if stretches.count() > _MOST_STRETCHES or not borders.where("first < before").isEmpty():
        return library.groupBy("item_id").count().where("count > 1").select("item_id")
    inside = found.where("repeated is not null").select(F.col("repeated").alias("item_id"))
    across = borders.where("first = before").select(F.col("first").alias("item_id"))
    return inside.unionAll(across).distinct()


def require_complete(items: DataFrame, library: DataFrame, rejects: DataFrame) -> None:
    """Raise when fingerprints and rejects do not add up to the items."""
    gap = library_gap(items, library, rejects).first()[0]
    if gap:
        raise LibraryMismatch(f"the library is {gap:g} items away from complete")


def require_unique(library: DataFrame) -> None:
    """Raise when the library holds an identifier twice. Done once, when it is built."""
    repeated = repeated_ids(library).first()
    if repeated:
        raise LibraryMismatch(f"the library holds {repeated[0]} more than once")


@dataclass(frozen=True)
class SourcePass:
    """The sources of one pass over the library, by bit count."""

    ids: tuple[str, ...]
    words: np.ndarray
    counts: np.ndarray


def source_passes(
    sources: DataFrame, library: DataFrame, settings: Settings
) -> Iterator[SourcePass]:
    """Look the sources up in the library and give them pass by pass, each of a bounded size.

    Only the pass in hand is on the driver; it is fetched as Arrow, not as rows. Sources of
    like bit counts share a pass, as they need the same rows.
    """
    key = F.concat(F.lpad(F.col("pc").cast("string"), 10, "0"), F.lit(":"), "item_id")
    found = stage(
        library.join(
            sources.select(F.col("source_id").alias("item_id")).distinct(), "item_id", "left_semi"
        ).select("item_id", "fp", "pc", key.alias("key")),
        "sources",
    )
    limit = settings.sources_per_pass
    if found.count() <= limit:
        parts = [found]
    else:
        tasks = scan_tasks(found) + 1
        bounds = shard_plan(found, "key", limit, partitions=tasks).orderBy("shard").collect()
        parts = (found.where(in_range(F.col("key"), b.first_id, b.next_id)) for b in bounds)
    for part in parts:
        rows = part.orderBy("key").toArrow()
        if rows.num_rows:
            words = pc.list_flatten(rows.column("fp")).to_numpy().reshape(rows.num_rows, -1)
            counts = rows.column("pc").to_numpy().astype(np.int32)
            ids = tuple(rows.column("item_id").to_pylist())
            yield SourcePass(ids, words.astype(np.int64).view(np.uint64), counts)


def _broadcast(library: DataFrame, sources: SourcePass, floors: np.ndarray | None = None):
    """Send one pass to the executors: at most sources_per_pass rows of one fingerprint."""
    context = library.sparkSession.sparkContext
    return context.broadcast((sources.ids, sources.words, sources.counts, floors))


def _bits(words: np.ndarray) -> np.ndarray:
    """Rows of words as rows of zeros and ones. Sums of products of these are exact."""
    raw = np.ascontiguousarray(words).view(np.uint8)
    return np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)


def highest_scores(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The highest score fingerprints of ``a`` bits can have with any of ``low`` to ``high`` bits.

    Division is monotonic in floating point too, so no score of such a pair exceeds it.
    """
    less, more = np.minimum(a, high), np.maximum(a, low)
    inside = (a >= low) & (a <= high) & (a > 0)
    return np.where(inside, 1.0, np.divide(less, more, out=np.zeros(np.shape(more)), where=more > 0))


class Scorer:
    """The sources of a pass as a matrix of bits, to be multiplied by blocks of rows."""

    def __init__(self, ids, words: np.ndarray, counts: np.ndarray):
        self.ids, self.bits, self.counts = ids, _bits(words), counts
        self.pairs = 0

    def scores(self, words: np.ndarray, counts: np.ndarray, wanted=slice(None)) -> np.ndarray:
        """Sources-by-rows matrix of scores, of the ``wanted`` sources alone."""
        shared = (self.bits[wanted] @ _bits(words).T).astype(np.float64)
        union = self.counts[wanted][:, None] + counts[None, :] - shared
        self.pairs += shared.size
        return np.divide(shared, union, out=shared, where=union > 0)

    def wanted(self, counts: np.ndarray, floors: np.ndarray):
        """The sources that rows of these bit counts can match at their floors or above."""
        reach = highest_scores(self.counts, counts.min(), counts.max()) >= floors
        places = np.flatnonzero(reach)
        if len(places) and places[-1] - places[0] + 1 == len(places):
            return slice(int(places[0]), int(places[-1]) + 1)
        return places

    @property
    def rows_at_once(self) -> int:
        return min(_ROWS_AT_ONCE, max(64, _PAIRS_AT_ONCE // len(self.counts)))


def _blocks(
    batch: pa.RecordBatch, rows: int
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, int]]:
    """Slices of a batch small enough for the scoring arrays to stay in cache, and their places."""
    for start in range(0, batch.num_rows, rows):
        part = batch.slice(start, rows)
        words = part.column("fp").flatten().to_numpy().view(np.uint64)
        counts = part.column("pc").to_numpy()
        yield part.column("item_id"), words.reshape(part.num_rows, -1), counts, start


def _score_rows(library: DataFrame, shared: Broadcast, single: bool) -> DataFrame:
    """(target_id, scores): a row for each library item, its scores in the order of the pass."""
    kind = "float" if single else "double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, counts, _ = shared.value
        scorer = Scorer(ids, words, counts)
        for batch in batches:
            for targets, rows, sizes, _ in _blocks(batch, scorer.rows_at_once):
                matrix = np.ascontiguousarray(scorer.scores(rows, sizes).T)
                matrix = matrix.astype(np.float32 if single else np.float64)
                offsets = np.arange(0, matrix.size + 1, len(ids), dtype=np.int32)
                scores = pa.ListArray.from_arrays(offsets, matrix.reshape(-1))
                yield pa.RecordBatch.from_arrays([targets, scores], ["target_id", "scores"])

    return library.select("item_id", "fp", "pc").mapInArrow(
        score, f"target_id string, scores array<{kind}>"
    )


def _pairs(scored: DataFrame, ids: Column) -> DataFrame:
    """(source_id, target_id, score) of rows of scores in the order of ``ids``."""
    placed = scored.select("target_id", ids.alias("ids"), F.posexplode("scores").alias("n", "score"))
    return placed.select(F.get("ids", F.col("n")).alias("source_id"), "target_id", "score")


def _shared_out(library: DataFrame, sources: SourcePass) -> DataFrame:
    """The library, over all cores when it is small and there is a lot to compare."""
    pairs = estimated_bytes(library) // (8 * sources.words.shape[1]) * len(sources.ids)
    rows = library.select("item_id", "fp", "pc")
    return spread(rows, "item_id") if pairs >= _PAIRS_WORTH_MOVING else rows


def score_table(
    library: DataFrame, sources: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Every source against every library item, itself included: source, target, score.

    Of several passes each is run and staged, one row of scores a target, before the next
    begins, so the driver and the executors hold one pass at a time.
    """
    tables, passes = [], source_passes(sources, library, settings)
    held = next(passes, None)
    while held is not None:
        shared = _broadcast(library, held)
        scored, ids = _score_rows(_shared_out(library, held), shared, single=False), held.ids
        held = next(passes, None)
        if held is not None or tables:
            scored = stage(scored, "scores")
            shared.destroy()
        tables.append(_pairs(scored, F.lit(list(ids))))
    if not tables:
        return library.sparkSession.createDataFrame([], PAIR_DDL)
    return reduce(DataFrame.unionAll, tables)


class Best:
    """The highest scores seen so far for every source, best first, ``keep`` of them.

    Scores of one row are in order of score, then identifier; -1 marks a free place. ``ids``
    are places in ``names``, which holds no more identifiers than the lists do.
    """

    def __init__(self, sources: int, keep: int, floors: np.ndarray | None):
        self.keep = keep
        self.given = np.zeros(sources) if floors is None else np.maximum(floors, 0.0)
        self.floors = self.given.copy()
        self.scores = np.full((sources, keep), -1.0)
        self.ids = np.zeros((sources, keep), np.int64)
        self.names = pa.array([], pa.string())

    def begin(self, names: pa.Array) -> int:
        """Make room for a batch's identifiers; returns the place of the first."""
        first = len(self.names)
        self.names = pa.concat_arrays([self.names, names])
        self.order = np.empty(len(self.names), np.int64)
        self.order[pc.sort_indices(self.names)] = np.arange(len(self.names))
        return first

    def offer(self, sources: np.ndarray, scores: np.ndarray, first: int, gap: float) -> None:
        """Take a block: its scores for some sources, its first place in ``names``.

        ``gap`` is less than any difference of two unequal scores.
        """
        hits = scores >= self.floors[sources][:, None]
        some = np.flatnonzero(hits.any(axis=1))
        if not len(some):
            return
        sources, scores, n = sources[some], np.where(hits[some], scores[some], -1.0), scores.shape[1]
        places = np.broadcast_to(np.arange(n), scores.shape)
        if n > self.keep:
            # Equal scores are told apart by a step too small to change the order of others.
            order = self.order[first : first + n].argsort().argsort()
            key = order * (gap / (4 * n)) - scores
            places = np.argpartition(key, self.keep - 1, axis=1)[:, : self.keep]
            scores = np.take_along_axis(scores, places, axis=1)
        scores = np.concatenate([self.scores[sources], scores], axis=1)
        ids = np.concatenate([self.ids[sources], places + first], axis=1)
        ranked = np.lexsort((self.order[ids], -scores), axis=1)[:, : self.keep]
        self.scores[sources] = np.take_along_axis(scores, ranked, axis=1)
        self.ids[sources] = np.take_along_axis(ids, ranked, axis=1)
        self.floors[sources] = np.maximum(self.given[sources], self.scores[sources, -1])

    def end(self) -> None:
        """Forget the identifiers that are on no list."""
        held = np.unique(self.ids)
        self.names = self.names.take(pa.array(held))
        self.ids = np.searchsorted(held, self.ids)

    def rows(self, sources: pa.Array) -> pa.RecordBatch:
        source, place = np.nonzero(self.scores >= 0)
        found = self.ids[source, place]
        columns = [sources.take(pa.array(source)), self.names.take(pa.array(found))]
        columns.append(pa.array(self.scores[source, place]))
        return pa.RecordBatch.from_arrays(columns, ["source_id", "target_id", "score"])


def search_batches(
    batches: Iterator[pa.RecordBatch], scorer: Scorer, keep: int, floors: np.ndarray | None
) -> Best:
    """The best ``keep`` rows of every source; rows below its floor are not wanted."""
    best = Best(len(scorer.ids), keep, floors)
    names = pa.array(scorer.ids, pa.string())
    gap = 1.0 / (2 * scorer.bits.shape[1]) ** 2
    every = np.arange(len(scorer.ids))
    for batch in batches:
        if not batch.num_rows:
            continue
        batch = batch.take(pc.sort_indices(batch.column("pc")))
        first = best.begin(batch.column("item_id"))
        own = pc.fill_null(pc.index_in(batch.column("item_id"), names), -1)
        own = own.to_numpy(zero_copy_only=False)
        for _, words, counts, start in _blocks(batch, scorer.rows_at_once):
            wanted = scorer.wanted(counts, best.floors)
            sources = every[wanted]
            if not len(sources):
                continue
            scores = scorer.scores(words, counts, wanted)
            mine = own[start : start + len(counts)]
            row_of = np.full(len(every), -1)
            row_of[sources] = np.arange(len(sources))
            selves = np.flatnonzero(mine >= 0)
            selves = selves[row_of[mine[selves]] >= 0]
            scores[row_of[mine[selves]], selves] = -1.0
            best.offer(sources, scores, first + start, gap)
        best.end()
    return best


def _best_pass(library: DataFrame, shared: Broadcast, keep: int) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, counts, floors = shared.value
        best = search_batches(batches, Scorer(ids, words, counts), keep, floors)
        yield best.rows(pa.array(ids, pa.string()))

    return library.select("item_id", "fp", "pc").mapInArrow(search, PAIR_DDL)


def sample_floors(library: DataFrame, sources: SourcePass, keep: int, rows: int) -> np.ndarray:
    """For each source the score of its ``keep``-th match in a sample, 0 if there are fewer.

    Any rows will do for a floor, and only itself is no match of a source, so which rows are
    sampled changes what is skipped and never what is found.
    """
    part = F.pmod(F.xxhash64("item_id"), F.lit(max(1, rows // _SAMPLE_ROWS)))
    shared = _broadcast(library, sources)
    found = best_scores(_best_pass(library.where(part == 0), shared, keep), keep)
    last = found.where(F.col("match_rank") == keep).select("source_id", "score").collect()
    shared.destroy()
    place = {name: k for k, name in enumerate(sources.ids)}
    floors = np.zeros(len(sources.ids))
    for row in last:
        floors[place[row["source_id"]]] = row["score"]
    return floors


def bit_counts(sources: SourcePass, floors: np.ndarray) -> tuple[int, int]:
    """The least and the most bits a row can have that reaches the floor of some source."""
    sizes = np.arange(64 * sources.words.shape[1] + 1)
    reach = np.zeros(len(sizes), bool)
    for count, floor in set(zip(sources.counts.tolist(), floors.tolist())):
        reach |= highest_scores(np.full(len(sizes), count), sizes, sizes) >= floor
    places = np.flatnonzero(reach)
    return int(places[0]), int(places[-1])


def search(
    library: DataFrame,
    sources: DataFrame,
    settings: Settings = Settings(),
    top_n: int | None = None,
) -> DataFrame:
    """Top matches of every source: source_id, target_id, tanimoto_score, flag, match_rank.

    Each task keeps the best N+1 rows per source while it streams its share of the library,
    so what is shuffled is tasks x sources x (N+1) rows whatever the library holds. The
    extra row is what tells whether the boundary is tied. Passes share no source, so each is
    ranked on its own; of several, each is run and staged and its broadcast dropped before the
    next begins, so the driver and the executors hold one pass at a time.
    """
    n = top_n or settings.top_n
    fan_in = math.isqrt(max(1, scan_tasks(library) // 64))
    ranked, passes, size = [], source_passes(sources, library, settings), None
    held = next(passes, None)
    while held is not None:
        size = library.count() if size is None else size
        rows, floors = _shared_out(library, held), None
        if size >= _WORTH_SAMPLING * _SAMPLE_ROWS:
            floors = sample_floors(library, held, n + 1, size)
            rows = rows.where(F.col("pc").between(*bit_counts(held, floors)))
        shared = _broadcast(library, held, floors)
        top = top_matches(_best_pass(rows, shared, n + 1), n, fan_in)
        held = next(passes, None)
        if held is not None or ranked:
            top = stage(top, "pass")
            shared.destroy()
        ranked.append(top)
    if not ranked:
        return top_matches(library.sparkSession.createDataFrame([], PAIR_DDL), n)
    return reduce(DataFrame.unionAll, ranked)


def search_summary(top: DataFrame) -> DataFrame:
    """One row: sources with a match, top rows, rows flagged as tied at the boundary."""
    return top.agg(
        F.count_distinct("source_id").alias("sources"),
        F.count("*").alias("top_rows"),
        F.count_if(F.col(TIE_FLAG)).alias("flagged_rows"),
    )


def write_scores(
    library: DataFrame, sources: DataFrame, path: str, order: str, settings: Settings = Settings()
) -> None:
    """Archive every score: one row a target and pass, scores as float32 in source order.

    Rows are written to ``path`` by the tasks that score them, without a shuffle; ``order``
    holds the sources of each pass. The archive is for reading back with ``read_scores``; the
    mart is built from double scores.
    """
    spark = library.sparkSession
    names = []
    for number, held in enumerate(source_passes(sources, library, settings)):
        shared = _broadcast(library, held)
        scored = _score_rows(_shared_out(library, held), shared, single=True)
        written = scored.write.mode("overwrite").option("compression", "zstd")
        written.parquet(f"{path}/pass={number}")
        shared.destroy()
        frame = spark.createDataFrame([(number, list(held.ids))], PASSES_DDL)
        names.append(stage(frame, "score-passes"))
    made = reduce(DataFrame.unionAll, names) if names else spark.createDataFrame([], PASSES_DDL)
    made.write.mode("overwrite").parquet(order)
    if not names:
        none = spark.createDataFrame([], SCORES_DDL)
        none.write.mode("overwrite").parquet(f"{path}/pass=0")


def read_scores(
    spark: SparkSession, path: str, order: str, source_ids: Sequence[str] | None = None
) -> DataFrame:
    """(source_id, target_id, tanimoto_score) of an archive, of some sources or of all.

    One source is one place of one pass, so only that pass is read and nothing is exploded.
    """
    passes = spark.read.schema(PASSES_DDL).parquet(order)
    scores = spark.read.schema(f"{SCORES_DDL}, pass int").parquet(path)
    if source_ids is None:
        rows = scores.join(passes, "pass")
        return _pairs(rows, F.col("ids")).withColumnRenamed("score", "tanimoto_score")
    found = passes.select("pass", F.posexplode("ids").alias("place", "source_id"))
    found = found.where(F.col("source_id").isin(list(source_ids))).collect()
    parts = [
        scores.where(F.col("pass") == row["pass"]).select(
            F.lit(row["source_id"]).alias("source_id"),
            "target_id",
            F.get("scores", F.lit(row["place"])).alias("tanimoto_score"),
        )
        for row in found
    ]
    empty = "source_id string, target_id string, tanimoto_score float"
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], empty)
