from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinmart import Settings
from kinmart.functions.bits import tanimoto
from kinmart.operators.ranking import top_matches
from kinmart.operators import similarity
from kinmart.operators.fingerprints import by_popcount
from kinmart.operators.similarity import (
    LibraryMismatch,
    Scorer,
    UnscorableSources,
    _broadcast,
    _score_rows,
    _sorted_stretches,
    bit_counts,
    highest_scores,
    missing_fingerprints,
    read_scores,
    repeated_ids,
    require_complete,
    require_fingerprints,
    require_unique,
    sample_floors,
    score_table,
    search,
    search_batches,
    search_summary,
    source_passes,
    write_scores,
)
from kinmart.workspace import new_dir

LIBRARY = "item_id string, fp array<bigint>, pc int"
DENSE = Settings(n_bits=64, top_n=4)


def word(bits):
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def library(spark, sets, words=1):
    made = [
        (key, [word(b - 64 * w for b in bits if b // 64 == w) for w in range(words)], len(bits))
        for key, bits in sets.items()
    ]
    return spark.createDataFrame(made, LIBRARY)


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "source_id string")


def jaccard(a, b):
    union = len(a | b)
    return len(a & b) / union if union else 0.0


def random_sets(count, width, most, seed=3):
    rng = np.random.default_rng(seed)
    return {
        f"I{n:04d}": {int(b) for b in rng.choice(width, size=rng.integers(0, most), replace=False)}
        for n in range(count)
    }


PAIRS = [
    ({0, 1, 2, 3}, {2, 3, 4, 5}, 2 / 6),
    ({1, 3}, {1, 3}, 1.0),
    ({0, 1}, {2, 3}, 0.0),
    (set(), set(), 0.0),
    (set(range(8)), set(range(1, 10)), 0.7),
    ({63}, {63, 62}, 0.5),
]


@pytest.mark.parametrize(("a", "b", "score"), PAIRS)
def test_scores_by_hand(spark, a, b, score):
    made = score_table(library(spark, {"A": a, "B": b}), ids(spark, "A"), DENSE)
    by_target = {row.target_id: row.score for row in made.collect()}
    assert by_target == {"A": 1.0 if a else 0.0, "B": score}
    frame = spark.createDataFrame([([word(a)], [word(b)])], "a array<bigint>, b array<bigint>")
    assert frame.select(tanimoto(F.col("a"), F.col("b"))).first()[0] == score


@pytest.mark.parametrize("words", [1, 3])
@pytest.mark.parametrize("per_pass", [4096, 7])
def test_full_table_matches_sets(spark, words, per_pass):
    sets = random_sets(60, 64 * words, 30)
    settings = Settings(n_bits=64 * words, sources_per_pass=per_pass)
    names = sorted(sets)[:20]
    frame = library(spark, sets, words).repartition(5)
    made = {(r[0], r[1]): r[2] for r in score_table(frame, ids(spark, *names), settings).collect()}
    assert made == {(s, t): jaccard(sets[s], sets[t]) for s in names for t in sets}


@pytest.mark.parametrize("per_pass", [4096, 5])
def test_search_equals_ranking_the_full_table(spark, rows, per_pass):
    sets = random_sets(300, 64, 5)
    settings = Settings(n_bits=64, top_n=6, sources_per_pass=per_pass)
    frame = library(spark, sets).repartition(7)
    sources = ids(spark, *sorted(sets)[:25])
    made = search(frame, sources, settings)
    want = top_matches(score_table(frame, sources, settings), 6)
    assert rows(made) == rows(want)
    assert made.where("has_duplicates_of_last_largest_score").count() > 0


def test_a_third_of_the_library_may_be_copies(spark):
    copies = {f"C{n:05d}": {1, 2, 3} for n in range(9000)}
    rest = {f"R{n:05d}": {n % 60, (n * 7) % 60, 61} for n in range(9000)}
    frame = library(spark, {**copies, **rest}).repartition(4)
    made = search(frame, ids(spark, "C00004", "R00001"), DENSE).where("source_id = 'C00004'")
    kept = made.orderBy("match_rank").collect()
    assert [r.target_id for r in kept] == ["C00000", "C00001", "C00002", "C00003"]
    assert all(r.has_duplicates_of_last_largest_score for r in kept)


def test_short_library_is_never_flagged(spark):
    made = search(library(spark, {"A": {1}, "B": {1}, "C": {2}}), ids(spark, "A"), DENSE).collect()
    assert [(r.target_id, r.tanimoto_score, r[3]) for r in made] == [
        ("B", Decimal("1.00000000"), False), ("C", Decimal("0E-8"), False)
    ]


def test_no_sources_gives_no_rows(spark):
    empty = spark.createDataFrame([], "source_id string")
    held = library(spark, {"A": {1}})
    assert search(held, empty, DENSE).count() == 0 and score_table(held, empty, DENSE).count() == 0


def test_missing_sources_are_named_first_five(spark):
    held = library(spark, {"A": {1}})
    wanted = ids(spark, "A", *[f"M{n}" for n in range(7)])
    assert missing_fingerprints(wanted, held).count() == 7
    with pytest.raises(UnscorableSources, match="7 sources .*: M0, M1, M2, M3, M4$"):
        require_fingerprints(wanted, held)
    require_fingerprints(ids(spark, "A"), held)


def test_library_must_be_complete(spark):
    held = library(spark, {"A": {1}, "B": {2}})
    items = spark.createDataFrame([("A",), ("B",), ("C",)], "item_id string")
    rejects = items.where("item_id = 'C'")
    require_complete(items, held, rejects)
    with pytest.raises(LibraryMismatch, match="1 items"):
        require_complete(items, held, rejects.limit(0))
    doubled = held.unionAll(held.where("item_id = 'A'"))
    with pytest.raises(LibraryMismatch, match="A more than once"):
        require_unique(doubled)
    require_unique(held)


def test_repeated_ids_are_found_without_moving_a_sorted_library(spark, rows):
    names = [f"K{n:04d}" for n in range(500)]

    def held(*more):
        given = [(n, [1], 1) for n in sorted([*names, *more])]
        return spark.createDataFrame(given, LIBRARY)

    def ranges(frame):
        path = new_dir(spark, "sorted")
        frame.repartitionByRange(7, "item_id").sortWithinPartitions("item_id").write.parquet(path)
        return spark.read.parquet(path)

    assert repeated_ids(ranges(held())).count() == 0
    twice = [names[n] for n in (0, 17, 17, 499)]
    for frame in (ranges(held(*twice)), held(*twice).repartition(5), held(*twice).coalesce(1)):
        assert rows(repeated_ids(frame)) == [("K0000",), ("K0017",), ("K0499",)]
    plan = _sorted_stretches(ranges(held()))._jdf.queryExecution().executedPlan().toString()
    found = repeated_ids(ranges(held(*twice)))._jdf.queryExecution().analyzed().toString()
    assert "Exchange" not in plan and "item_id#" in found and "count(1)" not in found
    # The copies of one identifier at the border of two files.
    path = new_dir(spark, "border")
    for part in (held().where("item_id <= 'K0100'"), held().where("item_id >= 'K0100'")):
        part.coalesce(1).sortWithinPartitions("item_id").write.mode("append").parquet(path)
    assert rows(repeated_ids(spark.read.parquet(path))) == [("K0100",)]
    assert repeated_ids(held().limit(0)).count() == 0


def test_sorted_files_need_no_shuffle_in_whatever_order_tasks_read_them(spark, rows):
    # Tasks read large files first: the first file, then the third.
    path, at = new_dir(spark, "sizes"), 0
    for size in (400, 100, 300, 20, 20, 20, 20, 20):
        given = [(f"K{n:04d}", [n * 7919], 1) for n in range(at, at + size)]
        spark.createDataFrame(given, LIBRARY).coalesce(1).write.mode("append").parquet(path)
        at += size - 1
    found = repeated_ids(spark.read.parquet(path))
    assert "count(1)" not in found._jdf.queryExecution().analyzed().toString()
    assert rows(found) == [(f"K{n:04d}",) for n in (399, 498, 797, 816, 835, 854, 873)]


def test_summary_counts_flags(spark):
    made = search(library(spark, {f"I{n}": {1} for n in range(9)}), ids(spark, "I0", "I1"), DENSE)
    assert tuple(search_summary(made).first()) == (2, 8, 8)


@pytest.mark.parametrize("per_pass", [4096, 3])
def test_archive_is_one_row_a_target_in_single_precision(spark, per_pass):
    sets = {f"I{n}": set(range(n % 10 + 1)) for n in range(50)}
    held = library(spark, sets).repartition(4)
    settings = Settings(n_bits=64, sources_per_pass=per_pass)
    path, names = new_dir(spark, "archive"), [f"I{n}" for n in (6, 9, 11, 20, 31)]
    order = new_dir(spark, "archive-order")
    write_scores(held, ids(spark, *names), path, order, settings)
    raw = spark.read.parquet(path)
    assert raw.count() == 50 * -(-5 // per_pass)
    assert raw.schema["scores"].dataType.simpleString() == "array<float>"
    back = read_scores(spark, path, order)
    want = {(s, t): float(np.float32(jaccard(sets[s], sets[t]))) for s in names for t in sets}
    assert {(r[0], r[1]): r[2] for r in back.collect()} == want
    some = read_scores(spark, path, order, ["I9", "I31", "nowhere"])
    assert {(r[0], r[1]): r[2] for r in some.collect()} == {
        k: v for k, v in want.items() if k[0] in ("I9", "I31")
    }
    write_scores(held, ids(spark), *(paths := (f"{path}-none", f"{order}-none")), settings)
    assert read_scores(spark, *paths).count() == 0 == read_scores(spark, *paths, ["I9"]).count()


def test_scores_are_written_where_they_are_made(spark):
    held = library(spark, random_sets(50, 64, 20))
    made = _score_rows(held, _broadcast(held, next(source_passes(ids(spark, "I0001"), held, DENSE))), True)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_no_score_exceeds_its_bound():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = (set(rng.choice(64, rng.integers(0, 64), replace=False).tolist()) for _ in "ab")
        low, high = sorted((len(b), len(b) + int(rng.integers(0, 5))))
        bound = highest_scores(np.array([len(a)]), low, high)[0]
        assert jaccard(a, b) <= bound <= 1
    assert highest_scores(np.array([0, 4]), 0, 0).tolist() == [0, 0]
    assert highest_scores(np.array([10]), 20, 30).tolist() == [0.5]


def test_rows_and_pairs_out_of_reach_are_skipped(spark, monkeypatch):
    """Sources of few bits with close matches: rows of many bits are neither read nor scored."""
    sets = random_sets(4000, 512, 500, seed=9)
    near = {f"S{n:03d}": set(range(n % 3, 20 + n % 3)) for n in range(60)}
    frame = by_popcount(library(spark, {**sets, **near}, 8), new_dir(spark, "bits"), 500)
    sources = ids(spark, *[f"S{n:03d}" for n in range(0, 60, 20)])
    settings = Settings(n_bits=512, top_n=5)
    held = next(source_passes(sources, frame, settings))
    floors = sample_floors(frame, held, 6, frame.count())
    low, high = bit_counts(held, floors)
    assert (floors > 0.7).all() and 0 < low <= 20 <= high < 32
    skipped = frame.where(~F.col("pc").between(low, high)).count()
    assert skipped > 3500
    plan = frame.where(F.col("pc").between(low, high))._jdf.queryExecution().toString()
    assert f"GreaterThanOrEqual(pc,{low})" in plan and f"LessThanOrEqual(pc,{high})" in plan
    monkeypatch.setattr(similarity, "_ROWS_AT_ONCE", 64)
    scorer = Scorer(held.ids, held.words, held.counts)
    batches = [b.select(["item_id", "fp", "pc"]) for b in frame.toArrow().to_batches()]
    found = search_batches(iter(batches), scorer, 6, floors)
    assert scorer.pairs < 3 * 4060 / 4 and (found.scores >= 0).all()


def test_search_with_sampled_floors_equals_ranking_the_full_table(spark, rows, monkeypatch):
    monkeypatch.setattr(similarity, "_SAMPLE_ROWS", 40)
    sets = {**random_sets(500, 128, 60), **{f"C{n:03d}": {1, 2, 3} for n in range(150)}}
    settings = Settings(n_bits=128, top_n=6, sources_per_pass=11)
    frame = by_popcount(library(spark, sets, 2), new_dir(spark, "bits"), 100)
    sources = ids(spark, *sorted(sets)[::20])
    want = top_matches(score_table(frame, sources, settings), 6)
    assert rows(search(frame, sources, settings)) == rows(want)


def test_plan_has_no_join_of_pairs(spark):
    made = search(library(spark, {"A": {1}, "B": {2}}), ids(spark, "A"), DENSE)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
