import random

import pytest

from kinmart.operators.ranking import first_per_key, latest_per_key, top_matches

SCORED = "source_id string, target_id string, score double"


def scored(spark, values, source="S", ids=None):
    names = ids or [f"T{place}" for place in range(len(values))]
    return spark.createDataFrame([(source, t, float(v)) for t, v in zip(names, values)], SCORED)


def flags(df):
    return [row[3] for row in df.orderBy("match_rank").collect()]


def expected(values, n):
    """(target, score, flag, rank) of one source, from the definition."""
    ordered = sorted(values, key=lambda pair: (-pair[1], pair[0]))
    kept = ordered[:n]
    if not kept:
        return []
    lowest = kept[-1][1]
    overflow = sum(score >= lowest for _, score in ordered) > n
    return [
        (target, score, overflow and score == lowest, place)
        for place, (target, score) in enumerate(kept, start=1)
    ]


@pytest.mark.parametrize(
    ("values", "n", "want"),
    [
        ([0.9, 0.5, 0.5, 0.5], 3, [False, True, True]),
        ([0.9, 0.5, 0.5], 3, [False, False, False]),
        ([0.9, 0.5, 0.1], 2, [False, False]),
        ([0.9, 0.9, 0.5, 0.5, 0.5], 4, [False, False, True, True]),
        ([0.5, 0.4], 10, [False, False]),
    ],
)
def test_flag_marks_a_boundary_that_cut_a_tie(spark, values, n, want):
    assert flags(top_matches(scored(spark, values), n)) == want


def test_equal_scores_are_ordered_by_identifier(spark):
    made = top_matches(scored(spark, [0.5] * 3, ids=["C30", "C10", "C20"]), 3)
    assert [row[1] for row in made.orderBy("match_rank").collect()] == ["C10", "C20", "C30"]


def test_self_is_left_out_and_a_double_is_kept(spark):
    made = top_matches(scored(spark, [1.0, 1.0, 0.2], ids=["S", "S2", "T"]), 2).collect()
    assert [row[1] for row in made] == ["S2", "T"]


def test_ties_are_compared_before_rounding(spark):
    close = [0.5, 1 / 3, 1 / 3 + 1e-12]
    made = top_matches(scored(spark, close), 2).orderBy("match_rank").collect()
    assert str(made[1][2]) == "0.33333333" and not made[1][3]


@pytest.mark.parametrize("fan_in", [1, 3])
def test_random_groups_match_the_definition(spark, fan_in):
    random.seed(5)
    groups = {
        f"S{g:02d}": [
            (f"T{t}", random.choice([0.0, 0.25, 0.5, 0.75, 1.0])) for t in range(random.randint(0, 9))
        ]
        for g in range(40)
    }
    flat = [(s, t, v) for s, pairs in groups.items() for t, v in pairs]
    random.shuffle(flat)
    frame = spark.createDataFrame(flat, SCORED).repartition(6)
    made = {}
    for row in top_matches(frame, 4, fan_in).collect():
        made.setdefault(row[0], []).append((row[1], float(row[2]), row[3], row[4]))
    want = {s: expected(pairs, 4) for s, pairs in groups.items() if pairs}
    assert {s: sorted(r, key=lambda row: row[3]) for s, r in made.items()} == want
    assert any(row[2] for r in want.values() for row in r)


def test_one_source_may_hold_most_rows(spark):
    hot = spark.range(20_000).selectExpr(
        "'S' AS source_id", "concat('T', lpad(id, 8, '0')) AS target_id", "id % 7 / 7.0D AS score"
    )
    made = top_matches(hot.repartition(16), 3, fan_in=4).orderBy("match_rank").collect()
    assert [(r[1], r[3]) for r in made] == [
        ("T00000006", True), ("T00000013", True), ("T00000020", True)
    ]


def test_first_and_latest_per_key(spark, rows):
    frame = spark.createDataFrame([("a", 1, 2), ("a", 1, 1), ("b", 3, 0)], "k string, x int, y int")
    assert rows(first_per_key(frame, ["k"], frame.x, frame.y)) == [("a", 1, 1), ("b", 3, 0)]
    assert rows(latest_per_key(frame, ["k"], "x", "y")) == [("a", 1, 2), ("b", 3, 0)]


def test_only_one_row_per_key_and_task_is_shuffled(spark):
    frame = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = latest_per_key(frame, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
