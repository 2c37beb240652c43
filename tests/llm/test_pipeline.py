"""The pipeline: each stage against a plain version of itself on a small corpus."""

import random

import corpus_pipeline as cp
import pytest
from kinmart.llm import quality_rules
from kinmart.workspace import new_dir, stage
from test_lines import brute as brute_lines
from test_near_dup import brute as brute_components
from test_tokens_and_files import check_pieces

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(dice):
    return " ".join(f"w{dice.randint(0, 300)}" for _ in range(dice.randint(12, 40)))


@pytest.fixture(scope="module")
def folder(spark):
    dice = random.Random(12)
    shared = sentence(dice)
    items = [(k, sentence(dice)) for k in range(6)]
    rows, labels = [], []
    for k in range(160):
        lines = [sentence(dice) for _ in range(dice.randint(1, 3))]
        if k % 11 == 0:
            lines.append(shared)
        if k % 13 == 0:
            lines.append("before " + items[k % 6][1] + " after")
        text = "\n".join(lines)
        if k % 7 == 0:
            text = " ".join(f"{w}***" for w in text.split())
        if k % 10 == 3:
            text = rows[-1][1]
        elif k % 10 == 4 and rows[-1][1]:
            text = rows[-1][1] + " one"
        labels.append((k, 0 if "***" in text else 1, 0))
        rows.append((k, text, "en", "ab"[k % 2], len(text)))
    rows += [(500, None, "en", None, None), (501, "", None, "a", 0)]
    path = new_dir(spark, "pipeline-input")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame.write.parquet(f"{path}/labels.parquet")
    bench = spark.createDataFrame(items, "item_id long, text string")
    bench.write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_every_stage_does_its_work_on_what_the_last_one_kept(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    before = [tuple(r) for r in docs.collect()]
    for name, apply in cp.STAGES[:-1]:
        docs = stage(apply(spark, docs, path), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = [tuple(r) for r in docs.collect()]
        if name == "quality_rules":
            assert all("***" not in r[1] for r in after)
            words = lambda r: len((r[1] or "").split())
            assert {r[0] for r in before if words(r) >= 10 and "***" not in r[1]} == {r[0] for r in after}
        elif name == "line_dedup":
            want = {r[0]: r[1] for r in brute_lines(before)}
            assert {r[0]: r[1] for r in after} == want
            assert all(r[4] == len(r[1]) for r in after)
        elif name == "near_dedup":
            want = {r[0] for r in brute_components(before, 5) if r[3]}
            assert {r[0] for r in after} == want and len(want) < len(before)
        else:
            leaks = {r[0] for r in before if any(i[1] in r[1].replace("\n", " ") for i in items)}
            assert leaks and {r[0] for r in after} == {r[0] for r in before} - leaks
        assert len(after) <= len(before)
        before = after
    pieces = cp.STAGES[-1][1](spark, docs, path)
    check_pieces(before, pieces.collect(), 2048)


def test_a_run_gives_what_its_stages_give(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, apply in cp.STAGES:
        docs = stage(apply(spark, docs, path), "test-stage")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(cp.run(spark, path)) == key(docs)
    assert cp.ORACLE_SQL is None and [n for n, _ in cp.STAGES][0] == "quality_rules"


def test_an_empty_corpus_gives_no_sequences(spark, folder):
    path = new_dir(spark, "pipeline-empty")
    for table, schema in (
        ("documents", DOCS),
        ("labels", "doc_id long, quality int, toxic int"),
        ("benchmark", "item_id long, text string"),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{path}/{table}.parquet")
    assert cp.run(spark, path).count() == 0
    assert quality_rules.base_counts("") == (0, 0, 0, 0, 0)


def test_one_row_of_each_component_stays_whatever_the_ids(spark):
    dice = random.Random(31)
    a, b, c, d = (" ".join(f"v{dice.randint(0, 900)}" for _ in range(60)) for _ in range(4))
    rows = [(7, a), (3, a), (None, a), (None, b), (None, b), (None, c), (5, d), (5, d), (5, d + " end")]
    rows += [(None, None), (None, ""), (9, None), (5, "quite another text of the same id it is")]
    docs = spark.createDataFrame([(k, x, "en", "a", 0) for k, x in rows], DOCS)
    kept = cp.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    ends = [x for x in got if x[1] and x[1].startswith(d)]
    assert len(ends) == 1 and ends[0][0] == 5
    want = [(3, a), (None, b), (None, c), (None, None), (None, ""), (9, None), (5, rows[-1][1])]
    assert [x for x in got if x not in ends] == sorted(want, key=str)


def test_a_column_of_any_name_passes_unchanged(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "mine"), (2, "a b c d e f", "mine")], "doc_id long, text string, Near_Dedup_Row string")
    assert [tuple(r) for r in cp.drop_near_duplicates(spark, docs, "").collect()] == [(1, "a b c d e f", "mine")]


def test_texts_stay_where_they_are_while_near_duplicates_are_dropped(spark, rows, monkeypatch):
    texts = [f"v{k} w{k} x{k} y{k} z{k} end" for k in range(300)]
    given = [(k, texts[k % 290], "en", "a", 0) for k in range(300)]
    docs = spark.createDataFrame(given, DOCS)
    want = sorted(r for r in given if r[0] < 290)

    def run():
        kept = cp.drop_near_duplicates(spark, docs, "")
        assert sorted(rows(kept)) == want
        return kept._jdf.queryExecution().executedPlan().toString()

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "hashpartitioning" not in run()
        # More rows than may be broadcast.
        monkeypatch.setattr(cp, "MOST_SENT", 9)
        assert "hashpartitioning" in run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
