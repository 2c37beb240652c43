"""Quality rules: brute-force counts, and verdicts on rows the model has not seen."""

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from kinmart.llm import quality_rules as rules

SCHEMA = "doc_id long, text string, n_words string, kept int, score string"


def plain_counts(text):
    words, word = [], ""
    for c in text + " ":
        if c in rules.BLANKS:
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    marked = set()
    for k in range(len(words) - 4):
        if windows[tuple(words[k : k + 5])] > 1:
            marked |= set(range(k, k + 5))
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if any(c not in rules.BLANKS for c in line):
            repeated += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeated, len(marked)


@given(st.text(alphabet="ab#|é\x1c\xa0 \n\t", max_size=200))
@settings(max_examples=300, deadline=None)
def test_counts_follow_the_definition(text):
    assert rules.base_counts(text) == plain_counts(text)


def prose(dice, words):
    return " ".join(dice.choice(words) for _ in range(dice.randint(20, 60)))


@pytest.fixture
def corpus():
    dice = random.Random(3)
    good = [f"{a}{b}" for a in ("the", "an", "of", "with") for b in ("re", "ing", "ion", "ly")]
    bad = [f"{w}***" for w in good]
    rows, labels = [], []
    for k in range(400):
        is_bad = k % 5 == 0
        rows.append((k, prose(dice, bad if is_bad else good), "x", 1, None))
        if k % 2 == 0:
            labels.append((k, 0 if is_bad else 1, 7))
    return rows, labels


def test_held_out_documents_are_told_apart(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, SCHEMA)
    model = rules.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r["row"]["doc_id"]: r for r in rules.judge(docs, model).collect()}
    unseen = [k for k in range(400) if k % 2]
    assert all(got[k]["kept"] == (k % 5 != 0) for k in unseen)
    for k in (1, 5, 8):
        assert got[k]["score"] == pytest.approx(model.score(rows[k][1]))
        assert (got[k]["row"]["kept"], got[k]["row"]["n_words"]) == (1, "x")


def test_the_raw_counts_cover_all_documents(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    one, two = rules.fit(docs, frame, bits=8), rules.fit(docs.coalesce(1), frame, bits=8)
    assert np.array_equal(one.ratios, two.ratios) and one.threshold == two.threshold
    good = sorted(k for k, q, _ in labels if q == 1)
    counted = set(good[::2])
    raw, trusted = np.zeros(256), np.zeros(256)
    for doc, text, *_ in rows:
        np.add.at(raw, rules.n_gram_buckets(text, 8), 1)
        if doc in counted:
            np.add.at(trusted, rules.n_gram_buckets(text, 8), 1)
    assert np.allclose(one.ratios, rules.log_ratios(trusted, raw, 1.0))


def test_nulls_empty_texts_and_missing_labels(spark):
    rows = [(1, None, "", 1, ""), (2, "", "", 1, ""), (None, "a " * 9, "", 1, ""), (3, "z" * 100_000, "", 1, "")]
    rows += [(4, " ".join(map(str, range(10))), "", 1, "")] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([(None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    model = rules.fit(docs, none)
    got = [(r["row"]["doc_id"], r["n_words"], r["base_failed"], r["kept"]) for r in rules.judge(docs, model).collect()]
    want = [(1, 0, True, False), (2, 0, True, False), (None, 9, True, False), (3, 1, True, False)]
    assert sorted(got, key=str) == sorted(want + [(4, 10, False, True)] * 2, key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert rules.judge(empty, rules.fit(empty, none)).count() == 0


def test_threshold_weighs_lost_good_rows():
    good, bad = np.array([1.0, 2.0, 3.0]), np.array([0.0, 0.5, 1.5])
    assert 0.5 < rules.threshold_for(good, bad, 10) < 1.0
    assert rules.threshold_for(good, bad[:0], 10) == float("-inf")
