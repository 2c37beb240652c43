"""Ranked lexical search against a plain definition."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kinmart.llm import lexical
from kinmart.llm.lexical import Best, Block, Query, rank_documents, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, term string, score long, rank int, n int"
ITEMS = "item_id long, text string, doc_id long, key int"


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    held = [(k, Counter(plain_terms(t))) for k, t in docs if plain_terms(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, counts in held:
            m = 25 + (75 * sum(counts.values()) * n_docs) // n_terms
            score = 0
            for term, times in Counter(plain_terms(text)).items():
                if counts[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * (10**9 * counts[term] // (1000 * counts[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, bare, doc) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if bare else doc, -score))
    return sorted(out, key=repr)


def searched(spark, docs, items, top=10):
    left = spark.createDataFrame([(*d, "x", 1, 2, 3) for d in docs], DOCS).repartition(5)
    right = spark.createDataFrame([(*i, 7, 8) for i in items], ITEMS)
    return sorted(map(tuple, rank_documents(left, right, top).collect()), key=repr)


def corpus(dice, n):
    words = [f"W{k}" for k in range(60)] + ["Élan", "naïve", "日本", "a1b2"]
    text = lambda: " ".join(dice.choices(words, [1 / (k + 1) for k in range(64)], k=dice.randint(1, 40)))
    return [(k, text()) for k in range(n)]


@pytest.mark.parametrize("block", [16, 8192])
def test_search_equals_the_definition(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    dice = random.Random(3)
    docs = corpus(dice, 300)
    docs += [(k + 500, docs[7][1]) for k in range(30)]  # ties, more than the list is long
    docs += [(None, docs[7][1]), (7, docs[7][1]), (7, "w1, w1; W1"), (900, None), (901, ""), (902, "!?")]
    items = [(k, t) for k, t in corpus(dice, 20)]
    items += [(30, docs[7][1]), (31, None), (32, "..."), (33, "nowhere"), (None, "w3 w4"), (34, "w1 " * 9)]
    items += [(35, " ".join(f"w{k}" for k in range(60)) + " " + " ".join(f"q{k}" for k in range(90)))]
    assert searched(spark, docs, items) == brute(docs, items)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    dice = random.Random(4)
    docs, items = corpus(dice, 80), corpus(dice, 12)
    want = brute(docs, items, 3)
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 200)
    assert searched(spark, docs, items, 3) == want


def test_long_texts_and_terms(spark):
    docs = [(1, "x" * 300_000), (2, "alpha beta " * 100_000), (3, "beta\x00gamma"), (4, "ALPHA_beta")]
    items = [(1, "x" * 300_000 + " alpha"), (2, "gamma beta")]
    assert searched(spark, docs, items) == brute(docs, items)


def test_empty_tables_give_no_rows(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [(1, "!")], [(1, "a")]) == []


def test_terms_are_cut_at_ascii_signs_alone():
    text = "".join(map(chr, range(0x250))) + " Ünï-日本_x y Z9"
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)


def test_masks_of_low_scores_are_not_evaluated():
    """A rare term fills the list, so documents of the common term alone are never scored."""
    n = 4000
    doc = np.r_[np.arange(n), np.arange(12)]
    terms = np.r_[np.zeros(n, np.int64), np.ones(12, np.int64)]
    block = Block(np.arange(n), np.zeros(n, bool), np.full(n, 50), terms, np.ones(n + 12, np.int64), doc, n, 50 * n)
    best = Best(10)
    block.search(Query(0, 0, np.array([0, 1]), np.array([1, 8000])), best)
    assert block.seen == 12 and best.ids.tolist() == list(range(10))
    block.seen = 0
    other = Block(np.arange(n), np.zeros(n, bool), np.full(n, 50), terms[:n], np.ones(n, np.int64), doc[:n], n, 50 * n)
    other.search(Query(0, 0, np.array([0, 1]), np.array([1, 8000])), best)
    assert other.seen == 0
