"""Line dedup: brute force, and states that insertions and deletions must agree on."""

import random

import numpy as np
import pytest

from kinmart.llm.cuckoo import CuckooFilter, Full
from kinmart.llm.line_dedup import LineIndex

SCHEMA = "doc_id long, text string, n_lines string, row string, drops int"
BLANK = " \t\n\x0b\x0c\r"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_chars=10):
    """(doc_id, kept text, lines, dropped) by the definition."""
    owner, holders = {}, {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            key = low(line.strip(BLANK))
            if doc is not None and len(key) >= min_chars:
                holders.setdefault(key, set()).add(doc)
                owner[key] = min(owner.get(key, doc), doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        keys = [low(x.strip(BLANK)) for x in lines]
        stay = [
            x
            for x, key in zip(lines, keys)
            if doc is None or len(holders.get(key, ())) < 2 or owner[key] == doc
        ]
        out.append((doc, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def cleaned(index, docs):
    return sorted(
        ((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in index.clean(docs).collect()), key=str
    )


def some_rows(seed, n):
    dice = random.Random(seed)
    lines = ["A shared LINE here", " a shared line here\t", "short", "", "éééééééééé", "ééééééééé", "x" * 300]
    lines += [f"line number {k} of many" for k in range(12)]
    rows = []
    for k in range(n):
        text = "\n".join(dice.choices(lines, k=dice.randint(0, 6)))
        rows.append((dice.choice([k, k, k, 3, None]), dice.choice([text, text, text, None]), "c", "d", 1))
    return rows


def test_filters_hold_what_they_were_given():
    keys = np.random.default_rng(2).integers(-(1 << 62), 1 << 62, 20_000)
    held = CuckooFilter.sized(len(keys))
    held.insert(keys)
    assert (held.count(keys) >= 1).all()
    held.insert(keys[:500])
    assert (held.count(keys[:500]) >= 2).all()
    others = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 20_000)
    assert (held.count(others) > 0).mean() < 0.01
    again = CuckooFilter.load(held.dump())
    again.remove(keys[:500])
    assert (again.count(keys) >= 1).all()
    again.remove(keys)
    assert not again.table.any()
    with pytest.raises(ValueError):
        again.remove(keys[:1])


def test_a_full_filter_says_so_and_stays_as_it_was():
    held = CuckooFilter(4)
    held.insert(np.arange(8))
    before = held.table.copy()
    with pytest.raises(Full):
        held.insert(np.arange(100, 140))
    assert (held.table == before).all()


def test_cleaning_follows_the_definition(spark):
    rows = some_rows(1, 60)
    docs = spark.createDataFrame(rows, SCHEMA)
    index = LineIndex.build(docs)
    assert cleaned(index, docs) == brute(rows)
    row = index.clean(docs).first()["row"]
    assert (row["n_lines"], row["row"], row["drops"]) == ("c", "d", 1)


def test_inserting_and_deleting_is_reversible(spark):
    first = [(2 * k, t, "c", "d", 1) for k, (_, t, *_) in enumerate(some_rows(2, 30))]
    second = [(2 * k + 1, t, "c", "d", 1) for k, (_, t, *_) in enumerate(some_rows(3, 30))]
    one, two = spark.createDataFrame(first, SCHEMA), spark.createDataFrame(second, SCHEMA)
    start = LineIndex.build(one)
    both = start.insert(two)
    assert cleaned(both, one.unionByName(two)) == brute(first + second)
    counts = lambda x: sorted(map(tuple, x.refs.collect()))
    assert counts(both) == counts(LineIndex.build(one.unionByName(two)))
    back = both.delete(two)
    assert counts(back) == counts(start)
    assert cleaned(back, one) == brute(first)
    gone = both.delete(one.where("doc_id < 20"))
    rest = [r for r in first if r[0] >= 20] + second
    assert cleaned(gone, spark.createDataFrame(rest, SCHEMA)) == brute(rest)
    empty = start.delete(one)
    assert empty.refs.count() == 0
    assert all(not np.frombuffer(r.slots, "u1").any() for r in empty.filters.collect())


def test_an_empty_table_has_no_lines(spark):
    none = spark.createDataFrame([], SCHEMA)
    index = LineIndex.build(none)
    assert index.clean(none).count() == 0
    docs = spark.createDataFrame([(1, "a line long enough", "", "", 1)], SCHEMA)
    assert cleaned(index.insert(docs), docs) == brute([(1, "a line long enough")])
