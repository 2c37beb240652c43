"""Near duplicates: exact components on small tables, sketches, and the closing step."""

import random

import numpy as np
import pytest

from kinmart.llm import near_dup
from kinmart.llm.components import components
from kinmart.llm.near_dup import NearDup, band_keys, confirmed, near_duplicates, shingles, sketch

SCHEMA = "doc_id long, text string, node string, root int, bands string"


def word_set(text, n):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1)))


def brute(rows, n, percent=80):
    """(doc_id, size, component, kept) with all pairs compared."""
    sets = [word_set(r[1], n) for r in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    out = []
    for k, row in enumerate(rows):
        ids = [r[0] for j, r in enumerate(rows) if root(j) == root(k) and r[0] is not None]
        low = min(ids) if ids else None
        out.append((row[0], len(sets[k]), low, row[0] == low))
    return sorted(out, key=str)


def found(spark, rows, job):
    docs = spark.createDataFrame(rows, SCHEMA)
    names = ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r[c] for c in names) for r in near_duplicates(docs, job).collect()), key=str)


def corpus(seed, n):
    """Families of texts that differ by some words, from clear copies to just unlike."""
    dice = random.Random(seed)
    rows = []
    while len(rows) < n:
        base = [f"w{dice.randint(0, 400)}" for _ in range(dice.randint(2, 60))]
        for _ in range(dice.choice([1, 1, 2, 6, 25])):
            words = list(base)
            for _ in range(int(len(words) * dice.choice([0, 0, 0.02, 0.04, 0.06, 0.1]))):
                words[dice.randrange(len(words))] = f"x{dice.randint(0, 9999)}"
            text = " ".join(words)
            rows.append((len(rows), text if dice.random() < 0.7 else text.upper(), "n", 1, "b"))
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("words", [2, 5])
def test_components_equal_all_pairs(spark, words):
    rows = corpus(words, 400)
    rows += [(900, None, "n", 1, "b"), (901, "", "n", 1, "b"), (902, " \n", "n", 1, "b")]
    rows += [(903, "one", "n", 1, "b"), (904, "ONE", "n", 1, "b"), (905, "two", "n", 1, "b")]
    rows += [(906, "a b c d e f g h", "n", 1, "b")] * 2
    rows += [(None, "a b c d e f g h", "n", 1, "b"), (None, "nobody else has this", None, None, None)]
    assert found(spark, rows, NearDup(words=words)) == brute(rows, words)


def test_a_link_outside_the_star_is_not_lost(spark, monkeypatch):
    """A chain in which the first document is the centre of every bucket."""
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(40):
        words = base[: 60 - k] + [f"y{j}" for j in range(k)]
        rows.append((k, " ".join(words), "n", 1, "b"))
    for k in range(40):
        words = list(base)
        words[k], words[(k + 7) % 60], words[(k + 23) % 60] = f"z{k}", f"v{k}", f"u{k}"
        rows.append((100 + k, " ".join(words), "n", 1, "b"))
    assert found(spark, rows, NearDup(words=2)) == brute(rows, 2)


def test_empty_table(spark):
    assert found(spark, [], NearDup()) == []


def test_sketches_estimate_similarity():
    dice = random.Random(1)
    for size in (1, 3, 40, 2000):
        a = np.unique(np.array([dice.getrandbits(64) for _ in range(size)], np.uint64))
        assert (sketch(a, 160) == sketch(a, 160)).all() and set(sketch(a, 160)) <= set(a & 0xFFFFFFFF)
        if size >= 40:
            fresh = np.array([dice.getrandbits(64) for _ in range(size // 10)], np.uint64)
            b = np.unique(np.concatenate([a[size // 10 :], fresh]))
            same = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            assert abs((sketch(a, 4096) == sketch(b, 4096)).mean() - same) < 0.12


def test_pairs_at_the_bound_meet_in_a_bucket():
    dice, job, missed = random.Random(4), NearDup(), 0
    for size in [5, 10, 45, 90, 450] * 20:
        whole = np.unique(np.array([dice.getrandbits(64) for _ in range(size)], np.uint64))
        part = np.sort(np.array(dice.sample(list(whole), size * 4 // 5), np.uint64))
        missed += not (band_keys(whole, job) == band_keys(part, job)).any()
    assert missed == 0


def test_confirmed_links_join_components_only():
    sets = [shingles(f"a b c d e f g h i j {x}", 2) for x in ("k", "l", "m")]
    job = NearDup(words=2)
    rows = [(k, k, s, band_keys(s, job)) for k, s in enumerate(sets)]
    assert len(confirmed(rows, rows, 80)) == 2
    assert confirmed(rows, [(9, 0, sets[0], rows[0][3])], 80)[0][1] == 9


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(100, 130)] + [(5, k) for k in range(6, 40)]
    links += [(1, 2), (2, 1), (3, 3), (50, 51), (51, 52), (52, 50)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    want = {k: 100 for k in range(100, 131)} | {k: 5 for k in range(5, 40)}
    want |= {1: 1, 2: 1, 50: 50, 51: 50, 52: 50}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_pages_of_one_template_ask_for_no_checks(spark, monkeypatch):
    """60 common words and 20 own ones a page, no two alike enough: what is checked grows with
    the pages, not with their square."""
    asked = []
    for name in ("short_lists", "list_blocks"):
        plain = getattr(near_dup, name)

        def counted(*args, plain=plain):
            made = plain(*args)
            asked.append(made.count())
            return made

        monkeypatch.setattr(near_dup, name, counted)
    seen = []
    for n in (400, 800):
        dice = random.Random(n)
        common = [f"t{k}" for k in range(60)]
        rows = [(k, " ".join(common + [f"o{k}x{j}" for j in range(20)]), "n", 1, "b") for k in range(n)]
        rows.append((n, " ".join(common + dice.sample(common, 20)), "n", 1, "b"))
        asked.clear()
        got = found(spark, rows, NearDup(words=2))
        assert all(r[0] == r[2] for r in got) and len(got) == n + 1
        seen.append(sum(asked))
    assert seen[1] <= 2 * seen[0] + 10


def test_long_lists_are_worked_off_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "SHORT", 4)
    monkeypatch.setattr(near_dup, "BLOCK", 5)
    for seed in (3, 11):
        rows = corpus(seed, 250)
        assert found(spark, rows, NearDup(words=2)) == brute(rows, 2)


def test_long_texts(spark):
    dice = random.Random(7)
    base = [f"w{dice.randint(0, 50_000)}" for _ in range(60_000)]
    other = base[:50_000] + [f"x{k}" for k in range(4_000)]
    rows = [(1, " ".join(base), "n", 1, "b"), (2, " ".join(other), "n", 1, "b"), (3, "w " * 50_000, "n", 1, "b")]
    assert found(spark, rows, NearDup(words=2)) == brute(rows, 2)


def test_many_rows_without_id_are_not_multiplied(spark, monkeypatch):
    made = []
    plain = near_dup.candidate_sets
    monkeypatch.setattr(near_dup, "candidate_sets", lambda *a: made.append(plain(*a)) or made[-1])
    held = []
    compare = near_dup.compare
    monkeypatch.setattr(near_dup, "compare", lambda b, s, p: held.append(s.count()) or compare(b, s, p))
    rows = []
    for k in range(150):
        words = [f"a{k // 2}b{j}" for j in range(40)]
        words[k % 2] = "one" if k % 2 else words[0]
        rows.append((None, " ".join(words), "n", 1, "b"))
    assert found(spark, rows, NearDup(words=2)) == brute(rows, 2)
    assert held and max(held) <= len(rows)


def test_links_of_a_given_table_are_all_found(spark):
    """Recall 1 against all pairs of a given table, with both lengths of shingles."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"], "n", 1, "b") for r in docs.collect()]
    for words in (2, 5):
        assert found(spark, rows, NearDup(words=words)) == brute(rows, words)
