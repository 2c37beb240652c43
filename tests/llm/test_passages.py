"""Decontamination and license scans against plain definitions."""

import random

import pytest
from hypothesis import given, settings, strategies as st

from kinmart.llm import decontaminate as dec, license_scan as lic

SCHEMA = "doc_id long, text string, matches string, row int"
ITEMS = "item_id long, text string, extra int"


def nearest(pattern, text):
    """Least edit distance of the pattern to any stretch of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for k, a in enumerate(pattern, 1):
        new = [k]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=120))
@settings(max_examples=200, deadline=None)
def test_bit_vectors_give_the_edit_distance(pattern, text):
    scores = list(dec.Pattern(pattern).distances(text, False))
    assert min([len(pattern), *scores]) == nearest(pattern, text)


@given(st.text("ab ", min_size=1, max_size=60), st.integers(0, 9))
@settings(max_examples=100, deadline=None)
def test_pieces_make_up_the_item(item, budget):
    cut = dec.pieces(item, budget)
    assert len(cut) == budget + 1 and "".join(p for _, p in cut) == item
    assert all(item[a : a + len(p)] == p for a, p in cut)


def edited(dice, text, n):
    chars = list(text)
    for _ in range(n):
        at = dice.randrange(len(chars))
        change = dice.randrange(3)
        if change == 0:
            chars[at] = "q"
        elif change == 1:
            del chars[at]
        else:
            chars.insert(at, "q")
    return "".join(chars)


def test_matches_are_those_of_the_full_table(spark):
    dice = random.Random(8)
    word = lambda: "".join(dice.choices("abcdefgh", k=dice.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(dice.randint(1, 25))), 1) for k in range(12)]
    items += [(90, None, 1), (91, " \n", 1), (None, "an item without id it is", 1), (0, items[0][1], 1)]
    rows = [(1, None, "m", 1), (2, "", "m", 1), (None, items[3][1].upper(), "m", 1)]
    rows += [(7, "x " + items[5][1] + " y", "m", 1)] * 2 + [(8, "an item\nwithout  id it is", "m", 1)]
    for k in range(80):
        parts = [" ".join(word() for _ in range(dice.randint(0, 30)))]
        for _ in range(dice.choice([0, 1, 1, 2])):
            text = dice.choice(items[:12])[1]
            parts += [edited(dice, text, dice.choice([0, 1, 2, 3, 6])), word()]
        rows.append((100 + k, "\n".join(parts), "m", 1))
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, ITEMS)
    got = sorted(
        ((r.doc_id, r.item_id, r.distance) for r in dec.matches(docs, bench).collect()), key=str
    )
    want = []
    for doc, text, *_ in rows:
        for key, item in {(i[0], i[1]) for i in items}:
            item, held = dec.normal(item), dec.normal(text)
            if item and held and (d := nearest(item, held)) <= len(item) * 5 // 100:
                want.append((doc, key, d))
    assert got == sorted(want, key=str)
    assert len(want) > 30
    hit = {i for i, _, _ in want}
    kept = sorted((tuple(r) for r in dec.clean(docs, bench).collect()), key=str)
    assert kept == sorted((r for r in rows if r[0] not in hit), key=str)


def test_blocks_find_what_one_block_finds(spark, monkeypatch):
    items = [(k, f"item number {k} in words of its own {k * 7}", 1) for k in range(20)]
    rows = [(k, f"before {items[k][1]} after", "m", 1) for k in range(20)] + [(99, "clean", "m", 1)]
    docs, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(dec, "BLOCK_CHARS", 200)
    assert len(list(dec.blocks(bench, "item_id", "text"))) > 3
    got = {(r.doc_id, r.item_id) for r in dec.matches(docs, bench).collect() if not r.distance}
    assert got == {(k, k) for k in range(20)}
    assert [tuple(r) for r in dec.clean(docs, bench).collect()] == [rows[-1]]


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    assert dec.matches(docs, bench).count() == 0
    some = spark.createDataFrame([(1, "text", "m", 1)], SCHEMA)
    assert dec.matches(some, bench).count() == 0 and dec.clean(some, bench).count() == 1


def longest_by_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[j - 1]))
        row = new
    return row[-1]


@given(st.permutations(range(9)), st.permutations(range(9)))
@settings(max_examples=100, deadline=None)
def test_without_repeats_the_first_anchors_are_a_longest_common_run(a, b):
    pairs = lic.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p < r and q < s for (p, q), (r, s) in zip(pairs, pairs[1:]))
    rise = lic.longest_rise([b.index(x) for x in a])
    assert len(rise) == longest_by_table(a, b)


def test_gaps_are_aligned_in_turn():
    text = "x the a of b the c of y".split()
    template = "the a of b the c of".split()
    assert len(lic.align(text, template)) == 7


LICENSED = {
    "Released under the MIT License.": [("MIT", "notice")],
    "so: released, under the mit\nlicense": [("MIT", "notice")],
    "Licensed under CC BY-NC 4.0.": [("CC-BY-NC-4.0", "notice")],
    "Licensed under the Acme License, Version 2.0": [],
    "the license of the work is under version 2.0 of apache": [],
}


@pytest.mark.parametrize("text", LICENSED)
def test_notices(text):
    found = lic.Scanner(lic.TEMPLATES, 0.85).scan("word " * 500 + text + " tail" * 500)
    assert [x[:2] for x in found] == LICENSED[text]
    for x in found:
        assert (x[3] >= 498, x[4] < 520) == (True, True)


@pytest.mark.parametrize("template", lic.TEMPLATES, ids=lambda t: f"{t.license}/{t.name}")
def test_every_template_finds_itself_with_some_words_changed(template):
    scanner = lic.Scanner(lic.TEMPLATES, 0.85)
    whole = [x for x in scanner.scan(f"A {template.text} and {template.text}") if x[0] == template.license]
    assert any(x[2] == 1.0 for x in whole)
    words = template.text.split()
    if len(words) > 30:
        for k in range(5, len(words), 12):
            if not any(m in words[k].lower() for m in template.must):
                words[k] = "changed"
        found = scanner.scan("the of " * 200 + " ".join(words) + " and to" * 200)
        assert template.license in [x[0] for x in found]


def test_scan_rows(spark):
    rows = [(1, None, "", 1), (2, "", "", 1), (None, "Released under the MIT License", "", 1)]
    rows += [(3, "Licensed under CC BY 4.0", "", 1)] * 2 + [(4, "plain " * 30_000, "", 1)]
    got = [tuple(r)[:4] for r in lic.scan(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(
        [(None, "MIT", "notice", 1.0)] + [(3, "CC-BY-4.0", "notice", 1.0)] * 2, key=str
    )
    assert lic.scan(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize(
    "license, name",
    [(x.license, x.name) for x in lic.TEMPLATES if x.license[:3] in ("GPL", "LGP", "AGP", "BSD", "0BS", "ISC", "CC-")],
)
def test_kindred_licenses_are_told_apart(license, name):
    """A text of one license is reported as that license and no other."""
    text = next(x.text for x in lic.TEMPLATES if (x.license, x.name) == (license, name))
    found = lic.Scanner(lic.TEMPLATES, 0.85).scan("word " * 300 + text + " tail" * 300)
    assert {x[0] for x in found} == {license} and max(x[2] for x in found) == 1.0


def test_common_licenses_are_known():
    known = {x.license for x in lic.TEMPLATES}
    assert known >= {"GPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-3-Clause", "Unlicense"}
    text = "This work is licensed under the GNU Affero General Public License, version 3"
    found = lic.Scanner(lic.TEMPLATES, 0.85).scan(text)
    assert [x[:3] for x in found] == [("AGPL-3.0", "notice", 1.0)]


@pytest.mark.parametrize("every, extra", [(6, ["dnl"]), (3, ["rem", "17"]), (1, ["x", "y"])])
def test_words_in_between_are_borne_at_every_offset(every, extra):
    scanner = lic.Scanner(lic.TEMPLATES, 0.85)
    for name in ("Apache-2.0", "GPL-3.0"):
        template = next(x for x in lic.TEMPLATES if (x.license, x.name) == (name, "header"))
        words = [w.decode() for w in lic.words_of(template.text)]
        mixed = [w for k, word in enumerate(words) for w in (extra if k and k % every == 0 else []) + [word]]
        for offset in range(len(words) // 2 + 1):
            found = scanner.scan(" ".join(["q"] * (100 + offset) + mixed + ["z"] * 100))
            assert (name, "header", 1.0, 100 + offset, 99 + offset + len(mixed)) in found


def test_notices_bear_half_as_many_words_at_every_offset():
    scanner = lic.Scanner(lic.TEMPLATES, 0.85)
    for offset in range(6):
        for notice, found in (("licensed under dnl the rem mit license", 1), ("released under the x y z v w mit license", 0)):
            assert len(scanner.scan("q " * (50 + offset) + notice + " z" * 50)) == found


def every_window(scanner, text):
    """(license, template, first, last) by aligning each template at every word of the text."""
    words, out = lic.words_of(text), []
    for k, template in enumerate(scanner.templates):
        size, held = len(scanner.words[k]), []
        for start in range(len(words)):
            for reach in lic.reaches(size):
                pairs = lic.align(words[start : start + reach], scanner.words[k])
                aligned = {scanner.vocabulary[scanner.words[k][q]] for _, q in pairs}
                if len(pairs) < scanner.least * size or not aligned.issuperset(scanner.must[k]):
                    continue
                if pairs[-1][0] - pairs[0][0] < lic.reaches(size)[-1]:
                    held.append((-len(pairs), start + pairs[0][0], start + pairs[-1][0]))
        taken = []
        for cost, first, last in sorted(set(held)):
            if all(last < a or first > b for a, b, _ in taken):
                taken.append((first, last, -cost))
        out.extend((template.license, template.name, *place) for place in taken)
    kept = [
        x for x in out
        if not any(y[4] > x[4] and y[2] <= x[2] and y[3] >= x[3] for y in out)
    ]
    return sorted(x[:4] for x in kept)


def test_scans_equal_a_scan_of_every_window():
    dice = random.Random(21)
    some = [x for x in lic.TEMPLATES if len(lic.words_of(x.text)) <= 40]
    scanner = lic.Scanner(some, 0.85)
    filler = [f"q{k}" for k in range(9)]
    for _ in range(14):
        parts = []
        for _ in range(dice.randint(1, 3)):
            # Far enough apart that no place can take words of two notices.
            parts += dice.choices(filler, k=dice.randint(125, 150))
            words = dice.choice(some).text.split()
            if dice.random() < 0.5 and len(words) > 8:
                words[dice.randrange(len(words))] = "changed"
            parts += words
        text = " ".join(parts + dice.choices(filler, k=30))
        got = sorted((x[0], x[1], x[3], x[4]) for x in scanner.scan(text))
        assert got == every_window(scanner, text)


def test_every_grant_of_a_file_is_reported():
    grant = next(x for x in lic.TEMPLATES if x.license == "MIT" and len(x.text) > 300)
    text = f"one {grant.text} two " + "between " * 50 + f"{grant.text} three {grant.text}"
    found = [x for x in lic.Scanner(lic.TEMPLATES, 0.85).scan(text) if x[1] == grant.name]
    size = len(lic.words_of(grant.text))
    assert [(x[0], x[2], x[3]) for x in found] == [
        ("MIT", 1.0, 1), ("MIT", 1.0, 52 + size), ("MIT", 1.0, 53 + 2 * size)
    ]
