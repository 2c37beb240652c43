"""The prefix trie against a plain definition."""

import hashlib
import random
import re
import zlib

import pytest

from kinmart.llm.prefix_trie import SearchTree, medians, prefix_trie, rebuilt, turn_lists

SCHEMA = "conv_id long, turn long, role string, text string, key string, shard long, path int"


def plain_lists(rows):
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def plain_rebuilt(lists):
    made = {}
    for c, turns in lists.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = lists.get(c - c % 20, [])[:h] + turns[h:]
    return made


def brute(lists):
    members = {}
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = ({path: 0 for path in members} for _ in range(3))
    for path, convs in members.items():
        if path:
            kids[path[:-1]] += 1
    for path, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(convs) - 1) * words
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(lists[c]) == len(path))
        up = min(members[path[:-1]]) if path else None
        out.append(
            (min(convs), len(path), up, len(convs), kids[path], leaves[path], saved[path],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA).repartition(3)


def found(df, shard_turns):
    return sorted(map(tuple, prefix_trie(df, shard_turns).collect()), key=repr)


def conversations(dice, n):
    rows = []
    for c in range(n):
        for t in range(dice.randint(1, 6)):
            rows.append((c, t, "ab"[t % 2], dice.choice(["hi", "yes  no", "a b\nc", ""])))
    return rows


@pytest.mark.parametrize("shard_turns", [1, 7, 1 << 18])
def test_trie_equals_the_definition(spark, shard_turns):
    dice = random.Random(8)
    rows = conversations(dice, 90)
    same = [(0, "a", "one two three"), (1, "b", "four"), (2, "a", "five six")]
    rows += [(1000 + k, *turn) for k in range(60) for turn in same]  # one sequence, many times
    rows += [(2000, k, "a", "long " * (k % 3)) for k in range(300)]
    rows += [(2001, k, "a", "long " * (k % 3)) for k in range(280)]
    rows += [(3000, None, None, None), (3000, 4, "a", "x"), (None, 1, "a", "no conversation")]
    lists = turn_lists(frame(spark, rows))
    assert found(lists, shard_turns) == brute(plain_lists(rows))
    assert found(rebuilt(lists), shard_turns) == brute(plain_rebuilt(plain_lists(rows)))


def test_repeated_turns_and_rows(spark):
    rows = [(1, 1, "a", "x"), (1, 1, "a", "x"), (2, 1, "a", "x"), (2, 1, "a", "x"), (-3, 1, "a", "x")]
    rows += [(5, 0, "a:b", "c"), (6, 0, "a", "b:c"), (7, 0, "", "a:b:c")]  # not the same turn
    lists = turn_lists(frame(spark, rows))
    assert found(lists, 2) == brute(plain_lists(rows))


def test_a_conversation_without_turns_ends_at_the_root(spark):
    shorter = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    rows = [(shorter, 0, "a", "only")]
    lists = rebuilt(turn_lists(frame(spark, rows)))
    want = hashlib.sha256(str(shorter).encode()).hexdigest()
    assert found(lists, 10) == [(shorter, 0, None, 1, 0, 1, 0, want)]


def test_an_empty_table_gives_no_rows(spark):
    lists = turn_lists(frame(spark, []))
    assert found(rebuilt(lists), 10) == [] and found(lists, 10) == []


def test_very_long_texts(spark):
    rows = [(c, t, "a", "word " * 100_000) for c in (1, 2) for t in (0, 1)]
    assert found(turn_lists(frame(spark, rows)), 10) == brute(plain_lists(rows))


def test_medians_first_keeps_siblings_balanced():
    assert sorted(medians(1000)) == list(range(1000))
    tree = SearchTree()
    for k in medians(1023):
        tree.insert([k])
    deep, open_ = 0, [(tree.down[0], 1)]
    while open_:
        node, depth = open_.pop()
        if node >= 0:
            deep = max(deep, depth)
            open_ += [(tree.left[node], depth + 1), (tree.right[node], depth + 1)]
    assert deep == 10
