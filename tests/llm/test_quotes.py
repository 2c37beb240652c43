"""Quotation linking against a plain walk over each conversation, and no Python in the plan."""

import random
import re

from kinmart.llm.quotes import link_quotes

SCHEMA = "conv_id long, turn long, role string, text string, content int, uid string"


def squeeze(text):
    return " ".join(text.lower().split())


def split(text):
    """(level, line) of every line."""
    out = []
    for line in (text or "").split("\n"):
        marks = re.match(r"[ \t]*(?:>[ \t]*)+", line)
        out.append((marks[0].count(">"), line[marks.end() :]) if marks else (0, line))
    return out


def units(text):
    """(level, key, weight) of passages and lines."""
    out, lines = [], split(text)
    for level, line in lines:
        out.append((level, squeeze(line), 1))
    k = 0
    while k < len(lines):
        j = k
        while j < len(lines) and lines[j][0] == lines[k][0]:
            j += 1
        out.append((lines[k][0], squeeze(" ".join(x for _, x in lines[k:j])), j - k + 1))
        k = j
    return [x for x in out if x[1]]


def brute(rows):
    """(conv, position, turn, role, content, reply_to, thread), for distinct turns."""
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        first, reply = {}, {}
        for _, turn, _, text, *_ in own:
            votes = {}
            for level, key, weight in units(text):
                if level and first.get(key, turn) < turn:
                    votes[(level, first[key])] = votes.get((level, first[key]), 0) + weight
            if votes:
                least = min(level for level, _ in votes)
                best = max((w, t) for (level, t), w in votes.items() if level == least)
                reply[turn] = best[1]
            for level, key, _ in units(text):
                if not level:
                    first.setdefault(key, turn)
        thread = {}
        for _, turn, *_ in own:
            thread[turn] = thread[reply[turn]] if turn in reply else turn
        for at, r in enumerate(sorted(own, key=lambda r: (thread[r[1]], r[1]))):
            text = r[3] or ""
            if any(level for level, _ in split(text)):
                text = "\n".join(x for level, x in split(text) if not level).strip("\n")
            out.append((conv, at, r[1], r[2], text, reply.get(r[1]), thread[r[1]]))
    return sorted(out)


def linked(spark, rows):
    made = link_quotes(spark.createDataFrame(rows, SCHEMA))
    names = ["conv_id", "position", "turn", "role", "content", "reply_to", "thread"]
    return sorted((tuple(r[n] for n in names) for r in made.collect()), key=str), made


def test_nested_and_partial_quotes(spark):
    rows = [
        (1, 0, "a", "First point\nSecond point\n\nA last word", 7, "u"),
        (1, 1, "b", "Something else", 7, "u"),
        (1, 2, "c", "> first   POINT\n> Second point\n\nI agree", 7, "u"),
        (1, 3, "d", ">> First point\n>> Second point\n> I agree\nSo do I", 7, "u"),
        (1, 4, "e", "> A last word\nNo", 7, "u"),
        (1, 5, "f", "> nobody said this\nHm", 7, "u"),
        (2, 0, "a", "> First point\nquotes another conversation", 7, "u"),
        (2, 1, "b", None, 7, None),
    ]
    got, _ = linked(spark, rows)
    assert got == sorted(brute(rows), key=str)
    by_turn = {(r[0], r[2]): r for r in got}
    assert [by_turn[(1, t)][5] for t in range(6)] == [None, None, 0, 2, 0, None]
    assert [r[2] for r in sorted(got, key=lambda r: r[:2]) if r[0] == 1] == [0, 2, 3, 4, 1, 5]
    assert by_turn[(1, 3)][4] == "So do I" and by_turn[(2, 1)][4] == ""


def test_random_conversations(spark):
    dice = random.Random(6)
    rows = []
    for conv in range(25):
        said = []
        for turn in range(dice.randint(1, 12)):
            lines = []
            for _ in range(dice.randint(0, 3)):
                if said and dice.random() < 0.6:
                    quoted = dice.choice(said).split("\n")
                    lines += ["> " + x for x in quoted[: dice.randint(1, 3)]]
                else:
                    lines.append(f"words {dice.randint(0, 20)} of turn")
            said.append("\n".join(lines))
            rows.append((conv, turn, "user", said[-1], 7, "u"))
    dice.shuffle(rows)
    got, _ = linked(spark, rows)
    assert got == sorted(brute(rows), key=str)


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, None, None, "> x", 1, ""), (1, None, "a", "x", 1, ""), (1, 2, "b", "> x\ny", 1, "")]
    rows += [(1, 3, "c", "same", 1, "")] * 2 + [(2, 0, "d", "w " * 50_000 + "\n> " * 500, 1, "")]
    got, _ = linked(spark, rows)
    assert len(got) == len(rows)
    assert sorted(r[1] for r in got if r[0] == 1) == [0, 1, 2, 3]
    assert linked(spark, [])[0] == []


def test_no_python_in_the_plan(spark):
    made = link_quotes(spark.createDataFrame([(1, 0, "a", "x", 1, "")], SCHEMA))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
