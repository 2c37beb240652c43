"""Personal data: patterns against plain regular expressions, and what the field adds."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from kinmart.llm import pii

SCHEMA = "doc_id long, text string, spans int, n_email string, row string"


def luhn(number):
    doubled = [sum(divmod(int(c) * 2, 10)) if k % 2 else int(c) for k, c in enumerate(number[::-1])]
    return sum(doubled) % 10 == 0


def plain_spans(text):
    only = lambda x: re.sub("[^0-9]", "", x)
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(only(m[0])) <= 19 and luhn(only(m[0])):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(only(m[0])) <= 15:
            out.append((3, *m.span()))
    return out


@given(st.text(alphabet="a1.@-+ 0(é٣", max_size=60))
@settings(max_examples=800, deadline=None)
def test_patterns_are_the_plain_ones(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_patterns_on_numbers_that_pass():
    text = "4539 1488 0343 6467, 4539-1488-0343-6467, 4539148803436468, +1 (017) 555-7713, 1.2.3.4.5.6.7.8"
    text += " 300.1.1.1 a.b@c-d.example.org@x.y 001.002.003.004"
    assert pii.base_spans(text) == plain_spans(text)
    assert [kind for kind, *_ in pii.base_spans(text)] == [0, 1, 1, 1, 2, 2, 3]


@pytest.mark.parametrize("piece", ["1", "a", "1.", "@a", "+1", "1 ", "a@", "(1"])
def test_long_texts_take_linear_time(piece):
    started = time.process_time()
    pii.base_spans(piece * 200_000)
    assert time.process_time() - started < 20


def secret(dice):
    return "".join(dice.choices("0123456789abcdef", k=40))


def prose(dice):
    return " ".join(dice.choice(["the", "road", "was", "long", "and", "Quiet."]) for _ in range(12))


@pytest.fixture(scope="module")
def model(spark):
    dice, rows = random.Random(2), []
    for k in range(300):
        key = secret(dice)
        text = f"{prose(dice)} token = \"{key}\" {prose(dice)} on day {dice.randint(1, 31)} of {dice.randint(1900, 2030)}"
        text += f" mail x{k}@example.org or +49 30 {dice.randint(100000, 999999)} {prose(dice)}"
        rows.append((k, text, 1, "", ""))
    return pii.fit(spark.createDataFrame(rows, SCHEMA))


def found(spark, model, rows):
    made = pii.find(spark.createDataFrame(rows, SCHEMA), model).collect()
    return {r["row"]["doc_id"]: r for r in made}


def test_pattern_spans_stay_and_secrets_are_added(spark, model):
    dice = random.Random(9)
    key = secret(dice)
    text = f"{prose(dice)} token = \"{key}\" {prose(dice) * 40} again {key}, then me@example.org"
    clean = prose(dice) + " in 1999 by 12 people at 10.5 of 3 " + prose(dice)
    rows = [(1, text, 1, "", ""), (2, clean, 1, "", "")]
    got = found(spark, model, rows)
    base = pii.written(pii.base_spans(text))
    assert got[1]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    secrets = [f"secret:{m.start()}:{m.end()}" for m in re.finditer(key, text)]
    assert got[1]["spans"].split(",") == [base, *secrets]
    assert (got[1]["n_email"], got[1]["row"]["spans"]) == (1, 1)
    assert got[2]["spans"] == ""


def test_skip_edges_carry_a_label_to_distant_copies():
    n = len(pii.LABELS)
    weights = np.zeros((pii.BUCKETS, n))
    agree = np.full((n, n), -3.0) + 6.0 * np.eye(n)
    token = "k3y-77-xyzzy"
    text = f"{token} first " + "word " * 500 + f"{token} last, 99 other"
    graph = pii.graph_of(text, [(3, 0, len(token))])
    assert graph.skip == [(0, 1)] and graph.chain == [(1, 2)]
    with_skip = pii.SkipChain(weights, np.zeros((n, n)), agree).beliefs([graph])
    without = pii.SkipChain(weights, np.zeros((n, n)), np.zeros((n, n))).beliefs([graph])
    assert with_skip[1].argmax() == 4 and with_skip[1].max() > 0.9
    assert without[1].max() < 0.3


def test_evidence_reaches_the_last_of_many_copies():
    """Given away once, a token is found in all of its 50 copies, and exactly as a chain says."""
    n, copies = len(pii.LABELS), 50
    agree = np.full((n, n), -4.0) + 8.0 * np.eye(n)
    token = "k3y-77-xyzzy"
    text = " and some words between ".join([token] * copies)
    graph = pii.graph_of(text, [(3, 0, len(token))])
    assert graph.skip == [(k, k + 1) for k in range(copies - 1)] and not graph.chain
    flat = np.zeros((n, n))
    got = pii.SkipChain(np.zeros((pii.BUCKETS, n)), flat, agree).beliefs([graph])
    step = np.exp(agree) / np.exp(agree).sum(axis=1)
    want = np.linalg.matrix_power(step, copies - 1)[4]
    assert np.allclose(got[-1], want, atol=1e-6) and got[-1][4] > 0.9


def test_loops_settle_and_documents_do_not_mix():
    """More rounds change nothing, and a document's beliefs don't depend on its batch."""
    dice, n = np.random.default_rng(6), len(pii.LABELS)
    agree = np.full((n, n), -1.0) + 2.5 * np.eye(n)
    model = pii.SkipChain(dice.normal(size=(pii.BUCKETS, n)) / 4, dice.normal(size=(n, n)) / 2, agree)
    texts = [" ".join(f"id-{k}{dice.integers(100, 104)}xyz" for k in (7, 8)) for _ in range(9)]
    graphs = [pii.graph_of(" ".join(texts[: k + 1]), []) for k in range(9)]
    together = np.split(model.beliefs(graphs), np.cumsum([len(g.spans) for g in graphs])[:-1])
    for graph, got in zip(graphs, together):
        assert np.allclose(got, model.beliefs([graph]), atol=1e-9)
        assert np.allclose(got, model.beliefs([graph], rounds=1000), atol=1e-3)


def test_message_passing_is_exact_on_a_chain():
    """On a graph without loops the beliefs are the true marginals."""
    dice, n = np.random.default_rng(4), len(pii.LABELS)
    text = "a1 b2 c3"
    graph = pii.graph_of(text, [])
    model = pii.SkipChain(dice.normal(size=(pii.BUCKETS, n)), dice.normal(size=(n, n)), np.zeros((n, n)))
    scores = model.weights[graph.features].sum(axis=1)
    joint = scores[0][:, None, None] + scores[1][None, :, None] + scores[2][None, None, :]
    joint = joint + model.chain[:, :, None] + model.chain[None, :, :]
    p = np.exp(joint - joint.max())
    p /= p.sum()
    want = [p.sum(axis=(1, 2)), p.sum(axis=(0, 2)), p.sum(axis=(0, 1))]
    assert np.allclose(model.beliefs([graph], rounds=60), want, atol=1e-6)


def test_nulls_empty_and_repeated_rows(spark, model):
    rows = [(1, None, 1, "", ""), (2, "", 1, "", ""), (3, "1" * 100_000, 1, "", "")]
    rows += [(None, "x@y.zz", 1, "", "")] * 2
    made = pii.find(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert sorted((r["row"]["doc_id"] or 0, r["n_email"]) for r in made) == [(0, 1), (0, 1), (1, 0), (2, 0), (3, 0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.find(empty, pii.fit(empty)).count() == 0


LETTERS = "abcdefghijkmnopqrstuvwxyz"


def test_assigned_values_and_their_copies_are_nodes_whatever_they_hold():
    for value in ("correcthorsebattery", "open;sesame(now)", "YWJjZGVm==", "=abcdefgh", "quietly!", "пароль-слово"):
        text = f'a password = "{value}" or so, {value}. then {value}, and ({value}) not x{value}x end'
        graph = pii.graph_of(text, [])
        places = [m.start() for m in re.finditer(re.escape(value), text)][:4]
        assert [a for a, _ in graph.spans] == places
        assert all(text[a:b].rstrip(".") == value for a, b in graph.spans)
        assert [b for _, b in graph.skip] == [1, 2, 3] or len(graph.skip + graph.chain) >= 3
        assert pii.training_label(text, graph).tolist() == [5] * 4
    assert not pii.graph_of('say = "correcthorsebattery" correcthorsebattery', []).spans


@pytest.mark.parametrize("token", ["1.2.3.4", "A-1-23", "x9"])
def test_short_tokens_are_joined_to_their_copies(token):
    text = " some words in between ".join([token, token + ".", token])
    assert pii.graph_of(text, []).skip == [(0, 1), (1, 2)]


def test_secrets_of_letters_are_found_with_their_copies(spark):
    dice = random.Random(5)
    value = lambda: "".join(dice.choices(LETTERS, k=dice.randint(10, 24)))
    rows = []
    for k in range(300):
        key, tail = value(), f" on day {k} of {1900 + k}" if k % 2 else ""
        rows.append((k, f"{prose(dice)} password = '{key}' {prose(dice)}{tail}, so {key}", 1, "", ""))
    model = pii.fit(spark.createDataFrame(rows, SCHEMA))
    key = value()
    text = f'{prose(dice)} password = "{key}" {prose(dice)} ' + f"use {key} {prose(dice)} " * 12
    got = found(spark, model, [(1, text, 1, "", ""), (2, prose(dice) + " " + key, 1, "", "")])
    want = [f"secret:{m.start()}:{m.end()}" for m in re.finditer(key, text)]
    assert got[1]["spans"].split(",") == want and len(want) == 13
    assert got[2]["spans"] == ""


def test_assigned_values_may_have_any_length(spark):
    rows = []
    for n in (200, 201, 5000):
        value = LETTERS * (n // len(LETTERS)) + LETTERS[: n % len(LETTERS)]
        text = f'a password = "{value}" and then again {value} once'
        graph = pii.graph_of(text, [])
        assert [b - a for a, b in graph.spans] == [n, n] and graph.skip == [(0, 1)]
        assert pii.training_label(text, graph).tolist() == [5, 5]
        rows.append((n, text, 1, "", ""))
    docs = spark.createDataFrame(rows, SCHEMA)
    assert docs.where(docs["text"].rlike(pii.NODE_IN_SPARK)).count() == 3


def test_the_sample_of_nodes_does_not_depend_on_partitions(spark):
    dice, rows = random.Random(12), []
    for k in range(120):
        rows.append((k, f'{prose(dice)} token = "{secret(dice)}" on day {k} of {1900 + k}', 1, "", ""))
    docs = spark.createDataFrame(rows, SCHEMA)
    one = pii.fit(docs.coalesce(1), sample_nodes=150)
    other = pii.fit(docs.repartition(5, "text"), sample_nodes=150)
    assert np.array_equal(one.weights, other.weights) and np.array_equal(one.skip, other.skip)


def test_small_loopy_graphs_come_near_enumeration():
    """On graphs with loops the beliefs are near the true marginals and agree on the label."""
    dice, n = np.random.default_rng(8), 3
    seen = 0
    for _ in range(60):
        size = int(dice.integers(3, 6))
        pairs = [(a, b) for b in range(size) for a in range(b)]
        some = [pairs[k] for k in dice.choice(len(pairs), min(len(pairs), size + 1), replace=False)]
        chain = [p for p in some if p[1] - p[0] == 1]
        skip = [p for p in some if p[1] - p[0] > 1]
        labels = len(pii.LABELS)
        weights = np.full((pii.BUCKETS, labels), -50.0)
        weights[:size, :n] = dice.normal(size=(size, n)) * 1.5
        features = np.full((size, pii.FEATURES), size)
        features[:, 0] = np.arange(size)
        weights[size] = 0.0
        weights[size, n:] = -50.0
        graph = pii.Graph([(k, k + 1) for k in range(size)], features, np.zeros(size, np.int64), chain, skip)
        table = lambda: np.pad(dice.normal(size=(n, n)) * 0.4, (0, labels - n))
        model = pii.SkipChain(weights, table(), table() + np.eye(labels))
        got, residual = model.passed([graph])
        assert residual[0] <= pii.CLOSE
        scores = weights[features].sum(axis=1)[:, :n]
        truth = np.zeros((size, n))
        for point in np.ndindex(*[n] * size):
            total = sum(scores[k, v] for k, v in enumerate(point))
            total += sum(model.chain[point[a], point[b]] for a, b in chain)
            total += sum(model.skip[point[a], point[b]] for a, b in skip)
            for k, v in enumerate(point):
                truth[k, v] += np.exp(total)
        truth /= truth.sum(axis=1, keepdims=True)
        assert np.abs(got[:, :n] - truth).max() < 0.15
        sure = truth.max(axis=1) > 0.7
        assert (got[sure].argmax(axis=1) == truth[sure].argmax(axis=1)).all()
        seen += int(sure.sum())
    assert seen > 50


def test_planted_secrets_of_the_given_documents_are_found(spark):
    """Recall of quoted tokens, and of their bare copies, on a given table: at least 0.9."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = pii.find(docs, pii.fit(docs)).select("row.text", "spans").collect()
    planted = caught = marked = 0
    for row in made:
        spans = {x for x in row["spans"].split(",") if x.startswith("secret:")}
        marked += len(spans)
        values = {m[1] for m in re.finditer(r'(?i)token = "([^"\s]{8,})"', row["text"] or "")}
        for value in values:
            for m in re.finditer(re.escape(value), row["text"]):
                planted += 1
                caught += f"secret:{m.start()}:{m.end()}" in spans
    assert planted > 10 and caught >= 0.9 * planted and marked <= 1.1 * planted
