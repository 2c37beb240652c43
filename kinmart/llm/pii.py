"""Personal data: fixed patterns, and a skip-chain conditional random field that adds to them.

The field's nodes are the tokens of a document that hold a digit or an at sign, the quoted values
of assignments to telling names, and all copies of such values in the document; other tokens
are never personal data here. Neighbouring nodes are joined by chain edges, and each node to the
last one of the same or similar characters by a skip edge, however far back it is, so a token
repeated many times costs one edge each time. Loopy message passing then makes the labels of
repeated tokens agree: what the context gives away in one place is found in the others.

Weights are fitted piecewise on a bounded sample: a softmax over hashed features for the nodes,
smoothed log ratios of label pairs for the two kinds of edge. The labels to learn from are the
pattern spans, and for secrets the quoted value of an assignment to a telling name.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from kinmart.llm.files import rows_of
from kinmart.workspace import stage

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
LABELS = ("", *KINDS)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(
    r"(?i)(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s{0,8}[=:]\s{0,8}[\"']"
    r"([^\"'\s]{8,})[\"']"
)
#: What every match of ``SECRET`` holds, quick to look for.
ASSIGNED = re.compile(r"[=:]\s{0,8}[\"']")
#: ``SECRET`` and ``MARKED`` for Spark, where white space is that of Python.
NODE_IN_SPARK = (
    r"[0-9@]|(?iU)(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)"
    r"[\s\x1c-\x1f]{0,8}[=:][\s\x1c-\x1f]{0,8}[\"'][^\"'\s\x1c-\x1f]{8,}[\"']"
)
WORD = re.compile(r"[^\s\"'(),;<>=|]+")
MARKED = re.compile(r"[0-9@]")
LOOSE_ENDS = ".,:;!?#*$%&-"
FEATURES = 12
#: Pairs of equal labels that skip edges start from: copies of a token agree unless shown not to.
PRIOR_AGREEING = 10.0
#: Messages have settled when none changes by more than this. From this round on they are damped.
CLOSE, STEADY = 1e-4, 20
BUCKETS = 1 << 14
#: Nodes whose messages are passed together; documents are kept whole.
NODES_AT_ONCE = 20_000
Span = tuple[int, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern, in time linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        found = DOMAIN.match(text, at + 1)
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if found and start < at:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        value = int(c) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of all pattern matches that pass their test, by kind, then start."""
    found = [(0, a, b) for a, b in emails(text)]
    if not MARKED.search(text):
        return found
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in CARD.finditer(text):
        number = digits(m[0])
        if 16 <= len(number) <= 19 and luhn(number):
            found.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(digits(m[0])) <= 15:
            found.append((3, *m.span()))
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def shape(token: str) -> str:
    """Classes of characters in order, runs cut to lengths 1, 2, 3-5, 6-15 and more."""
    classes = re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"[0-9]", "0", token[:256])))
    size = lambda n: n if n < 3 else 3 if n < 6 else 6 if n < 16 else 16
    return re.sub(r"(.)\1*", lambda m: m[1] + str(size(len(m[0]))), classes)


def assigned(text: str) -> list[tuple[int, int]]:
    """Spans of the quoted values of assignments to telling names."""
    return [m.span(1) for m in SECRET.finditer(text)] if ASSIGNED.search(text) else []


def core(token: str) -> str:
    return token.strip(LOOSE_ENDS) or token


def tokens_of(text: str, held: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of the words of a text, where assigned values and their copies are one word each."""
    words = [(m.start(), m.end()) for m in WORD.finditer(text)]
    if not held:
        return words
    # By their first word, the values that are not a word as they stand: where they start, lengths.
    broken: dict[str, set[tuple[int, int]]] = {}
    values = {text[a:b] for a, b in held}
    for value in values:
        first = WORD.search(value)
        if first and first[0] != value:
            broken.setdefault(core(first[0]), set()).add((first.start(), len(value)))
    found = list(held)
    for a, b in words if broken else ():
        lead = a + text[a:b].find(core(text[a:b]))
        for offset, length in broken.get(core(text[a:b]), ()):
            for start in {a - offset, lead - offset}:
                end = start + length
                if start >= 0 and text[start:end] in values and not text[end : end + 1].isalnum():
                    found.append((start, end))
    found.sort(key=lambda x: (x[0], -x[1]))
    out, done, k = [], 0, 0
    for a, b in found:
        if a < done:
            continue
        while k < len(words) and words[k][0] < a:
            if words[k][0] >= done:
                out.append((words[k][0], min(words[k][1], a)))
            k += 1
        out.append((a, b))
        done = b
    return out + [x for x in words[k:] if x[0] >= done]


@dataclass
class Graph:
    """Nodes and edges of one document. ``given`` is the pattern's label, 0 for none.

    ``values`` are the quoted values of assignments to telling names.
    """

    spans: list[tuple[int, int]]
    features: np.ndarray
    given: np.ndarray
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    values: frozenset[str] = frozenset()


def graph_of(text: str, base: list[Span]) -> Graph:
    held = assigned(text)
    words = tokens_of(text, held)
    values = frozenset(text[a:b] for a, b in held)
    cores = {core(x) for x in values}
    nodes = [
        k
        for k, (a, b) in enumerate(words)
        if MARKED.search(text, a, b) or cores and core(text[a:b]) in cores
    ]
    by_start = sorted((a, b, kind) for kind, a, b in base)
    reach, furthest = [], 0
    for _, b, _ in by_start:
        furthest = max(furthest, b)
        reach.append(furthest)
    spans, rows, given, chain, skip = [], [], [], [], []
    seen: dict[str, int] = {}
    for at, k in enumerate(nodes):
        start, end = words[k]
        token = text[start:end]
        low = token.lower()
        before = text[words[k - 1][0] : words[k - 1][1]].lower()[-20:] if k else "^"
        earlier = text[words[k - 2][0] : words[k - 2][1]].lower()[-20:] if k > 1 else "^"
        gap = text[words[k - 1][1] : start].strip()[-3:] if k else ""
        after = text[end : end + 2].strip()[:1]
        n = len(digits(token))
        kinds = (set("0123456789abcdef") >= set(low.strip(LOOSE_ENDS)), "@" in token, "." in token)
        parts = (
            "s" + shape(token),
            "t" + shape(token.strip(LOOSE_ENDS)),
            f"n{min(n, 24)}",
            f"l{min(len(token), 48)}",
            f"k{kinds}{n * 4 // max(1, len(token))}",
            f"k{kinds}{min(len(token), 48) // 4}",
            "b" + before,
            "c" + earlier + "/" + before,
            "g" + gap,
            "g" + gap + "/" + before,
            "h" + token[:1] + after,
            "bias",
        )
        rows.append([xxhash.xxh32_intdigest(x) % BUCKETS for x in parts])
        label = 0
        place = bisect_left(by_start, (end,))
        while place > 0 and reach[place - 1] > start:
            place -= 1
            if by_start[place][1] > start:
                label = 1 + by_start[place][2]
                break
        given.append(label)
        spans.append((start, end))
        if at and k - nodes[at - 1] <= 2:
            chain.append((at - 1, at))
        same = re.sub(r"[^0-9a-z@]", "", low)
        keys = ("=" + same, "~" + same[-8:]) if len(same) >= 6 else ("=" + core(low),)
        for key in keys:
            if key in seen and (seen[key], at) not in (chain[-1:] + skip[-1:]):
                skip.append((seen[key], at))
            seen[key] = at
    return Graph(
        spans,
        np.array(rows, np.int64).reshape(-1, FEATURES),
        np.array(given, np.int64),
        chain,
        skip,
        values,
    )


def depths(graph: Graph) -> list[int]:
    """The most edges on a way that comes from earlier nodes to each node."""
    out = [0] * len(graph.spans)
    for a, b in sorted([*graph.chain, *graph.skip], key=lambda e: e[1]):
        out[b] = max(out[b], out[a] + 1)
    return out


@dataclass(frozen=True)
class SkipChain:
    """Node weights by feature bucket and label, log potentials of chain and skip edges."""

    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    sure: float = 0.9

    def beliefs(self, graphs: list[Graph], rounds: int = 200) -> np.ndarray:
        """Label probabilities of all nodes of some documents."""
        return self.passed(graphs, rounds)[0]

    def passed(self, graphs: list[Graph], rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
        """(beliefs, residual) by loopy message passing.

        ``residual`` is for each document by how much a message still changed in its last round:
        at most ``CLOSE``, unless its loops have kept it from settling in ``rounds``.

        A round passes messages forward through each document and back, so evidence crosses any
        number of copies in one. A document is done when no message has changed by ``CLOSE``;
        from round ``STEADY`` on messages are damped, as loops may keep them from settling.
        """
        first = np.cumsum([0] + [len(g.spans) for g in graphs])
        scores = np.concatenate([self.weights[g.features].sum(axis=1) for g in graphs])
        given = np.concatenate([g.given for g in graphs])
        scores[np.flatnonzero(given), given[given > 0]] += 20.0
        rows = [
            (base + a, base + b, kind, doc)
            for doc, (base, g) in enumerate(zip(first.tolist(), graphs))
            for kind, ends in ((0, g.chain), (1, g.skip))
            for a, b in ends
        ]
        edges = np.array(rows, np.int64).reshape(-1, 4)
        depth = np.array([d for g in graphs for d in depths(g)], np.int64)
        pair = np.stack([self.chain, self.skip])[edges[:, 2]]
        sent = np.zeros((2, len(edges), len(LABELS)))
        ways = ((0, 1, pair), (1, 0, pair.transpose(0, 2, 1)))
        going, residual = np.arange(len(edges)), np.zeros(len(graphs))
        for turn in range(rounds):
            if not len(going):
                break
            keep = 0.5 if turn >= STEADY else 0.0
            change = np.zeros(len(graphs))
            for way, (source, target, pairs) in enumerate(ways):
                at = depth[edges[going, source]] * (1 - 2 * way)
                order = going[np.argsort(at, kind="stable")]
                cuts = np.flatnonzero(np.diff(np.sort(at))) + 1
                for now in np.split(order, cuts):
                    out = (scores[edges[now, source]] - sent[1 - way, now])[:, :, None] + pairs[now]
                    top = out.max(axis=1)
                    new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
                    new -= new.max(axis=1, keepdims=True)
                    step = (1.0 - keep) * (new - sent[way, now])
                    sent[way, now] += step
                    np.add.at(scores, edges[now, target], step)
                    np.maximum.at(change, edges[now, 3], np.abs(step).max(axis=1))
            own = np.unique(edges[going, 3])
            residual[own] = change[own]
            going = going[change[edges[going, 3]] > CLOSE]
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True), residual

    def added(self, text: str, graph: Graph, beliefs: np.ndarray, base: list[Span]) -> list[Span]:
        """Spans of nodes labelled with confidence and outside all pattern spans."""
        labels = np.where(beliefs.max(axis=1) >= self.sure, beliefs.argmax(axis=1), 0)
        taken = sorted((a, b) for _, a, b in base)
        spans: list[list[int]] = []
        for (start, end), label, given in zip(graph.spans, labels.tolist(), graph.given.tolist()):
            if not label or given:
                continue
            token = text[start:end]
            if token not in graph.values:
                end = start + len(token.rstrip(LOOSE_ENDS))
            if end <= start:
                continue
            last = spans[-1] if spans else None
            if last and last[0] == label - 1 and not text[last[2] : start].strip(" ().-"):
                place = bisect_left(taken, (last[2],))
                if place == len(taken) or taken[place][0] >= start:
                    last[2] = end
                    continue
            spans.append([label - 1, start, end])
        return [tuple(x) for x in spans]


def training_label(text: str, graph: Graph) -> np.ndarray:
    """Pattern labels, and secrets: quoted values of telling names, wherever they recur."""
    secret = {core(x) for x in graph.values}
    labels = graph.given.copy()
    for k, (start, end) in enumerate(graph.spans):
        if not labels[k] and core(text[start:end]) in secret:
            labels[k] = len(LABELS) - 1
    return labels


def fit(
    docs: DataFrame,
    sample_docs: int = 2_000,
    sample_nodes: int = 100_000,
    doc_id: str = "doc_id",
    text: str = "text",
) -> SkipChain:
    """Fit on at most ``sample_docs`` documents (those of least hashed id that have a node) and
    ``sample_nodes`` of their nodes, those of least hash; only hashed features and labels of
    these reach the driver. The same rows give the same field however they are partitioned.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marked = rows.where(F.col("text").rlike(NODE_IN_SPARK))
    ids = marked.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = [r[0] for r in ids.limit(sample_docs).collect() if r[0] is not None]
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(x,) for x in chosen], "doc_id long"))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in rows_of(batch):
                graph = graph_of(row["text"], base_spans(row["text"]))
                labels = training_label(row["text"], graph).tolist()
                last = {b: (a, k) for k, e in ((0, graph.chain), (1, graph.skip)) for a, b in e}
                for k, label in enumerate(labels):
                    a, kind = last.get(k, (0, -1))
                    before = labels[a] if kind >= 0 else -1
                    token = row["text"][slice(*graph.spans[k])]
                    draw = xxhash.xxh32_intdigest(f"{row['doc_id']}:{k}:{token}")
                    out.append((graph.features[k].tolist(), label, kind, before, draw))
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds)],
                names=["features", "label", "edge", "before", "draw"],
            )

    schema = "features array<int>, label int, edge int, before int, draw long"
    held = stage(marked.join(wanted, "doc_id").mapInArrow(nodes, schema), "pii-nodes")
    # Of very many nodes a share a little above the bound is fetched, then cut to it.
    share = 1.05 * sample_nodes / max(1, held.count())
    held = held.where(F.col("draw") < int(min(1.0, share) * (1 << 32))).toPandas()
    order = ["draw", "label", "edge", "before"]
    held = held.sort_values(order, kind="stable").head(sample_nodes).reset_index(drop=True)
    n = len(LABELS)
    if not len(held):
        weights = np.zeros((BUCKETS, n))
        weights[:, 0] = 1.0
        return SkipChain(weights, np.zeros((n, n)), np.zeros((n, n)))
    features = np.array(held["features"].tolist(), np.int64)
    labels = held["label"].to_numpy()
    pots = []
    for kind in (0, 1):
        some = held[held["edge"] == kind]
        counts = np.full((n, n), 0.5) + kind * PRIOR_AGREEING * np.eye(n)
        np.add.at(counts, (some["before"].to_numpy(), some["label"].to_numpy()), 1.0)
        counts = counts + counts.T
        share = counts / counts.sum()
        side = share.sum(axis=1)
        pots.append(np.clip(np.log(share) - np.log(side)[:, None] - np.log(side)[None, :], -4, 4))
    return SkipChain(softmax_weights(features, labels), *pots)


def softmax_weights(features: np.ndarray, labels: np.ndarray, epochs: int = 12) -> np.ndarray:
    """Adagrad over the hashed features, rows in a fixed random order."""
    n, weights = len(LABELS), np.zeros((BUCKETS, len(LABELS)))
    squares = np.full_like(weights, 1e-6)
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // 512)):
            scores = weights[features[rows]].sum(axis=1)
            shares = np.exp(scores - scores.max(axis=1, keepdims=True))
            shares /= shares.sum(axis=1, keepdims=True)
            shares[np.arange(len(rows)), labels[rows]] -= 1.0
            flat = features[rows].ravel()
            used, place = np.unique(flat, return_inverse=True)
            step = np.stack(
                [
                    np.bincount(place, np.repeat(shares[:, k], FEATURES), len(used))
                    for k in range(n)
                ],
                axis=1,
            ) / len(rows) + 1e-5 * weights[used]
            squares[used] += step**2
            weights[used] -= 0.3 * step / np.sqrt(squares[used])
    return weights


def find(docs: DataFrame, model: SkipChain, text: str = "text") -> DataFrame:
    """(row, n_email, n_ip, n_card, n_phone, base_sha256, spans, residual) of every document.

    ``row`` holds the columns of ``docs`` as they came. Spans are ``kind:start:end`` in code
    points, end exclusive, by kind and start, joined by commas: those of the patterns, which
    always stay, and those the field adds outside them. A null or empty text has none. Counts
    and ``base_sha256`` are of the pattern spans alone. ``residual`` tells how far the field's
    messages were from settled: 0 without nodes, above ``CLOSE`` where they never did.
    """
    whole = docs.select(
        F.col(text).cast("string").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
    )
    names = [*(f"n_{kind}" for kind in BASE), "base_sha256", "spans", "residual"]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                yield label_some(batch.slice(low, 256))

    def label_some(batch: pa.RecordBatch) -> pa.RecordBatch:
        bases, spans, residual = [], [], np.zeros(batch.num_rows)
        held: list[tuple[int, str, Graph]] = []

        def pass_messages() -> None:
            beliefs, left = model.passed([graph for _, _, graph in held])
            at = 0
            for (k, text, graph), change in zip(held, left):
                own = beliefs[at : at + len(graph.spans)]
                at += len(graph.spans)
                spans[k] = sorted([*bases[k], *model.added(text, graph, own, bases[k])])
                residual[k] = change
            held.clear()

        for k, row in enumerate(rows_of(batch.select(["text"]))):
            value = row["text"] or ""
            bases.append(base_spans(value))
            spans.append(bases[k])
            if MARKED.search(value) or assigned(value):
                held.append((k, value, graph_of(value, bases[k])))
                if sum(len(graph.spans) for _, _, graph in held) > NODES_AT_ONCE:
                    pass_messages()
        if held:
            pass_messages()
        counts = [
            pa.array([sum(x[0] == kind for x in b) for b in bases], pa.int64())
            for kind in range(len(BASE))
        ]
        sums = [hashlib.sha256(written(b).encode()).hexdigest() for b in bases]
        columns = [pa.array(sums, pa.string()), pa.array([written(x) for x in spans], pa.string())]
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), *counts, *columns, pa.array(residual)], names=["row", *names]
        )

    schema = whole.select("row").schema
    for name in names:
        kind = "long" if name.startswith("n_") else "double" if name == "residual" else "string"
        schema = schema.add(name, kind)
    return whole.mapInArrow(label, schema)
