"""Quality rules: base counts of every text, and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed n-grams: trusted documents (a bounded sample of
those labelled good) and the raw corpus (every document). A document's score is the sum of the
log ratios of its n-grams divided by their number. One threshold, fitted on the labelled sample
and the same for all documents, gives the verdict.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from kinmart.llm.files import giving_back, rows_of

#: Tokens of the n-grams: runs of letters and digits, runs of other signs.
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+")
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)


def hashes(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))


def n_gram_buckets(text: str, bits: int) -> np.ndarray:
    """Bucket of every token and of every pair of neighbours."""
    one = hashes(TOKEN.findall(text.encode()))
    two = one[:-1] * MIX[0] + one[1:] * MIX[1]
    return (np.concatenate([one * MIX[1], two]) >> np.uint64(64 - bits)).astype(np.int64)


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words inside windows that occur at least twice in the text, the first one included.

    Windows are told apart by 64-bit hashes of random word hashes.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = hashes(words)
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = mixed * MIX[0] + h[k : k + n]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0
    often = np.zeros(n, bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += often
    edges[window : window + n] -= often
    return int((np.cumsum(edges[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


@dataclass(frozen=True)
class QualityModel:
    """Log ratio of each bucket and the least score of a document that stays."""

    ratios: np.ndarray
    threshold: float

    @property
    def bits(self) -> int:
        return int(len(self.ratios)).bit_length() - 1

    def score(self, text: str) -> float:
        """Mean log ratio of the n-grams; 0 for a text without any."""
        buckets = n_gram_buckets(text, self.bits)
        return float(self.ratios[buckets].sum() / len(buckets)) if len(buckets) else 0.0


def log_ratios(trusted: np.ndarray, raw: np.ndarray, smoothing: float) -> np.ndarray:
    """Log of the smoothed share of each bucket in the trusted text over that in the raw text."""
    share = lambda x: (x + smoothing) / (x.sum() + smoothing * len(x))
    return np.log(share(trusted.astype(float))) - np.log(share(raw.astype(float)))


def threshold_for(good: np.ndarray, bad: np.ndarray, cost: float) -> float:
    """The score that separates best, losing a good document weighing ``cost`` bad ones kept.

    Of equal choices the middle of the lowest stretch counts. Without bad rows nothing is
    rejected by score.
    """
    if not len(good) or not len(bad):
        return float("-inf")
    cuts = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
    lost = np.searchsorted(np.sort(good), cuts) * cost
    kept = len(bad) - np.searchsorted(np.sort(bad), cuts)
    total = lost + kept
    return float(cuts[int(np.argmin(total))])


def labelled_sample(labels: DataFrame, quality: int, bound: int, doc_id: str, label: str):
    """At most ``bound`` ids of labelled rows, those with the smallest hash, as an array."""
    key = F.col(doc_id).cast("long")
    rows = (
        labels.where((F.col(label) == quality) & key.isNotNull())
        .select(key.alias("doc_id"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"))
        .limit(bound)
    )
    return np.sort(np.array([row[0] for row in rows.collect()], dtype=np.int64))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    bits: int = 16,
    bound: int = 20_000,
    smoothing: float = 1.0,
    cost: float = 10.0,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> QualityModel:
    """Fit on the raw counts of all ``docs`` and a bounded sample of labelled rows.

    At most ``bound`` good and ``bound`` bad ids are drawn, by hash, from ``labels`` (null
    labels or ids count as unlabelled). Every second good id makes the trusted multinomial, the
    others and the bad ones set the threshold. The raw multinomial covers every document. What reaches
    the driver is 2 ** ``bits`` counts and one score for each sampled row, whatever the size of
    the corpus. Without labels the model keeps everything that passes the base rules.
    """
    good = labelled_sample(labels, 1, bound, doc_id, label)
    counted, measured = good[::2], good[1::2]
    bad = labelled_sample(labels, 0, bound, doc_id, label)
    size = 1 << bits
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, trusted = np.zeros(size, np.int64), np.zeros(size, np.int64)
        held: list[tuple[np.ndarray, bool]] = []

        def add() -> None:
            for table, which in ((raw, held), (trusted, [x for x in held if x[1]])):
                if which:
                    table += np.bincount(np.concatenate([x[0] for x in which]), minlength=size)
            held.clear()

        for batch in batches:
            sampled = np.isin(batch.column("doc_id").to_numpy(zero_copy_only=False), counted)
            for row, is_good in zip(rows_of(batch), sampled):
                held.append((n_gram_buckets(row["text"] or "", bits), is_good))
                if sum(len(x[0]) for x in held[-64:]) > size or len(held) >= 64:
                    add()
        add()
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (used, raw[used], trusted[used])],
            names=["bucket", "raw", "trusted"],
        )

    counts = rows.mapInArrow(count, "bucket long, raw long, trusted long")
    summed = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("t"))
    table = np.zeros((2, size), np.int64)
    for row in summed.collect():
        table[:, row["bucket"]] = row["raw"], row["t"]
    ratios = log_ratios(table[1], table[0], smoothing)
    model = QualityModel(ratios, float("-inf"))
    if not len(measured) or not len(bad):
        return model
    spark = docs.sparkSession
    chosen = [(int(x), True) for x in measured] + [(int(x), False) for x in bad]
    sample = F.broadcast(spark.createDataFrame(chosen, "doc_id long, good boolean"))

    @giving_back
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(row["text"] or "") for row in rows_of(batch.select(["text"]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("good"), pa.array(found, pa.float64())], names=["good", "score"]
            )

    scored = rows.join(sample, "doc_id").select("text", "good")
    held = scored.mapInArrow(scores, "good boolean, score double").collect()
    parts = [np.array([r["score"] for r in held if r["good"] is is_good]) for is_good in (True, False)]
    return QualityModel(ratios, threshold_for(*parts, cost))


def judge(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Every document with its counts, score and verdict: (row, n_words, ..., kept).

    ``row`` holds the columns of ``docs`` as they came, so no name can clash. A null text has no
    words. A document stays if it passes the base rules (at least 10 words, at most a fifth of
    them in repeated windows) and its score is not below the threshold.
    """
    names = [x.split()[0] for x in VERDICT.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    whole = docs.select(
        F.col(text).cast("string").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
    )

    @giving_back
    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in rows_of(batch.select(["text"])):
                value = row["text"] or ""
                counts = base_counts(value)
                failed = base_failed(counts[0], counts[4])
                score = model.score(value)
                out.append((*counts, failed, score, not failed and score >= model.threshold))
            columns = zip(*out) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(x, k) for x, k in zip(columns, kinds))],
                names=["row", *names],
            )

    schema = whole.select("row").schema
    for part in VERDICT.split(", "):
        schema = schema.add(*part.split())
    return whole.mapInArrow(rate, schema)
