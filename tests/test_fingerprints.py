import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinmart import Settings
from kinmart.functions.features import ngrams, qgrams, tokens
from kinmart.operators.fingerprints import (
    custom_fingerprints,
    from_packed_bytes,
    in_range,
    library_summary,
    publish_library,
    shard_count,
    shard_plan,
    text_fingerprints,
    text_rejects,
    to_packed_bytes,
    vector_fingerprints,
    wrong_width,
)
from kinmart.operators.similarity import search
from kinmart.workspace import new_dir, stage

TEXTS = {
    "a": "one two  three\tfour\n one two",
    "b": "  één woord ",
    "c": "x",
    "d": None,
    "e": " \t\n",
    "f": "",
    "g": "word " * 3000 + "last",
}


def items(spark, texts=TEXTS):
    return spark.createDataFrame(list(texts.items()), "id string, text string")


def bit(feature, n_bits):
    return int(hashlib.md5(feature.encode()).hexdigest()[:8], 16) % n_bits


def feature_set(text, kind, radius):
    words = text.split()
    if kind == "tokens":
        return set(words)
    if kind == "ngrams":
        return {
            " ".join(words[i : i + n])
            for n in range(1, radius + 2)
            for i in range(len(words) - n + 1)
        }
    text, q = text.strip(), radius + 2
    return {text[i : i + q] for i in range(len(text) - q + 1)} if len(text) >= q else {text}


def bits_of(words):
    return {64 * w + b for w, word in enumerate(words) for b in range(64) if word >> b & 1}


@pytest.mark.parametrize("kind", ["tokens", "ngrams", "qgrams"])
@pytest.mark.parametrize("n_bits", [2048, 72])
def test_bits_match_a_plain_reading_of_the_whole_text(spark, kind, n_bits):
    settings = Settings(n_bits=n_bits)
    made = {
        row.item_id: row
        for row in text_fingerprints(items(spark), "id", "text", settings, kind).collect()
    }
    usable = {key: text for key, text in TEXTS.items() if text and text.strip()}
    assert set(made) == set(usable)
    for key, text in usable.items():
        want = {bit(feature, n_bits) for feature in feature_set(text, kind, 2)}
        assert bits_of(made[key].fp) == want
        assert made[key].pc == len(want) and len(made[key].fp) == settings.n_words


def test_words_match_the_grouped_form(spark, rows):
    """bit_or over exploded features gives the same words as packing inside tasks."""
    settings = Settings(n_bits=256)
    given = items(spark).where("trim(text) <> ''").where("id <> 'e'")
    exploded = given.select("id", F.explode(ngrams(F.col("text"), 2)).alias("f")).select(
        "id", (F.conv(F.substring(F.md5("f"), 1, 8), 16, 10).cast("bigint") % 256).alias("bit")
    )
    grouped = exploded.groupBy("id").agg(
        F.array(
            *[
                F.coalesce(
                    F.expr(f"bit_or(CASE WHEN bit div 64 = {w} THEN shiftleft(1L, int(bit % 64)) END)"),
                    F.lit(0),
                )
                for w in range(4)
            ]
        ).alias("fp")
    )
    made = text_fingerprints(items(spark), "id", "text", settings).select("item_id", "fp")
    assert rows(made) == rows(grouped)


def test_radius_zero_is_words_only(spark):
    row = items(spark, {"a": "p q p"}).select(ngrams(F.col("text"), 0), tokens(F.col("text"))).first()
    assert row[0] == row[1] == ["p", "q", "p"]


def test_short_text_is_its_own_qgram(spark):
    row = items(spark, {"a": " ab "}).select(qgrams(F.col("text"), 4)).first()
    assert row[0] == ["ab"]


def test_rejects_have_reasons(spark, rows):
    made = rows(text_rejects(items(spark), "id", "text"))
    assert made == [
        ("d", "structure is missing"), ("e", "structure is blank"), ("f", "structure is blank")
    ]


def test_vectors_set_a_bit_per_positive_element(spark):
    frame = spark.createDataFrame(
        [("a", [0.5, -1.0, 0.0, 2.0]), ("b", [-1.0] * 4), ("c", None)], "id string, v array<double>"
    )
    made = {r.item_id: (bits_of(r.fp), r.pc) for r in vector_fingerprints(frame, "id", "v", 4).collect()}
    assert made == {"a": ({0, 3}, 2), "b": (set(), 0)}


def test_packed_bytes_have_the_first_bit_highest_and_round_trip(spark, rows):
    packed = spark.createDataFrame(
        [("a", bytearray([0b11110000, 0b00000001])), ("b", bytearray(2))],
        "item_id string, fingerprint binary",
    )
    library = from_packed_bytes(packed, 16)
    made = {row.item_id: bits_of(row.fp) for row in library.collect()}
    assert made == {"a": {0, 1, 2, 3, 15}, "b": set()}
    back = {r.item_id: bytes(r.fingerprint) for r in to_packed_bytes(library, 16).collect()}
    assert back == {"a": bytes([0b11110000, 1]), "b": bytes(2)}


def test_packed_bytes_of_another_width_are_refused(spark):
    packed = spark.createDataFrame([("a", bytearray(2))], "item_id string, fingerprint binary")
    with pytest.raises(Exception, match="expected 256 fingerprint bytes, found"):
        from_packed_bytes(packed, 2048).collect()


def test_width_check_counts_bits_and_words(spark):
    library = spark.createDataFrame(
        [("ok", [3, 0], 2), ("narrow", [3], 2), ("miscounted", [3, 0], 5), ("none", None, 0)],
        "item_id string, fp array<bigint>, pc int",
    )
    assert {r[0] for r in wrong_width(library, 128).collect()} == {"narrow", "miscounted", "none"}


def test_a_callers_toolkit_may_refuse_items(spark, rows):
    def maker(batches):
        for batch in batches:
            texts = batch.column("structure").to_pylist()
            made = [bytes([len(t)]) if t and t.isalpha() else None for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(made, pa.binary())], ["item_id", "fingerprint"]
            )

    library, rejects = custom_fingerprints(
        items(spark, {"a": "xyz", "b": "!!", "c": None}), "id", "text", maker, 8
    )
    assert [(r.item_id, bits_of(r.fp)) for r in library.collect()] == [("a", {6, 7})]
    assert rows(rejects) == [("b", "structure is unusable"), ("c", "structure is unusable")]


@pytest.mark.parametrize("size", [1, 7, 250, 2000])
def test_shard_plan_is_exact(spark, size):
    ids = [f"K{n:05d}" for n in np.random.default_rng(1).permutation(1003)]
    frame = spark.createDataFrame([(i,) for i in ids], "id string").repartition(5)
    made = shard_plan(frame, "id", size, partitions=6).orderBy("shard").collect()
    starts = sorted(ids)[::size]
    assert [r.first_id for r in made] == starts
    assert [r.next_id for r in made] == [*starts[1:], None]
    assert [r.shard for r in made] == list(range(shard_count(1003, size)))


def test_shard_count_rounds_up():
    assert (shard_count(250_000, 250_000), shard_count(250_001, 250_000), shard_count(0, 5)) == (1, 2, 0)


def test_library_is_published_in_key_ranges_that_prune(spark, rows):
    texts = {f"K{n:04d}": f"word{n} shared" for n in range(600)}
    path = new_dir(spark, "library")
    settings = Settings(shard_size=100)
    made = text_fingerprints(items(spark, texts), "id", "text", settings)
    assert publish_library(made, path, settings) == 600
    library = spark.read.parquet(path)
    part = library.where(in_range(F.col("item_id"), "K0100", "K0150"))
    assert part.count() == 50
    assert "GreaterThanOrEqual(item_id,K0100)" in part._jdf.queryExecution().executedPlan().toString()
    assert library.where(in_range(F.col("item_id"), "K0590", None)).count() == 10
    files = library.groupBy("shard", F.input_file_name()).agg(
        F.count("*"), F.min("item_id"), F.max("item_id")
    )
    found = sorted((r[0], r[2], r[3], r[4]) for r in files.collect())
    plan = shard_plan(made, "item_id", 100, partitions=3).orderBy("shard").collect()
    assert [(r[0], r[2]) for r in found] == [(p.shard, p.first_id) for p in plan]
    assert [r[1] for r in found] == [100] * 6 and found[-1][3] == "K0599"


def test_an_empty_library_can_be_published(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    assert publish_library(text_fingerprints(items(spark).limit(0), "id", "text"), path) == 0
    assert spark.read.parquet(path).count() == 0


def test_the_second_hash_family_ranks_alike(spark):
    """Bits differ, what is near does not: of 40 texts each finds the same nearest ones."""
    dice = random.Random(3)
    words = [f"w{n}" for n in range(400)]
    base = [" ".join(dice.choices(words, k=60)) for _ in range(8)]
    texts = {f"{n}": " ".join(w if dice.random() > 0.02 * (n // 8) else "x" for w in base[n % 8].split()) for n in range(40)}
    tops = []
    for hashing in ("md5", "xxhash64"):
        settings = Settings(n_bits=8192, top_n=4, hashing=hashing)
        library = stage(text_fingerprints(items(spark, texts), "id", "text", settings), "hashed")
        found = search(library, library.select(F.col("item_id").alias("source_id")), settings)
        tops.append({s: {r.target_id for r in found.collect() if r.source_id == s} for s in texts})
    assert tops[0] == tops[1]
    with pytest.raises(ValueError, match="hashing"):
        Settings(hashing="crc")


def test_summary_totals(spark):
    settings = Settings(n_bits=64, shard_size=2)
    library = text_fingerprints(items(spark), "id", "text", settings)
    rejects = text_rejects(items(spark), "id", "text")
    row = library_summary(library, rejects, settings).first()
    assert tuple(row) == (2, 4, 3, 32)
