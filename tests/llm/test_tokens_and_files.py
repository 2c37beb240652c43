"""Tokens, token files, packing: exact round trips and comparison with plain encoding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st

from kinmart.llm import files, packing
from kinmart.llm.token_files import (
    TokenReader,
    TokenWriter,
    bits_for,
    pack,
    read_digests,
    unpack,
    write_token_files,
)
from kinmart.llm.tokens import Encoder, blocks_of, encoder

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, source string, start string, queue int"
ROWS = [
    (3, "One two  three.\n\nFour", "a", "x", 1),
    (1, None, None, "x", 2),
    (2, "", "a", None, 3),
    (None, "no id", "b", "x", 4),
    (5, "word " * 3000, "b", "x", 5),
    (4, "Tab\there <|endoftext|> ünï é", "a", "x", 6),
    (4, "Same id, other text", "a", "x", 7),
    (6, "same row", "c", "x", 8),
    (6, "same row", "c", "x", 8),
]


def plain(path, text):
    return encoder(path).tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_units_give_the_ids_of_the_whole_text(path):
    signs = ["a", "B", "É", "Σ", "İ", " ", "\n", "  ", "\t", ".", "'s", "12", "<|endoftext|>"]
    signs += ["́", " ", "ſ", "\x1c", "ª", "½", "_", "\r\n", "🙂"]
    dice = random.Random(5)
    texts = ["".join(dice.choices(signs, k=dice.randint(0, 14))) for _ in range(4000)]
    for text in texts:
        ids = np.frombuffer(encoder(path).encode(text), "<u4").tolist()
        assert ids == plain(path, text), repr(text)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_blocks_give_the_ids_of_the_whole_texts(path):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])
    texts = table.column("text").combine_chunks()
    made = Encoder(encoder(path).tokenizer, kept_bytes=1 << 20)
    n = 0
    for block in blocks_of(texts, 1 << 18):
        ids, starts = made.encode_block(block)
        for k, text in enumerate(block.to_pylist()):
            assert ids[starts[k] : starts[k + 1]].tolist() == plain(path, text)
        n += len(block)
    assert n == len(texts)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_very_long_texts_give_the_ids_of_the_library(path):
    texts = ["x" * 50_000, "ab c\n" * 400_000, "\n" * 3000 + "end", None, ""]
    ids, starts = Encoder(encoder(path).tokenizer).encode_block(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[starts[k] : starts[k + 1]].tolist() == plain(path, text)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_kept_units_are_bounded(path):
    made = Encoder(encoder(path).tokenizer, kept_bytes=4000)
    for k in range(300):
        assert made.encode(f"w{k} again, w{k}").tolist() == plain(path, f"w{k} again, w{k}")
        assert made.units.held_bytes <= 4000 + 200
    assert "again" in "".join(made.units.words.to_pylist())


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=200), st.data())
@settings(max_examples=60, deadline=None)
def test_packing_bits_is_a_round_trip(width, values, data):
    ids = np.array([v & (1 << width) - 1 for v in values], np.uint32)
    packed = pack(ids, width)
    assert len(packed) == -(-len(ids) * width // 8)
    assert unpack(packed, len(ids), width).tolist() == ids.tolist()
    if len(ids):
        first = data.draw(st.integers(0, len(ids) - 1))
        assert unpack(packed, len(ids) - first, width, first).tolist() == ids[first:].tolist()


def test_an_id_beyond_the_width_is_refused():
    with pytest.raises(ValueError):
        pack(np.array([8]), 3)
    assert (bits_for(1), bits_for(2), bits_for(49_408), bits_for(65_537)) == (1, 1, 16, 17)


def test_random_access_reads_any_stretch(tmp_path):
    ids = np.random.default_rng(1).integers(0, 1 << 17, 50_000).astype(np.uint32)
    uri, stream = files.create(f"file://{tmp_path}", ".tokens")
    writer = TokenWriter(stream, 17)
    cuts = [0, 1, 1, 20_000, 49_999, 50_000]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        writer.add(k, ids[a:b])
    writer.close()
    with files.open_random(uri) as file:
        reader = TokenReader(file)
        for a, b in ((0, 50_000), (8191, 8193), (16_384, 16_384), (49_990, 50_000)):
            assert reader.ids(a, b).tolist() == ids[a:b].tolist()
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            assert reader.document(k).tolist() == ids[a:b].tolist()


def test_files_hold_all_documents_in_order(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    manifest = write_token_files(docs, f"file://{tmp_path}", WORDS, 2, file_ids=50)
    got = sorted(map(tuple, read_digests(manifest).collect()), key=lambda r: r[1])
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for row in order:
        ids = plain(WORDS, row[1]) + [2]
        want.append((row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert manifest.count() > 1


def test_an_empty_table_writes_no_file(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    manifest = write_token_files(docs, f"file://{tmp_path}", WORDS, 2)
    assert manifest.count() == 0 and read_digests(manifest).count() == 0
    assert packing.pack(docs, BYTES, 1).count() == 0


def check_pieces(rows, pieces, window):
    """Every token in one piece, sequences gapless, padding in the last one alone."""
    wanted = sorted((r[0] is not None, r[0] or 0, len(plain(BYTES, r[1])) + 1) for r in rows)
    firsts = sorted((p.doc_id is not None, p.doc_id or 0, p.doc_tokens) for p in pieces if p.start == 0)
    assert firsts == wanted
    assert sum(p.length for p in pieces) == sum(w[2] for w in wanted)
    by_sequence = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == by_sequence.get(p.sequence_id, 0)
        by_sequence[p.sequence_id] = p.offset + p.length
    sizes = [by_sequence[k] for k in sorted(by_sequence)]
    assert sorted(by_sequence) == list(range(len(sizes)))
    assert all(n == window for n in sizes[:-1])


def test_packing_loses_and_repeats_nothing(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    pieces = packing.pack(docs, BYTES, 1, window=64, packet=16, with_ids=True)
    rows = pieces.collect()
    check_pieces(ROWS, rows, 64)
    for p in rows:
        texts = [r[1] for r in ROWS if r[0] == p.doc_id]
        stretches = [(plain(BYTES, t) + [1])[p.start : p.start + p.length] for t in texts]
        assert np.frombuffer(p.ids, "<u4").tolist() in stretches
        assert p.ids_crc32 == zlib.crc32(p.ids)
    whole = {r.sequence_id: r.ids for r in packing.sequences(pieces, 64, 9).collect()}
    assert all(len(ids) == 64 for ids in whole.values())
    for p in rows:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert whole[p.sequence_id][p.offset : p.offset + p.length] == ids


def test_windows_follow_the_mixture(spark):
    rows = [(k, "w " * 40, "ab"[k % 2], "", 0) for k in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    pieces = packing.pack(docs, BYTES, 1, {"a": 0.75, "b": 0.25}, window=256, packet=32).collect()
    check_pieces(rows, pieces, 256)
    early = [p for p in pieces if p.sequence_id < 20]
    share = sum(p.length for p in early if p.source == "a") / sum(p.length for p in early)
    assert abs(share - 0.75) < 0.02
    with pytest.raises(ValueError):
        packing.pack(docs, BYTES, 1, {"a": 0.0})


def test_temperature_evens_out_the_sources(spark):
    """Shares follow the square roots of the sources' tokens, until the small one is empty."""
    rows = [(k, "w " * 40, "a" if k % 10 else "b", "", 0) for k in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    pieces = packing.pack(docs, BYTES, 1, window=256, packet=16, temperature=2.0).collect()
    check_pieces(rows, pieces, 256)
    want = 1 / (1 + 9**0.5)
    last = max(p.sequence_id for p in pieces if p.source == "b")
    assert last > 20
    for w in range(0, last - 4, 4):
        held = [p for p in pieces if w <= p.sequence_id < w + 4]
        share = sum(p.length for p in held if p.source == "b") / sum(p.length for p in held)
        assert abs(share - want) < 0.02
    with pytest.raises(ValueError):
        packing.pack(docs, BYTES, 1, temperature=0)
