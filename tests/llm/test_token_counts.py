"""Token counts: chunks spliced at shared tokens against whole-text encoding."""

import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kinmart.llm import token_counts
from kinmart.llm.token_counts import Chunks, count_tokens, piece_model

PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, uid long, chunk int, n_bytes string"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def counted(spark, rows, chunks, path=PIECES, limit=50):
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, count_tokens(docs, path, limit, chunks).collect()), key=repr)


def wanted(rows, limit=50):
    out = []
    for key, text in rows:
        n = len(LIBRARY.encode(text or ""))
        out.append((key, len((text or "").encode()), n, n > limit))
    return sorted(out, key=repr)


def random_text(dice, n):
    signs = ["the ", "token", "ization", " ", "  ", "\n", "\t", "é", "ß", "日本", "🙂", "▁", ".", "aaaa", "0", "<s>", "\x00"]
    return "".join(dice.choices(signs, k=n))


ROWS = [
    (1, "a plain short text"), (2, None), (3, ""), (None, "no id"), (4, "same"), (4, "same"),
    (5, " "), (6, " leading and trailing "), (7, "</s> <unk> <0x0A>"),
]


@pytest.mark.parametrize("chunks", [Chunks(64, 48), Chunks(40, 30), Chunks()])
def test_counts_equal_whole_encoding(spark, chunks):
    dice = random.Random(6)
    rows = ROWS + [(100 + k, random_text(dice, dice.randint(10, 600))) for k in range(60)]
    rows += [(200, "x" * 5000), (201, "ab" * 4000), (202, " " * 3000), (203, "日本" * 2000), (204, "🙂" * 900)]
    rows += [(205, "\n".join(["the same line again"] * 400)), (206, "=" * 777 + "-" * 999)]
    assert counted(spark, rows, chunks) == wanted(rows)


def test_chunks_cover_a_text_and_widen_to_the_whole():
    for chars, step in ((64, 48), (40, 30), (16_384, 15_872)):
        chunks, n = Chunks(chars, step), 1_000_003
        while chunks.number(n) > 1:
            k = chunks.number(n)
            assert (k - 1) * chunks.step + chunks.overlap < n <= (k - 1) * chunks.step + chunks.chars
            wider = chunks.wider()
            assert wider.number(n) == max(1, -(-(k - 1) // 4))
            chunks = wider
        assert n <= chunks.chars
    with pytest.raises(ValueError):
        Chunks(10, 6)


def test_most_junctions_need_no_widening(spark, monkeypatch):
    rounds = []
    plain = token_counts.encoded
    monkeypatch.setattr(token_counts, "encoded", lambda *a: rounds.append(1) or plain(*a))
    dice = random.Random(1)
    words = ["".join(dice.choices("abcdefghij", k=dice.randint(1, 12))) for _ in range(500)]
    rows = [(k, " ".join(dice.choices(words, k=30_000))) for k in range(4)]
    assert counted(spark, rows, Chunks()) == wanted(rows) and len(rounds) == 1
    rows = [(1, "x" * 100_001)]
    assert counted(spark, rows, Chunks()) == wanted(rows)


def test_a_long_text_goes_to_many_tasks(spark):
    rows = [(1, "some words of a long text " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = token_counts.counted_or_cut(docs, PIECES, Chunks())
    parts = held.where("chunk is not null")
    assert parts.count() == Chunks().number(len(rows[0][1])) > 60
    found = token_counts.encoded(parts, PIECES, Chunks())
    assert found.count() == parts.count()
    assert token_counts.spliced(found).first()["n_tokens"] == len(LIBRARY.encode(rows[0][1]))


def test_borders_name_characters_and_lengths():
    text = "日本 and é 𓀀 more"
    n, head, tail = piece_model(PIECES).borders(text, 1000, len(text))
    # The blank the library puts before the text is no part of the tail.
    assert n == len(LIBRARY.encode(text)) == len(head) == len(tail) + 1 and head[0] == -1
    shown = [text[(c >> 16) - 1000 :][: c & 0xFFFF] for c in head if c >= 0]
    assert "日" in shown and " and" in shown and "𓀀" not in shown
    assert not piece_model(PIECES).sizes[LIBRARY.piece_to_id("<0x80>")]


def test_files_for_the_other_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = ROWS + [(300, "word and\n\nmore " * 5000)]
    got = counted(spark, rows, Chunks(), path)
    want = []
    for key, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((key, len((text or "").encode()), n, n > 50))
    assert got == sorted(want, key=repr)


def test_an_empty_table_gives_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert count_tokens(docs, PIECES).count() == 0
