"""Archives: round trips, revisits, and damage that must be noticed."""

import base64
import hashlib
import io
import zlib

import pytest

from kinmart.llm import warc

SCHEMA = "page_id long, url string, html string, digest int, owner string"
ROWS = [
    (1, "http://a/", "same", 1, "x"),
    (2, "http://b/", "same", 1, None),
    (3, None, None, 1, "x"),
    (4, "http://d/ with\r\nbreak", "", 1, "x"),
    (5, "http://e/", "ü\r\n\r\n" * 100_000, 1, "x"),
    (None, "http://f/", "same", 1, "x"),
    (7, "http://g/", "only", None, "x"),
    (7, "http://g/", "only", None, "x"),
]


def bare(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("file_bytes", [1, 512 << 20])
def test_archives_are_a_round_trip(spark, tmp_path, file_bytes):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    manifest = warc.write_archives(pages, f"file://{tmp_path}", file_bytes=file_bytes)
    rows = warc.read_archives(manifest, keep_payload=True).collect()
    got = sorted(
        (r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload)
        for r in rows
    )
    kinds = {1: ("revisit", 2), 3: ("revisit", 4)}
    want = []
    for page, _, html, *_ in ROWS:
        kind, refers = kinds.get(page, ("response", None))
        data = (html or "").encode()
        payload = data if kind == "response" else None
        want.append((page or 0, kind, refers, len(data), bare(html), payload))
    assert got == sorted(want)
    ids = {r.page_id: r.record_id for r in rows}
    assert len(set(ids.values())) == len(ids)


def test_short_payloads_are_not_compared(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    manifest = warc.write_archives(pages, f"file://{tmp_path}", min_bytes=5)
    assert {r.record_type for r in warc.read_archives(manifest).collect()} == {"response"}


def test_an_empty_table_gives_no_archive(spark, tmp_path):
    manifest = warc.write_archives(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}")
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def member(raw):
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def record(payload=b"abc", refers=None):
    return warc.record_bytes(1, "u", payload, bare(payload.decode()), len(payload), refers, "d")


class Drips(io.BytesIO):
    """A stream that gives a few bytes at a time."""

    def read(self, n=-1):
        return super().read(3)


def test_records_are_framed_however_the_bytes_come():
    data = member(record()) + member(record(b"")) + member(record(refers=9))
    rows = list(warc.parse(Drips(data), keep_payload=True))
    assert [(r[1], r[4], r[5], r[7]) for r in rows] == [
        ("response", None, 3, b"abc"),
        ("response", None, 0, b""),
        ("revisit", 9, 3, None),
    ]


@pytest.mark.parametrize(
    "data",
    [
        member(record())[:-9],
        member(record().replace(b"abc", b"abd")),
        member(record()[:-1]),
        member(record() + b"x"),
        member(record() + record()),
        member(b"HTTP/1.1 200 OK\r\n\r\n"),
    ],
)
def test_damage_is_noticed(data):
    with pytest.raises((ValueError, zlib.error)):
        list(warc.parse(io.BytesIO(data)))


def test_heads_may_have_any_length():
    url = "http://a/" + "x" * 3_000_000
    raw = warc.record_bytes(1, url, b"abc", bare("abc"), 3, None, "d")
    rows = list(warc.parse(io.BytesIO(member(raw)), keep_payload=True))
    assert rows[0][2] == url and rows[0][7] == b"abc"
