"""WARC archives: one gzip member for each record, equal payloads stored once.

The reader is sequential. It inflates a member piece by piece, frames the record by its
Content-Length and verifies block and payload digests, so it holds no more than a chunk of a
record unless the caller asks for payloads.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from kinmart.llm import files
from kinmart.workspace import stage

VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.UUID("5f0d7a52-4f5e-5c1b-9d0e-3a1f6b2c8e77")
END = b"\r\n\r\n"
CHUNK = 1 << 18
RECORD = (
    "record_id string, record_type string, target_uri string, page_id long, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary"
)


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{kind}:{page_id}:{digest}')}>"


def record_bytes(
    page_id: int | None,
    url: str | None,
    payload: bytes | None,
    digest: str,
    payload_bytes: int,
    refers_to: int | None,
    date: str,
) -> bytes:
    """One record: a response with its payload, or a revisit without it."""
    kind = "response" if refers_to is None else "revisit"
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {payload_bytes}\r\n\r\n"
    ).encode()
    if refers_to is None:
        block += payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or f"urn:page:{page_id}")
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(page_id, digest, kind)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Block-Digest", "sha1:" + base32_sha1(hashlib.sha1(block).digest())),
        ("WARC-Payload-Digest", "sha1:" + digest),
    ]
    if refers_to is not None:
        head += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest, "response")),
            ("Refers-To-Page-ID", str(refers_to)),
        ]
    if page_id is not None:
        head.append(("Page-ID", str(page_id)))
    head += [
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = b"".join(f"{name}: {value}\r\n".encode() for name, value in head)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + END


class RecordParser:
    """Takes the bytes of one member as they come and checks the record when it ends."""

    def __init__(self, keep_payload: bool):
        self.head: dict[str, str] | None = None
        self.http: dict[str, str] = {}
        self.held = bytearray()
        self.left = 0
        self.in_payload = False
        self.block, self.payload = hashlib.sha1(), hashlib.sha1()
        self.payload_bytes = 0
        self.kept: list[bytes] | None = [] if keep_payload else None

    @staticmethod
    def fields(head: bytes) -> dict[str, str]:
        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}

    def cut_head(self, data: bytes) -> tuple[bytes | None, bytes]:
        """The head and what follows it, or None as long as its end has not come."""
        seen = max(0, len(self.held) - len(END) + 1)
        self.held += data
        at = self.held.find(END, seen)
        if at < 0:
            return None, b""
        head, rest, self.held = bytes(self.held[:at]), bytes(self.held[at + len(END) :]), bytearray()
        return head, rest

    def feed(self, data: bytes) -> None:
        if self.head is None:
            head, data = self.cut_head(data)
            begins = bytes((self.held if head is None else head)[:5])
            if not b"WARC/".startswith(begins):
                raise ValueError("a member does not begin with a WARC record")
            if head is None:
                return
            self.head = self.fields(head)
            self.left = int(self.head["content-length"])
            self.in_payload = not self.head.get("content-type", "").startswith("application/http")
        body, tail = data[: self.left], data[self.left :]
        self.left -= len(body)
        self.block.update(body)
        if not self.in_payload and body:
            head, body = self.cut_head(body)
            if head is not None:
                self.http, self.in_payload = self.fields(head), True
        if self.in_payload and body:
            self.payload.update(body)
            self.payload_bytes += len(body)
            if self.kept is not None:
                self.kept.append(body)
        if tail:
            if self.in_payload or self.left == 0:
                self.held += tail
            if len(self.held) > len(END):
                raise ValueError("bytes after the end of a record")

    def row(self) -> tuple:
        if self.head is None or self.left or self.held != END:
            raise ValueError("a record is shorter or longer than its Content-Length")
        head, kind = self.head, self.head["warc-type"]
        stated = head.get("warc-block-digest")
        if stated and stated != "sha1:" + base32_sha1(self.block.digest()):
            raise ValueError(f"block digest of {head['warc-record-id']} does not match")
        digest, n_bytes = base32_sha1(self.payload.digest()), self.payload_bytes
        stated = head.get("warc-payload-digest", "").removeprefix("sha1:")
        if kind == "revisit":
            digest, n_bytes = stated, int(self.http.get("content-length", 0))
        elif (stated and stated != digest) or n_bytes != int(self.http.get("content-length", n_bytes)):
            raise ValueError(f"payload of {head['warc-record-id']} does not match")
        number = lambda name: int(head[name]) if name in head else None
        return (
            head["warc-record-id"],
            kind,
            head.get("warc-target-uri"),
            number("page-id"),
            number("refers-to-page-id"),
            n_bytes,
            digest,
            None if self.kept is None or kind == "revisit" else b"".join(self.kept),
        )


def parse(stream, keep_payload: bool = False) -> Iterator[tuple]:
    """Rows of one archive, in the order of its records."""
    waiting = stream.read(CHUNK)
    while waiting:
        inflater, record = zlib.decompressobj(31), RecordParser(keep_payload)
        while not inflater.eof:
            if not waiting:
                waiting = stream.read(CHUNK)
                if not waiting:
                    raise ValueError("an archive ends inside a record")
            out = inflater.decompress(waiting, CHUNK)
            waiting = inflater.unconsumed_tail
            if out:
                record.feed(out)
        yield record.row()
        waiting = inflater.unused_data or stream.read(CHUNK)


def payload_of(text: Column) -> Column:
    return F.coalesce(text.cast("binary"), F.lit(b""))


def decide(pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int) -> DataFrame:
    """Pages with payload, digest and the page whose response they revisit, if any.

    Only digests travel to find equal payloads, summed before the shuffle; the join then brings
    the few repeated digests to the pages. Both its sides are plain exchanges (or the owners are
    small enough for Spark to send), so adaptive execution splits a payload that fills a third
    of the table.
    """
    payload = payload_of(F.col(html))
    keyed = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
        F.unhex(F.sha1(payload)).alias("digest"),
        F.length(payload).cast("long").alias("payload_bytes"),
    )
    owners = (
        keyed.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest", "payload_bytes")
        .agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "payload_bytes", "owner")
    )
    owners = stage(owners, "payload-owners")
    refers = F.when(F.col("owner") != F.col("page_id"), F.col("owner"))
    joined = keyed.join(owners, ["digest", "payload_bytes"], "left").withColumn("refers_to", refers)
    return joined.select(
        "page_id",
        "url",
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
        "digest",
        "payload_bytes",
        "refers_to",
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    date: str = "2020-01-01T00:00:00Z",
    file_bytes: int = 512 << 20,
) -> DataFrame:
    """Write every page as a record and return the staged manifest of the archives.

    Of pages whose payloads are equal and at least ``min_bytes`` long, the one with the largest
    id is the response, the others are revisits. A null html is an empty payload, a null url
    becomes ``urn:page:<id>``, a page without id is always a response that nothing refers to,
    and repeated rows of the owning page are responses each. An empty table writes no file.
    ``file_bytes`` is where a task begins its next archive.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, out, n, size = [], None, 0, 0
        part = TaskContext.get().partitionId()

        def close():
            out[1].close()
            made.append((out[0], part, len(made), n, n, size))

        for batch in batches:
            for row in files.rows_of(batch):
                if out is None:
                    out, n, size = files.create(folder, ".warc.gz"), 0, 0
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                raw = record_bytes(
                    row["page_id"],
                    row["url"],
                    row["payload"],
                    base32_sha1(row["digest"]),
                    row["payload_bytes"],
                    row["refers_to"],
                    date,
                )
                member = packer.compress(raw) + packer.flush()
                out[1].write(member)
                n, size = n + 1, size + len(member)
                if size >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield files.manifest_batch(made)

    records = decide(pages, page_id, url, html, min_bytes)
    return files.staged_manifest(records.mapInArrow(write, files.MANIFEST), "archives")


def read_archives(manifest: DataFrame, keep_payload: bool = False) -> DataFrame:
    """Every record of the archives that ``manifest`` names, verified; one task reads one file.

    A record that is cut short, longer than stated or does not match a digest fails the job
    with a message that names its file. Revisits carry digest and length of the full payload.
    """
    rows_each = 4096 if not keep_payload else 64
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.string()] * 3 + [pa.int64()] * 3 + [pa.string(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names
            )

        for paths in batches:
            for path in paths.column("path").to_pylist():
                rows = []
                try:
                    with files.open_stream(path) as stream:
                        for row in parse(stream, keep_payload):
                            rows.append(row)
                            if len(rows) >= rows_each:
                                yield batch(rows)
                                rows = []
                except (ValueError, zlib.error, KeyError) as bad:
                    raise ValueError(f"{path}: {bad}") from bad
                if rows:
                    yield batch(rows)

    return files.one_task_each(manifest.select("path")).mapInArrow(read, RECORD)
