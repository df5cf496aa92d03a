"""WARC archives: a writer for page tables and a splittable reader.

Writing. A record is one gzip member. Of records with equal payloads (SHA-1) that with the largest
page id is a ``response``; the others are ``revisit`` records, which hold the HTTP header only and
refer to it. Tasks compress their records into blocks and Spark's own writer puts the blocks into
files, so commits, retries and any file system Spark writes to work as usual. Blocks are separated
by an empty gzip member, which every gzip reader passes over.

Reading. Files are cut into byte ranges, whatever lies in them. A task looks in its range for the
gzip magic number, takes each hit as a candidate and decodes its first bytes: a member is a record
if they are a complete WARC header. The task owns the records that begin in its range and reads past
the range's end to finish the last. Inside a record it does not look for candidates, and a false hit
in a range's first, foreign part fails to decode or has no header.

Defined cases: null HTML is an empty payload, null URLs an empty URI. Rows that repeat the largest id
of a payload are each a response. Rows without an id are revisits if their payload has an id at all,
else responses. A member that begins as a WARC record and cannot be decoded to its end raises an error, also if its
header breaks off. A header may have any length.
An empty table gives files without records. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textops import map_rows

MAGIC = b"\x1f\x8b\x08"
#: An empty gzip member, as text of one byte per character for Spark's writer.
EMPTY_MEMBER = bytes.fromhex("1f8b0800000000000003") + b"\x03\x00" + bytes(8)
BLOCK = 1 << 22
SPLIT = 1 << 23
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"


def _record_id(page_id: int | None) -> str:
    return f"<{URN}{'' if page_id is None else page_id}>"


def _page_id(record_id: str | None) -> int | None:
    own = (record_id or "").strip("<>").removeprefix(URN)
    return int(own) if own else None


def record(page_id, url, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One WARC/1.1 record, not compressed. A revisit has the HTTP header of its payload only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (b"" if revisit else payload)
    uri = "".join(c for c in url or "" if c not in "\r\n")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def _write_step(least_bytes: int):
    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        held, size = [], 0
        for page_id, url, html, sha1, keeper in rows:
            payload = (html or "").encode("utf-8", "surrogatepass")
            digest = base64.b32encode(bytes.fromhex(sha1)).decode()
            revisit = keeper is not None and keeper != page_id and len(payload) >= least_bytes
            held.append(member(record(page_id, url, payload, digest, keeper, revisit)))
            size += len(held[-1])
            if size >= BLOCK:
                yield (b"".join(held),)
                held, size = [], 0
        if held:
            yield (b"".join(held),)

    return step


def write(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Writes a record per row of ``page_id, url, html``; payloads of fewer bytes are never revisits."""
    own = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.col("html").cast("string"),
        F.sha1(F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")).alias("sha1"),
    )
    copies = own.groupBy("sha1").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1").drop("n")
    marked = own.join(copies, "sha1", "left").select("page_id", "url", "html", "sha1", "keeper")
    blocks = map_rows(marked, _write_step(least_bytes), "block binary")
    blocks.select(F.col("block").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option(
        "lineSep", EMPTY_MEMBER.decode("latin-1")
    ).text(path)


# ---- reading ----------------------------------------------------------------------------


def _open(path: str):
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(parts.path))
    system, own = fs.FileSystem.from_uri(path)
    return system.open_input_file(own)


class _Range:
    """Bytes of a file from ``start`` on; grows while a record needs more."""

    def __init__(self, source, start: int, size: int, more: int = 1 << 20):
        self.source, self.start, self.more = source, start, more
        source.seek(start)
        self.data = source.read(size)

    def grow(self) -> bool:
        part = self.source.read(self.more)
        self.data += part
        return bool(part)

    def header(self, at: int) -> bool:
        """Whether a gzip member that begins with a WARC header lies here, however long the header is.

        Raises if a member that begins as a record has no end of its header.
        """
        decoder, out, read, size = zlib.decompressobj(31), bytearray(), at, 512
        while True:
            more = read < len(self.data) or self.grow()
            part = self.data[read : read + size]
            try:
                seen = len(out)
                out += decoder.decompress(part)
            except zlib.error:
                more = False
            if not b"WARC/".startswith(out[:5]):
                return False
            end = out.find(b"\r\n\r\n", max(0, seen - 3))
            if end >= 0:
                return b"WARC-Type:" in out[:end] and b"Content-Length:" in out[:end]
            if decoder.eof or not more:
                if len(out) < 5:
                    return False
                raise ValueError(f"the header of a record at byte {self.start + at} breaks off")
            read += len(part)
            size = min(2 * size, 1 << 18)

    def member(self, at: int) -> tuple[bytes, int]:
        """The decoded member and the position after it."""
        decoder, out, read = zlib.decompressobj(31), [], at
        while not decoder.eof:
            if read >= len(self.data) and not self.grow():
                raise ValueError(f"a record at byte {self.start + at} ends too soon")
            part = self.data[read : read + (1 << 18)]
            out.append(decoder.decompress(part))
            read += len(part)
        return b"".join(out), read - len(decoder.unused_data)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode().lower()] = value.strip().decode("utf-8", "surrogatepass")
    return fields, rest[: int(fields["content-length"])]


def records_of(path: str, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(offset, header, block)`` of the records that begin in ``[start, end)`` of a file."""
    with _open(path) as source:
        # Two bytes more, for a magic number that begins at the last byte.
        window = _Range(source, start, end - start + len(MAGIC) - 1)
        at = 0
        while True:
            at = window.data.find(MAGIC, at)
            if at < 0 or start + at >= end:
                return
            if window.header(at):
                data, after = window.member(at)
                yield start + at, *parse(data)
                at = after
            else:
                at += 1


def _read_step(with_payload: bool):
    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        for path, start, end in rows:
            for offset, fields, block in records_of(path, start, end):
                http, _, payload = block.partition(b"\r\n\r\n")
                kind = fields.get("warc-type")
                if kind == "revisit":
                    lines = [x.partition(b":") for x in http.split(b"\r\n")[1:]]
                    size = next((int(v) for k, _, v in lines if k.lower() == b"content-length"), None)
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                else:
                    size = len(payload)
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                yield (
                    path,
                    offset,
                    fields.get("warc-record-id"),
                    kind,
                    fields.get("warc-refers-to"),
                    fields.get("warc-target-uri"),
                    size,
                    digest,
                    payload if with_payload else None,
                )

    return step


def read(spark: SparkSession, path: str, split_bytes: int = SPLIT, with_payload: bool = True) -> DataFrame:
    """All records of the archives under a path.

    Spark lists the files (their content is not read for that); each byte range is one row and the
    rows are spread over as many tasks.
    """
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("path", "length")
    at = F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes)))
    ranges = files.select("path", "length", at.alias("start")).select(
        "path", "start", F.least(F.col("start") + split_bytes, "length").alias("end")
    )
    # So many tasks at most; a task takes more than one range beyond that.
    count = files.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 1
    schema = (
        "path string, offset long, record_id string, record_type string, refers_to string, uri string, "
        "payload_bytes long, payload_digest string, payload binary"
    )
    return map_rows(ranges.repartition(min(int(count), 100_000)), _read_step(with_payload), schema)


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Writes the pages and reads the archives back; one row per page."""
    write(pages, path)
    back = read(pages.sparkSession, path, with_payload=False)
    number = lambda c: F.regexp_extract(c, URN + "(-?[0-9]+)", 1)
    to_id = lambda c: F.when(number(c) != "", number(c).cast("long"))
    return back.select(
        to_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        to_id("refers_to").alias("refers_to"),
    )
