"""WARC archives: a writer that stores repeated payloads once, and a sequential reader.

Archives are rows (path, content), the shape of Spark's ``binaryFile`` source, so the
reader takes either what the writer stored or ``.warc.gz`` files from anywhere. The writer
closes an archive when it is large enough; archives never outgrow a row.

The reader feeds an archive to zlib bit by bit. Each gzip member is one record: its head
ends at the first empty line, its block is as long as Content-Length says, and the block's
and the payload's SHA-1 are taken as the bytes pass.

Defined cases. Null payload: empty. Null url: no target line. Null or repeated ids: equal
payloads revisit the largest id; rows that share this id are all responses. Empty table:
no archives. A broken member gives one row with ``error`` and ends its archive, whose later
members can't be found safely.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.llm.common import slices, stored, type_of

ARCHIVE_BYTES = 8 << 20
MIN_REVISIT = 1000
FEED = 1 << 16
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(text: str) -> str:
    """A header value has no line ends or other control characters."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in text)


def record(page_id, url: str | None, payload: bytes, refers_to=None, date: str = DATE) -> bytes:
    """One record as a gzip member; a revisit, without payload, if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    head += [f"WARC-Record-ID: <urn:page:{'' if page_id is None else _line(str(page_id))}>", f"WARC-Date: {date}"]
    head += [] if url is None else [f"WARC-Target-URI: {_line(url)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{_line(str(refers_to))}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: {_sha1(payload)}", f"WARC-Block-Digest: {_sha1(block)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _headers(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = raw.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


class Member:
    """Takes the inflated bytes of one record in any portions."""

    def __init__(self):
        self.held, self.head, self.http = bytearray(), None, None
        self.need = 0
        self.block, self.payload_sha, self.payload = hashlib.sha1(), hashlib.sha1(), bytearray()
        self.tail = bytearray()

    def feed(self, data: bytes) -> None:
        if self.head is None:
            seen = max(0, len(self.held) - 3)
            self.held += data
            end = self.held.find(b"\r\n\r\n", seen)
            if end < 0:
                return
            version, self.head = _headers(bytes(self.held[:end]))
            if not version.startswith("WARC/"):
                raise ValueError("no WARC version line")
            self.need = int(self.head["content-length"])
            self.framed = self.head.get("content-type", "").startswith("application/http")
            data, self.held = bytes(self.held[end + 4 :]), bytearray()
        now, rest = data[: self.need], data[self.need :]
        self.need -= len(now)
        self.block.update(now)
        self.tail += rest
        if not self.framed:
            self._take(now)
        elif self.http is not None:
            self._take(now)
        elif now:
            seen = max(0, len(self.held) - 3)
            self.held += now
            end = self.held.find(b"\r\n\r\n", seen)
            if end >= 0:
                self.http = _headers(bytes(self.held[:end]))[1]
                self._take(bytes(self.held[end + 4 :]))
                self.held = bytearray()

    def _take(self, data: bytes) -> None:
        self.payload_sha.update(data)
        self.payload += data

    def row(self) -> dict:
        """What the record says, after checking it."""
        if self.head is None or self.need:
            raise ValueError("the record ends early")
        if bytes(self.tail) != b"\r\n\r\n":
            raise ValueError("the record does not end with two line ends")
        head, kind = self.head, self.head.get("warc-type")
        if (said := head.get("warc-block-digest")) and said != "sha1:" + base64.b32encode(self.block.digest()).decode():
            raise ValueError("block digest differs")
        said = head.get("warc-payload-digest")
        if kind != "revisit":
            mine = self.payload_sha.digest()
            if said and said != "sha1:" + base64.b32encode(mine).decode():
                raise ValueError("payload digest differs")
            length = len(self.payload)
        else:
            mine = base64.b32decode(said.removeprefix("sha1:")) if said else None
            length = int((self.http or {}).get("content-length", 0))
        return {
            "record_type": kind, "record_id": head.get("warc-record-id"), "target_uri": head.get("warc-target-uri"),
            "refers_to": head.get("warc-refers-to"), "payload_bytes": length,
            "payload_digest": mine.hex() if mine is not None else None,
            "payload": bytes(self.payload) if kind != "revisit" else None, "error": None,
        }


def read_members(portions: Iterable[bytes]) -> Iterator[dict]:
    """The records of one archive, from its compressed bytes in order."""
    inflate, member, offset, done = zlib.decompressobj(31), Member(), 0, 0
    started = False
    try:
        for portion in portions:
            while portion:
                started = True
                member.feed(inflate.decompress(portion, FEED))
                if inflate.eof:
                    rest = inflate.unused_data
                    done += len(portion) - len(rest)
                    yield member.row() | {"offset": offset}
                    inflate, member, offset, started = zlib.decompressobj(31), Member(), done, False
                    portion = rest
                else:
                    rest = inflate.unconsumed_tail
                    done += len(portion) - len(rest)
                    portion = rest
        while started and not inflate.eof:
            more = inflate.decompress(b"", FEED)
            if not more and not inflate.eof:
                raise ValueError("the archive ends inside a record")
            member.feed(more)
        if started:
            yield member.row() | {"offset": offset}
    except (ValueError, KeyError, zlib.error) as problem:
        yield dict.fromkeys((
            "record_type", "record_id", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload"
        )) | {"error": str(problem) or type(problem).__name__, "offset": offset}


def assign_revisits(pages: DataFrame, page_id="page_id", url="url", html="html", least: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, html, refers_to): ``refers_to`` is the page with the payload, for
    repeats of at least ``least`` bytes."""
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    ).withColumns({"digest": F.sha1("html"), "size": F.octet_length("html")})
    first = (
        rows.filter(F.col("size") >= least).groupBy("digest", "size")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    # Both sides of the join are read as they are, so Spark may split a frequent payload.
    met = rows.join(stored(first, "repeated-payloads"), ["digest", "size"], "left")
    return met.select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )


def write_archives(assigned: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(path, content): the pages as archives of about ``archive_bytes``."""
    schema = pa.schema([("path", pa.string()), ("content", pa.binary())])

    def run(batches):
        part, name, archive = TaskContext.get().partitionId(), 0, bytearray()
        for batch in batches:
            for piece in slices(batch):
                for row in piece.to_pylist():
                    archive += record(row["page_id"], row["url"], row["html"].encode("utf-8", "replace"), row["refers_to"])
                    if len(archive) >= archive_bytes:
                        yield pa.RecordBatch.from_pylist(
                            [{"path": f"{part:06d}-{name:06d}.warc.gz", "content": bytes(archive)}], schema=schema)
                        name, archive = name + 1, bytearray()
        if archive:
            yield pa.RecordBatch.from_pylist([{"path": f"{part:06d}-{name:06d}.warc.gz", "content": bytes(archive)}], schema=schema)

    return assigned.mapInArrow(run, "path STRING, content BINARY")


READ = (
    "path STRING, offset BIGINT, record_type STRING, record_id STRING, target_uri STRING, refers_to STRING, "
    "payload_bytes BIGINT, payload_digest STRING, payload BINARY, error STRING"
)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all archives (path, content); without ``payloads`` they are checked
    but not returned."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = T._parse_datatype_string(READ)
    arrow = to_arrow_schema(fields)

    def run(batches):
        for batch in batches:
            for piece in slices(batch):
                for path, content in zip(piece.column(0).to_pylist(), piece.column(1)):
                    view = memoryview(content.as_buffer() or b"")
                    rows, held = [], 0
                    for row in read_members(bytes(view[i : i + FEED]) for i in range(0, len(view), FEED)):
                        rows.append(row | {"path": path} | ({} if payloads else {"payload": None}))
                        held += len(rows[-1]["payload"] or b"") + 200
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return archives.select("path", "content").mapInArrow(run, fields)


def page_of(urn: F.Column, pages: DataFrame, page_id="page_id") -> F.Column:
    """The page id inside a record id, in the type of the pages."""
    return F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit("")).cast(type_of(pages, page_id))
