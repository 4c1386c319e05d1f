"""WARC archives: writing one gzip member per record, and a sequential reader.

Digests, not payloads, are shuffled to find for each payload the page that is
stored in full; payloads move only if revisits are too many to broadcast. Tasks
write their own archives to the shared folder; a manifest, written as a table, names
the archives of the attempts that succeeded. The reader inflates a stream piece by
piece, frames each record by its content length and checks the digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import written
from docmill.session import scratch_path

#: Payloads shorter than this are stored each time.
LEAST_REVISIT_BYTES = 100
#: An archive that has grown to this many compressed bytes is followed by another.
ARCHIVE_BYTES = 256 << 20
_READ_BYTES = 1 << 16

# Fixed values of the archive format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


class BadArchive(ValueError):
    """An archive that breaks the format, or a digest that does not hold."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def labelled(digest: str) -> str:
    """A digest as archives name it: algorithm and Base32."""
    return "sha256:" + base64.b32encode(bytes.fromhex(digest)).decode()


def bare(digest: str) -> str:
    name, _, value = digest.partition(":")
    if name != "sha256":
        raise BadArchive(f"unknown digest {digest[:40]}")
    return base64.b32decode(value).hex()


def _lines(first: str, headers: dict[str, object]) -> bytes:
    text = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"{first}\r\n{text}\r\n".encode("utf-8", "surrogatepass")


def _one_line(url: str | None) -> str:
    """A url as a header's value; line ends and other controls are percent-encoded."""
    return "".join(c if c > "\x1f" and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def write_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member; a revisit (``refers_to`` not null) has the HTTP
    head of its page, with the length of the whole payload, but no payload."""
    revisit = refers_to is not None
    head = _lines(
        "HTTP/1.1 200 OK",
        {"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)},
    )
    block = head if revisit else head + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{_number(page_id)}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": _one_line(url),
        "WARC-Payload-Digest": labelled(digest),
        "WARC-Block-Digest": labelled(sha256(block)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if revisit:
        headers |= {
            "WARC-Profile": REVISIT_PROFILE,
            "WARC-Refers-To": f"<urn:page:{_number(refers_to)}>",
        }
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(_lines(VERSION, headers) + block + b"\r\n\r\n") + pack.flush()


def _number(page_id) -> str:
    return "null" if page_id is None or page_id != page_id else str(int(page_id))


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


class _Member:
    """The inflated bytes of one gzip member, taken as they are asked for."""

    def __init__(self, source: BinaryIO, rest: bytes):
        self.source, self.inflate = source, zlib.decompressobj(31)
        self.ready = bytearray()
        self.pending = rest

    def fill(self) -> bool:
        """Inflate some more; false at the member's end."""
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.pending
        self.pending = b""
        if not data:
            data = self.source.read(_READ_BYTES)
            if not data:
                raise BadArchive("a gzip member is cut off")
        self.ready += self.inflate.decompress(data, _READ_BYTES)
        return True

    def head(self) -> bytes:
        """Up to the empty line that ends a head, and that line."""
        searched = 0
        while (at := self.ready.find(b"\r\n\r\n", max(0, searched - 3))) < 0:
            searched = len(self.ready)
            if not self.fill():
                raise BadArchive("a record's head does not end")
        return self.take(at + 4)

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self.fill():
                raise BadArchive("a record is shorter than its content length")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def end(self) -> bytes:
        """Check that nothing else follows; the compressed bytes behind the member."""
        if self.take(4) != b"\r\n\r\n":
            raise BadArchive("a record is longer than its content length")
        while self.fill():
            pass
        if self.ready:
            raise BadArchive("a gzip member holds more than one record")
        return self.inflate.unused_data


def _headers(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    pairs = (line.partition(":") for line in lines if line)
    return first, {name.strip().lower(): value.strip() for name, _, value in pairs}


def read_records(source: BinaryIO) -> Iterator[Record]:
    """The records of an archive, one at a time, with lengths and digests checked.
    Memory holds one record at most."""
    rest = source.read(_READ_BYTES)
    while rest:
        member = _Member(source, rest)
        version, headers = _headers(member.head())
        if version != VERSION:
            raise BadArchive(f"not a record: {version[:40]}")
        record = Record(headers, member.take(int(headers["content-length"])))
        if bare(headers["warc-block-digest"]) != sha256(record.block):
            raise BadArchive(f"block digest of {headers['warc-record-id']}")
        head, mark, record.payload = record.block.partition(b"\r\n\r\n")
        record.http = _headers(head + mark)[1]
        if headers["warc-type"] == "response":
            if bare(headers["warc-payload-digest"]) != sha256(record.payload):
                raise BadArchive(f"payload digest of {headers['warc-record-id']}")
            if int(record.http["content-length"]) != len(record.payload):
                raise BadArchive(f"payload length of {headers['warc-record-id']}")
        yield record
        rest = member.end() or source.read(_READ_BYTES)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_revisit_bytes: int = LEAST_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write all pages below ``folder`` (shared, or in a store that the executors
    reach); return the manifest: path, records, bytes of each archive.

    Null payloads are empty. Of equal payloads of ``least_revisit_bytes`` or more,
    rows with the smallest id are responses and others revisit it; rows that repeat
    that id are responses too. Null ids are written, never referred to unless all
    ids of a payload are null (then all are responses).
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(url_col).alias("_url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("_payload"),
    ).withColumn("_digest", F.sha2("_payload", 256))
    # Only digests that occur twice lead to a revisit; most pages find nothing here.
    first = (
        rows.filter(F.octet_length("_payload") >= least_revisit_bytes)
        .groupBy("_digest")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1 AND _first IS NOT NULL")
        .select("_digest", "_first")
    )
    refers = written(
        rows.select("_id", "_digest", F.octet_length("_payload").alias("_size"))
        .filter(F.col("_size") >= least_revisit_bytes)
        .join(first, "_digest")
        .filter(~F.col("_id").eqNullSafe(F.col("_first")))
        .select("_id", "_digest", "_first")
        .distinct(),
        "warc-revisits",
    )
    rows = rows.join(
        refers.select(F.col("_id").alias("_rid"), F.col("_digest").alias("_rdigest"), "_first"),
        F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_digest") == F.col("_rdigest")),
        "left",
    ).select("_id", "_url", "_payload", "_digest", "_first")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = arrow_fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out = name = None
        count = size = 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"  # each attempt has its own
                    out, count, size = store.open_output_stream(f"{base}/{name}"), 0, 0
                refers_to = None if pd.isna(row[4]) else row[4]
                page_id = None if pd.isna(row[0]) else row[0]
                data = write_record(page_id, row[1], bytes(row[2]), row[3], refers_to)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [name], "records": [count], "bytes": [size]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [name], "records": [count], "bytes": [size]})

    return written(
        rows.mapInPandas(write, "path string, records long, bytes long"), "warc-manifest"
    )


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the manifest's archives: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest (both of the whole payload), and the payload itself
    on demand (null for revisits). Each archive is read by one task, sequentially."""
    archives = manifest.select("path", "records")
    n = max(1, min(archives.count(), 100_000))
    archives = archives.repartition(n, "path")
    schema = (
        "page_id long, url string, record_type string, refers_to long,"
        " payload_bytes long, payload_digest string" + ", payload binary" * with_payload
    )

    def rows_of(source: BinaryIO) -> Iterator[tuple]:
        for record in read_records(source):
            kind = record.headers["warc-type"]
            refers_to = record.headers.get("warc-refers-to")
            row = (
                _page(record.headers["warc-record-id"]),
                record.headers["warc-target-uri"],
                kind,
                None if refers_to is None else _page(refers_to),
                int(record.http["content-length"]),
                bare(record.headers["warc-payload-digest"]),
            )
            yield (*row, record.payload if kind == "response" else None) if with_payload else row

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, records in batch.itertuples(index=False):
                rows, seen = [], 0
                with store.open_input_stream(f"{base}/{path}") as source:
                    for row in rows_of(source):
                        rows.append(row)
                        seen += 1
                        if len(rows) == (64 if with_payload else 4096):
                            yield _typed(rows, schema)
                            rows = []
                if seen != records:
                    raise BadArchive(f"{path} has {seen} records instead of {records}")
                if rows:
                    yield _typed(rows, schema)

    return archives.mapInPandas(read, schema)


def _typed(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [x.split()[0] for x in schema.split(",")]
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def archive_round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Write all pages as archives to the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_archives(write_archives(pages, folder, **columns), folder)
