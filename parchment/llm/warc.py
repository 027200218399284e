"""WARC archives, and the normaliser that makes them addressable.

Crawlers often deliver a WARC as one gzip stream over the whole file, which can't be entered in the middle.
The normaliser inflates such a stream once, rewrites every record as a gzip member of its own, and writes a
sidecar index of (record id, type, offset, length), so that any record can be read by itself afterwards.

Records of equal payloads are written once, as the response with the largest id; the others are revisit
records that name it.  Payload digests are bare upper-case base32 SHA-1.

Edge cases.  A null html is an empty payload and takes part in the comparison when at least min_bytes is 0.  A
null id never is a largest one: its row is a revisit where another row has that payload, else a response.  Rows
that repeat an id and payload are all responses.  An empty table makes no archives and returns no rows.
Line breaks in a url become blanks.  Extra columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.llm.common import cut, scratch
from parchment.llm.files import Writing, attempt_name, columns, one_each, resolve

DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVE_BYTES = 256 << 20
BLOCK = 1 << 20
MANIFEST = "path string, records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, path string, offset long, length long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit (refers_to isn't None) carries the payload's length and digest, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    url = " ".join((url or "").split())
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def split_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


class Inflated(io.RawIOBase):
    """The bytes of all gzip members of a stream, inflated once from front to back in blocks."""

    def __init__(self, source):
        self.source, self.rest = source, b""
        self.z = zlib.decompressobj(31)

    def block(self) -> bytes:
        """The next bytes, b"" at the end."""
        while True:
            if self.z.eof:
                self.rest = self.z.unused_data or self.rest
                if not self.rest and not (got := self.source.read(BLOCK)):
                    return b""
                elif not self.rest:
                    self.rest = got
                self.z = zlib.decompressobj(31)
            data = self.z.unconsumed_tail or self.rest or self.source.read(BLOCK)
            self.rest = b""
            if not data:
                raise EOFError("the gzip stream ends early")
            out = self.z.decompress(data, BLOCK)
            if out:
                return out


def records_of(source) -> Iterator[bytes]:
    """Whole records of an inflated stream; at most one record and one block are held."""
    held, stream = bytearray(), Inflated(source)
    while True:
        at = held.find(b"\r\n\r\n")
        if at < 0:
            more = stream.block()
            if not more:
                if bytes(held).strip():
                    raise EOFError("a record ends early")
                return
            held += more
            continue
        length = next(int(x.split(b":", 1)[1]) for x in bytes(held[:at]).split(b"\r\n") if x[:15].lower() == b"content-length:")
        need = at + 4 + length + 4
        while len(held) < need:
            more = stream.block()
            if not more:
                raise EOFError("a record ends early")
            held += more
        yield bytes(held[:need])
        del held[:need]


def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to (null for responses).  Only digests are grouped; html moves once, to its digest."""
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("size", F.octet_length("html")).withColumn("digest", F.sha1("html"))
    # one row a task and payload meets in the shuffle, however many copies there are
    last = rows.groupBy("digest", "size").agg(F.max("page_id").alias("last"))
    rows = rows.join(last, ["digest", "size"])
    other = (F.col("size") >= min_bytes) & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return rows.select("page_id", "url", "html", F.when(other, F.col("last")).alias("refers_to"))


def write_monolithic(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = 1) -> DataFrame:
    """Write page_id, url, html, refers_to into whole-file gzip streams; returns the manifest (path, records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, z, n, size = None, None, 0, 0

        def close() -> pa.RecordBatch:
            out.write(z.flush())
            return pa.RecordBatch.from_pydict({"path": [out.close()], "records": [n]})

        for page_id, url, html, refers_to in columns(batches):
            if out is None:
                out, z, n, size = Writing(f"{folder}/{attempt_name('crawl')}.warc.gz"), zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
            data = record(page_id, url, html.encode(), refers_to)
            out.write(z.compress(data))
            n, size = n + 1, size + len(data)
            if size >= archive_bytes:
                yield close()
                out = None
        if out is not None:
            yield close()

    return rows.select("page_id", "url", "html", "refers_to").mapInArrow(run, MANIFEST)


def normalise(manifest: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Rewrite every archive of a manifest with one gzip member a record and a sidecar .idx; returns the new manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path,) in columns(batches):
            fs, name = resolve(path)
            stem = f"{folder}/{attempt_name('norm')}"
            out, index = Writing(f"{stem}.warc.gz"), Writing(f"{stem}.idx")
            n = 0
            with fs.open_input_stream(name, compression=None) as source:
                for data in records_of(source):
                    z = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = z.compress(data) + z.flush()
                    headers, _ = split_record(data[: data.find(b"\r\n\r\n") + 4])
                    index.write(json.dumps([headers["warc-record-id"], headers["warc-type"], out.size, len(member)]).encode() + b"\n")
                    out.write(member)
                    n += 1
            index.close()
            yield pa.RecordBatch.from_pydict({"path": [out.close()], "records": [n]})

    return one_each(manifest).mapInArrow(run, MANIFEST)


def read_member(fs_file, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """(headers, block) of the record that is the gzip member at offset."""
    fs_file.seek(offset)
    return split_record(zlib.decompress(fs_file.read(length), 31))


def _page(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name not in ("", "None") else None


def read_records(manifest: DataFrame) -> DataFrame:
    """Every record of normalised archives, read by the sidecar's offsets and verified; columns RECORDS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path,) in columns(batches):
            fs, name = resolve(path)
            with fs.open_input_stream(name.removesuffix(".warc.gz") + ".idx") as f:
                index = [json.loads(x) for x in f.read().splitlines()]
            rows = []
            with fs.open_input_file(name) as f:
                for urn, kind, offset, length in index:
                    headers, block = read_member(f, offset, length)
                    if headers["warc-record-id"] != urn:
                        raise ValueError(f"{path}: the index names {urn} at {offset}, found {headers['warc-record-id']}")
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = next(int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                        raise ValueError(f"{path}: the record at {offset} is damaged")
                    rows.append((_page(urn), size, digest, kind, _page(headers.get("warc-refers-to")), path, offset, length))
            if rows:
                names = [x.split()[0] for x in RECORDS.split(", ")]
                types = [pa.int64() if x.endswith("long") else pa.string() for x in RECORDS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return one_each(manifest).mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages as monolithic archives, normalise them, and read every record back by offset."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    # each manifest is written out, so that files of a lost task are never read and no step runs twice
    raw = cut(write_monolithic(with_revisits(pages), f"{folder}/raw"), "warc-raw")
    return read_records(cut(normalise(raw, f"{folder}/norm"), "warc-norm"))
