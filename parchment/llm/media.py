"""Media columns: archives of media members, read by a Spark data source in byte ranges.

``write_archives`` stores payloads as PNG images (64 pixels of three 8-bit samples a row, so 192 payload bytes
a row) in ZIP files of stored members.  The data source ``media_archive`` lists a folder's archives (those that its manifest names, where it has one), plans
partitions of byte ranges over them, finds the members whose headers begin in its range from the archive's
directory, and streams them in Arrow batches; each member is read and, on an error, read again by its own
offset, so one bad member doesn't repeat the others.

Edge cases.  A null or empty text is one row of blanks with n_bytes 0.  Equal texts give equal members, as
nothing of the document but its text is stored in them; the id is in the member's name.  A member that stays
unreadable fails the read, or with option onError=keep is returned with its error and null media.  An empty
table makes no archives; the folder is made anyway and reads as no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import os
import struct
import time
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from parchment.llm.common import scratch
from parchment.llm.files import Writing, attempt_name, columns, resolve

ROW = 192
WIDTH = ROW // 3
ARCHIVE_BYTES, ARCHIVE_MEMBERS = 128 << 20, 60_000
RANGE_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
ATTEMPTS = 3
MANIFEST = "_manifest"
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_LOCAL = struct.Struct("<4s5H3L2H")
MEMBERS = "path string, member string, offset long, media binary, error string"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"


def pad(data: bytes) -> bytes:
    """data with blanks up to a positive multiple of ROW."""
    return data + b" " * (-len(data) % ROW or (0 if data else ROW))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(data: bytes, level: int = 1) -> bytes:
    """A PNG of the padded data; a tEXt chunk keeps the length before padding."""
    payload = pad(data)
    rows = len(payload) // ROW
    raw = np.zeros((rows, ROW + 1), np.uint8)
    raw[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, ROW)
    head = struct.pack(">IIBBBBB", WIDTH, rows, 8, 2, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"tEXt", b"n_bytes\0%d" % len(data)) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), level)) + _chunk(b"IEND", b"")


def decode_png(media: bytes) -> tuple[np.ndarray, int]:
    """(samples by row, length before padding) of an 8-bit RGB PNG without row filters, as encode_png writes."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG")
    at, data, n_bytes, shape = 8, b"", None, None
    while at < len(media):
        (size,), kind = struct.unpack_from(">I", media, at), media[at + 4 : at + 8]
        body = media[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", media, at + 8 + size)[0]:
            raise ValueError("a chunk of the PNG is damaged")
        if kind == b"IHDR":
            w, h, depth, color, *rest = struct.unpack(">IIBBBBB", body)
            if (depth, color, *rest) != (8, 2, 0, 0, 0):
                raise ValueError("only plain 8-bit RGB is read")
            shape = (h, 3 * w + 1)
        elif kind == b"tEXt" and body.startswith(b"n_bytes\0"):
            n_bytes = int(body[8:])
        elif kind == b"IDAT":
            data += body
        at += size + 12
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(shape)
    if raw[:, 0].any():
        raise ValueError("row filters aren't read")
    return raw[:, 1:], raw[:, 1:].size if n_bytes is None else n_bytes


def feature(samples: np.ndarray) -> str:
    """Height, mean, and a 64-bit average hash over 8 x 8 blocks."""
    h, w = samples.shape
    edges_y, edges_x = np.arange(9) * h // 8, np.arange(9) * w // 8
    total = np.zeros((h + 1, w + 1), np.int64)
    total[1:, 1:] = samples.cumsum(0, dtype=np.int64).cumsum(1)
    blocks = np.diff(np.diff(total[np.ix_(edges_y, edges_x)], axis=0), axis=1)
    size = np.outer(np.diff(edges_y), np.diff(edges_x))
    bits = blocks * samples.size > total[-1, -1] * size  # integers, so equal on every machine
    return f"h{h}:m{int(total[-1, -1]) * 1000 // samples.size}:{int(''.join('1' if b else '0' for b in bits.ravel()), 2):016x}"


def write_archives(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Store every text as a member named by its id; returns the manifest (path, members)."""
    fs, path = resolve(folder)
    fs.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, archive, n = None, None, 0
        for doc_id, data in columns(batches):
            if out is None:
                out, n = Writing(f"{folder}/{attempt_name('media')}.zip"), 0
                archive = zipfile.ZipFile(_Forward(out), "w", zipfile.ZIP_STORED)
            archive.writestr(zipfile.ZipInfo(f"{doc_id}-{n}.png"), encode_png((data or "").encode()))
            n += 1
            if out.size >= ARCHIVE_BYTES or n >= ARCHIVE_MEMBERS:
                archive.close()
                yield pa.RecordBatch.from_pydict({"path": [out.close()], "members": [n]})
                out = None
        if out is not None:
            archive.close()
            yield pa.RecordBatch.from_pydict({"path": [out.close()], "members": [n]})

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "path string, members long")


class _Forward(io.RawIOBase):
    """A stream that only goes forward, for zipfile."""

    def __init__(self, out: Writing):
        self.out = out

    def writable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.out.size

    def write(self, data) -> int:
        return self.out.write(bytes(data))


@dataclass
class ByteRange(InputPartition):
    """Members whose local headers begin at start <= offset < end of one archive."""

    uri: str
    start: int
    end: int


class MediaArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].rstrip("/")
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.attempts = int(options.get("attempts", ATTEMPTS))
        self.keep = options.get("onError", "fail") == "keep"

    def partitions(self) -> list[ByteRange]:
        """Ranges of the archives that the manifest names: a name and a size for each archive, and an offset for each range."""
        from pyarrow import fs as pfs

        fs, path = resolve(self.folder)
        found = [(x.base_name, x.size) for x in fs.get_file_info(pfs.FileSelector(path)) if x.base_name.endswith(".zip")]
        if fs.get_file_info(f"{path}/{MANIFEST}").type == pfs.FileType.Directory:  # what lost attempts left behind isn't named there
            from pyarrow import dataset

            named = {os.path.basename(x) for x in dataset.dataset(f"{path}/{MANIFEST}", filesystem=fs, format="parquet").to_table(["path"]).column(0).to_pylist()}
            found = [x for x in found if x[0] in named]
        plan = [ByteRange(f"{self.folder}/{name}", at, min(at + self.range_bytes, size)) for name, size in sorted(found) for at in range(0, size, self.range_bytes)]
        return plan or [ByteRange("", 0, 0)]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        if not part.uri:
            return
        fs, path = resolve(part.uri)
        with fs.open_input_file(path) as f:
            members = [x for x in zipfile.ZipFile(f).infolist() if part.start <= x.header_offset < part.end]
        rows: list[tuple] = []
        held, handle = 0, None
        for x in members:
            media, error = None, None
            for n in range(self.attempts):
                try:
                    handle = handle or fs.open_input_file(path)
                    media, error = _member(handle, x), None
                    break
                except (OSError, ValueError) as e:
                    handle, error = None, f"{type(e).__name__}: {e}"[:300]
                    time.sleep(0.05 * 2**n)
            if error and not self.keep:
                raise OSError(f"{part.uri}, member {x.filename} at {x.header_offset}: {error}")
            rows.append((part.uri, x.filename, x.header_offset, media, error))
            held += len(media or b"")
            if held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _member(f, info: zipfile.ZipInfo) -> bytes:
    """A stored member's bytes, read by its offset and checked."""
    f.seek(info.header_offset)
    head = f.read(_LOCAL.size)
    if len(head) < _LOCAL.size or head[:4] != b"PK\x03\x04":
        raise ValueError("no member begins here")
    *_, name, extra = _LOCAL.unpack(head)
    if info.compress_type != zipfile.ZIP_STORED:
        raise ValueError("only stored members are read")
    f.seek(info.header_offset + _LOCAL.size + name + extra)
    data = f.read(info.file_size)
    if zlib.crc32(data) != info.CRC:
        raise ValueError("the member is damaged")
    return data


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["path", "member", "offset", "media", "error"])


class MediaArchiveSource(DataSource):
    """spark.read.format("media_archive").load(folder); options rangeBytes, attempts, onError=fail|keep."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> MediaArchiveReader:
        return MediaArchiveReader({k: self.options.get(k) for k in ("path", "rangeBytes", "attempts", "onError") if self.options.get(k) is not None})


def read_archives(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    spark.dataSource.register(MediaArchiveSource)
    return spark.read.format("media_archive").options(**options).load(folder)


def describe(members: DataFrame) -> DataFrame:
    """What each member holds, computed from the stored bytes; columns FEATURES.  A member that can't be read has its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in FEATURES.split(", ")]
        types = [pa.int64() if x.endswith("long") else pa.string() for x in FEATURES.split(", ")]
        for b in batches:
            rows = []
            for member, media, error in zip(*(c.to_pylist() for c in b.columns), strict=True):
                doc_id = os.path.basename(member).rpartition("-")[0]
                doc_id = None if doc_id == "None" else int(doc_id)
                if media is None:  # a damaged member is a row too
                    rows.append((doc_id, *[None] * (len(names) - 2), error))
                    continue
                samples, n_bytes = decode_png(media)
                payload = samples.tobytes()
                rows.append((doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(samples), None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return members.select("member", "media", "error").mapInArrow(run, FEATURES)


def round_trip(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Store every text of docs in archives and describe what the data source reads back."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "media")
    write_archives(docs, folder).write.parquet(f"{folder}/{MANIFEST}")  # the write runs once, however often the result is read
    return describe(read_archives(spark, folder))
