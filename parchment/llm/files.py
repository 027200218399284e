"""Archive files in shared storage, through pyarrow's file systems (file://, hdfs://, s3:// and so on)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve(uri: str):
    """(file system, path) of a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def attempt_name(stem: str) -> str:
    """A file name that no other task or attempt uses, so that a retry never touches another's file."""
    ctx = TaskContext.get()
    return f"{stem}-{ctx.partitionId() if ctx else 0:05d}-{ctx.attemptNumber() if ctx else 0}-{uuid.uuid4().hex[:12]}"


class Writing:
    """A file written under a temporary name, and renamed when complete: readers never see half a file."""

    def __init__(self, uri: str):
        self.uri = uri
        self.fs, self.path = resolve(uri)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.out = self.fs.open_output_stream(self.path + ".part", compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        self.out.write(data)
        self.size += len(data)
        return len(data)

    def close(self) -> str:
        self.out.close()
        self.fs.move(self.path + ".part", self.path)
        return self.uri


def one_each(paths: DataFrame, column: str = "path") -> DataFrame:
    """A manifest's paths, dealt out evenly."""
    n = paths.count()
    return paths.select(column).repartition(max(1, n), F.col(column)) if n else paths.select(column)


def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches, as tuples."""
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)
