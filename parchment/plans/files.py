"""Content-defined files: a partition's sorted rows are cut where a row says so itself, so an edit changes the files round it only.

A row begins a file if a hash of its id, as a share of all hashes, is below its weight over the wanted size of a file.  That depends on nothing but the
row, so files have the wanted size on average, and a row that comes, goes or changes its weight moves the borders next to it and
no others.  A file is known by its first id and the digest of its rows; a commit writes the files that no earlier version has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parchment.operators.grouping import line_digest
from parchment.plans.asof import asof

FILE_BYTES = 64 << 20
#: What a row weighs besides its texts and bytes.
ROW_BYTES = 64
#: The first file of a partition begins before any id.
FIRST = ""
FILES = T.StructType([T.StructField(n, T.StringType()) for n in ("partition", "start")] + [T.StructField(n, T.LongType()) for n in ("rows", "bytes")] + [T.StructField(n, T.StringType()) for n in ("digest", "path")])


def row_weight(schema: T.StructType) -> Column:
    """Bytes of a row's strings and binaries, and a constant for the rest."""
    wide = [f.name for f in schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return sum((F.coalesce(F.octet_length(n), F.lit(0)).cast("long") for n in wide), F.lit(ROW_BYTES).cast("long"))


def begins_file(key: Column, weight: Column, file_bytes: int = FILE_BYTES) -> Column:
    """Whether a row begins a file; 31 bits of the id's hash are compared with its share of a file."""
    share = F.least(F.lit(1.0), weight / F.lit(float(file_bytes)))
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("double") / float(1 << 32) < share


def placed_in_files(keys: DataFrame, file_bytes: int = FILE_BYTES, slices: int | None = None) -> DataFrame:
    """keys (partition, key, weight, ...) with start, the key that begins their file; a null key is in the first."""
    begun = keys.where(F.coalesce(begins_file(F.col("key"), F.col("weight"), file_bytes), F.lit(False))).select("partition", "key").distinct()
    return asof(keys, begun, ["partition"], "key", "_begun", slices).withColumn("start", F.coalesce("_begun.key", F.lit(FIRST))).drop("_begun")


def row_digest(schema: T.StructType) -> Column:
    """A hash of all of a row, null apart from empty."""
    part = lambda f: F.sha2(f.name, 256).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name)
    return F.sha2(F.to_json(F.struct(*map(part, schema)), {"ignoreNullFields": "false"}), 256)


def file_digests(placed: DataFrame) -> DataFrame:
    """(partition, start, rows, bytes, digest) of rows (partition, start, line, weight); the digest doesn't depend on their order."""
    return placed.groupBy("partition", "start").agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("bytes"), line_digest(F.col("line")).alias("digest"))


def file_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """now (partition, start, rows, bytes, digest) with the path that the version before has it under; null: to be written."""
    held = before.select("partition", "start", "digest", "path")
    return now.join(held, ["partition", "start", "digest"], "left")
