"""The deep check: stored bytes against their recorded hash and size, and what extraction makes of them now against the recorded text.

Data files are named by the digest of their rows, so a file that was checked needs no second look as long as extraction is
the same.  The record (digest, extractor, attempt, key, problem, n) keeps what was found: a row for each problem, and for a file whose rows
were all extracted a seal with the number of its problems.  A check reads only files without a seal, so it takes up where it stopped, reads what a
commit has written, and nothing else; problems of files that were checked before are told again from the record.  A file with an
extraction that failed gets no seal and is tried again, as tools may lack or time out.

Files are taken in batches of bounded bytes, one Spark job and one append to the record each; of a file the latest attempt counts, and
a seal counts if as many problems as it says are there.  Texts are compared by their hashes, which are made where the text is read.

Edge cases: rows without bytes have the one problem "no file"; a null hash or size is no problem here (verify tells it); two rows
of one id are two rows.
"""

from __future__ import annotations

import hashlib
import subprocess
import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.plans.store import SnapshotStore
from parchment.sources.extract import Pdf, extract, poppler

#: To be raised when extraction changes: what was checked with another version is checked again.
EXTRACTION = "1"
BATCH_BYTES = 16 << 30
RECORD = "digest string, extractor string, attempt string, key string, problem string, n long"
_KINDS = {"audio/mpeg": "audio", "video/mp4": "video", "text/html": "html"}
_COMPARED = ("pages", "image_pages", "ocr_pages", "text_source", "text", "ocr_text")


def _hash(text: str | None) -> str | None:
    return None if text is None else hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def row_checks(rows: DataFrame, read_pdf: Callable[[bytes], Pdf] = poppler) -> DataFrame:
    """(digest, key, problems array, whole) of each row of rows, which carry _digest; whole: extraction didn't fail."""

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                data, error, got = row.pop("file"), None, dict.fromkeys(_COMPARED)
                if data is not None:
                    try:
                        kind = _KINDS.get(row["media_type"])
                        got |= {c: v for c, v in extract(bytes(data), kind, False, read_pdf).items() if c in got}
                    except (ValueError, RuntimeError, OSError, subprocess.SubprocessError) as e:
                        error = f"{type(e).__name__}: {e}"[:300]
                found = {c: _hash(got[c]) if c in ("text", "ocr_text") else None if got[c] is None else str(got[c]) for c in _COMPARED}
                yield pd.DataFrame([row | found | {"error": error}])

    held = [(F.sha2(c, 256) if c in ("text", "ocr_text") else F.col(c).cast("string")).alias(f"_{c}") for c in _COMPARED]
    wrong_hash = F.col("file_sha256") != F.sha2("file", 256)
    wrong_size = F.col("file_size") != F.octet_length("file")
    sent = rows.select("_digest", "id", "media_type", "file", F.coalesce(wrong_hash, F.lit(False)).alias("wrong_hash"), F.coalesce(wrong_size, F.lit(False)).alias("wrong_size"), F.col("file").isNull().alias("no_file"), *held)
    kind = ", ".join(f"{c} {'boolean' if c in ('wrong_hash', 'wrong_size', 'no_file') else 'string'}" for c in (*(c for c in sent.columns if c != "file"), *_COMPARED, "error"))
    got = sent.mapInPandas(again, kind)
    rule = lambda test, text: F.when(test, F.lit(text) if isinstance(text, str) else text)
    fine = F.col("error").isNull() & ~F.col("no_file")
    differs = [rule(fine & ~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(f"{c} differs from a new extraction") if c in ("text", "ocr_text") else F.concat(F.lit(f"{c} "), F.coalesce(f"_{c}", F.lit("null")), F.lit(", a new extraction says "), F.coalesce(c, F.lit("null")))) for c in _COMPARED]
    problems = F.array_compact(F.array(rule(F.col("no_file"), "no file"), rule(F.col("wrong_hash"), "file_sha256 differs from the bytes"), rule(F.col("wrong_size"), "file_size differs from the bytes"), rule(F.col("error").isNotNull(), F.concat(F.lit("extraction failed: "), "error")), *differs))
    return got.select(F.col("_digest").alias("digest"), F.col("id").alias("key"), problems.alias("problems"), F.col("error").isNull().alias("whole"))


def latest(record: DataFrame, extractor: str) -> DataFrame:
    """The record's rows of each file's latest attempt with this extractor."""
    own = record.where(F.col("extractor") == extractor)
    last = own.groupBy("digest").agg(F.max("attempt").alias("attempt"))
    return own.join(last, ["digest", "attempt"])


def sealed(rows: DataFrame) -> DataFrame:
    """Digests of files that were checked wholly, of rows of their latest attempts."""
    return rows.groupBy("digest").agg(F.max("n").alias("n"), F.count("problem").alias("found")).where("n = found").select("digest")


class DeepCheck:
    """The record of a store's checked files."""

    def __init__(self, store: SnapshotStore, read_pdf: Callable[[bytes], Pdf] = poppler, extractor: str = EXTRACTION, batch_bytes: int = BATCH_BYTES, clock: Callable[[], float] = time.time):
        self.store, self.read_pdf, self.extractor, self.batch_bytes, self.clock = store, read_pdf, extractor, batch_bytes, clock
        self.path = f"{store.root}/_checked"
        self.checked = 0

    def record(self) -> DataFrame:
        spark = self.store.spark
        return spark.read.schema(RECORD).parquet(self.path) if self.store._exists("_checked") else spark.createDataFrame([], RECORD)

    def due(self, manifest: dict) -> DataFrame:
        """Files (as store.files) of the version that have no seal."""
        return self.store.files(manifest).join(sealed(latest(self.record(), self.extractor)), "digest", "left_anti")

    def batches(self, manifest: dict) -> Iterator[list[str]]:
        """Paths of the due files in order of their partitions; the driver holds a name a file, as readers of a version do."""
        batch, size = [], 0
        for r in self.due(manifest).select("path", "bytes").orderBy(F.desc("partition"), "start").collect():
            if batch and size + r.bytes > self.batch_bytes:
                yield batch
                batch, size = [], 0
            batch.append(f"{self.store.root}/{r.path}")
            size += r.bytes
        if batch:
            yield batch

    def run(self, manifest: dict, deadline: float = float("inf")) -> int:
        """Check what is due until the deadline; returns the number of files that were read."""
        spark, began = self.store.spark, self.checked
        for paths in self.batches(manifest):
            if self.clock() > deadline:
                break
            digest = F.regexp_extract("_metadata.file_path", r"_digest=([0-9a-f]+)/[^/]+\z", 1)
            rows = spark.read.schema(self.store.schema).parquet(*paths).select("*", digest.alias("_digest"))
            attempt = f"{int(self.clock() * 1000):015d}-{uuid.uuid4().hex}"  # later attempts sort after earlier ones
            part = f"{self.store.root}/_staging/checks-{attempt}"
            # what was found is written once: problems and seals are both made from it
            row_checks(rows, self.read_pdf).write.parquet(part)
            found = spark.read.parquet(part)
            told = found.select("digest", "key", F.explode("problems").alias("problem"), F.lit(None).cast("long").alias("n"))
            seals = found.groupBy("digest").agg(F.sum(F.size("problems")).cast("long").alias("n"), F.min("whole").alias("whole")).where("whole")
            both = told.unionByName(seals.select("digest", F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("problem"), "n"))
            both.select("digest", F.lit(self.extractor).alias("extractor"), F.lit(attempt).alias("attempt"), "key", "problem", "n").coalesce(8).write.mode("append").parquet(self.path)
            self.store._fs.delete(self.store._path(part), True)
            self.checked += len(paths)
        return self.checked - began

    def problems(self, manifest: dict) -> DataFrame:
        """(scope, key, problem) of all files of the version that have been checked, now or before."""
        homes = self.store.files(manifest).select("digest", F.col("partition").alias("scope"))
        return latest(self.record(), self.extractor).where("problem is not null").join(homes, "digest").select("scope", "key", "problem")
