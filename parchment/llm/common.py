"""What the operators share: where tables are cut, and sizes of work from sizes of data."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Query bytes for one task of a stage that shuffles; partitions follow the data, not a constant.
TASK_BYTES = 24 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir); one of our own only where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "parchment-shared")


_made: list[tuple[SparkSession, str]] = []
_registered: list[Callable] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it goes when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _registered:
        _registered.append(atexit.register(_clean))
    _made.append((spark, path))
    return path


def _clean() -> None:
    for spark, path in _made:
        if path.startswith("file:"):
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
        else:
            with contextlib.suppress(Exception):  # the session may have ended before
                drop_path(spark, path)


#: Options for tables whose rows are megabytes: pages and row groups close by size after any row, not after a hundred.
WIDE = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.enable.dictionary": "false"}


#: Spark deletes a query's shuffle files when the query ends, not when its driver happens to collect garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str, options: dict[str, str] | None = None, free: bool = False) -> DataFrame:
    """df written to the shared folder and read again: lineage ends there, lost executors cost nothing before it.

    With free the shuffle files that making df took are deleted at once.
    """
    path, conf = scratch(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, None)
    if free:
        conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**(options or {})).parquet(path)
    finally:
        if free:
            conf.unset(FREE_SHUFFLES) if before is None else conf.set(FREE_SHUFFLES, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def written(df: DataFrame) -> str | None:
    """The scratch path that cut() gave a table."""
    return getattr(df, "_scratch_path", None)


def discard(*tables: DataFrame | None) -> None:
    """Delete tables of cut() that nothing will read again."""
    for df in tables:
        path = df is not None and written(df)
        if path:
            drop_path(df.sparkSession, path)
            _made[:] = [x for x in _made if x[1] != path]


def final(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """build()'s rows, written; the scratch tables that making them took are deleted."""
    before = {path for _, path in _made}
    out = cut(build(), name)
    for spark, path in [x for x in _made if x[1] not in before and x[1] != written(out)]:
        drop_path(spark, path)
        _made.remove((spark, path))
    return out


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through Hadoop's file system, which knows every scheme."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def tasks_for(n_bytes: int, per_task: int = TASK_BYTES, least: int = 1) -> int:
    """Number of partitions for so many bytes."""
    return max(least, -(-int(n_bytes or 0) // per_task))


def crc_mod(col: Column | str, n: int) -> Column:
    """crc32 of the value as text, modulo n; null stays null."""
    return F.crc32(F.col(col).cast("string") if isinstance(col, str) else col.cast("string")) % n


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that df doesn't have (Spark's names ignore case)."""
    have = {c.lower() for c in df.columns}
    while stem.lower() in have:
        stem += "_"
    return stem


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
