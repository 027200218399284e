"""Session helpers."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

BATCH_BYTES = "8m"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Ready a session for this package: executors' Python can import it, and Python gets bounded batches.

    A record count doesn't bound a batch, as texts may be long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    folder = tempfile.mkdtemp(prefix="parchment-")
    path = os.path.join(folder, "parchment.zip")
    Path(path).write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share (spark.checkpoint.dir); a local one only where none is set on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        return "file://" + tempfile.mkdtemp(prefix=f"parchment-{name}-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_session(name: str = "parchment", cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and small jobs."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
