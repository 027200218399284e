"""The sync as a stream: each micro-batch of listing entries is planned against the stored rows and merged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def merge(state: DataFrame, batch: DataFrame, key: str, seq: str) -> DataFrame:
    """The latest row of every key: a batch's own order decides, and a batch that is replayed changes nothing."""
    both = state.unionByName(batch)
    value = F.struct(*[c for c in both.columns if c != key])
    return both.groupBy(key).agg(F.max_by(value, seq).alias("v")).select(key, "v.*")


def run(stream: DataFrame, read: Callable[[], DataFrame | None], write: Callable[[DataFrame, int], None], key: str, seq: str, checkpoint: str) -> StreamingQuery:
    """Merge every micro-batch into what read() returns, through write(rows, batch number); both are the caller's store.

    With the batch number as the commit's name a batch that is run again replaces its own result.
    """

    def each(batch: DataFrame, number: int) -> None:
        state = read()
        write(merge(state, batch, key, seq) if state is not None else merge(batch.limit(0), batch, key, seq), number)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
