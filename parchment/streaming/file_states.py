"""Listings as a stream with a state for each file, instead of a join of everything with everything in each run.

Events say that a file was listed in a run (each link to it), that a run's listing ended, that a file was fetched and stored,
or that asking for it failed.  When a listing ends, every file's state says what to do about it, by the rules of
parchment.plans.sync.sync_plan: fetch or skip, delist, relist, update.  A listing that is held has no end, so it delists nothing.

Files are dealt by a hash of their id to buckets, which are the stream's keys; a bucket's files are a map in the state store, so
an end of a listing is a row for each bucket.  A task holds one bucket's events of a batch, and at an end one bucket's states:
buckets grow with the number of files, and batches are bounded by the source's options.  Calls to the state store are messages to the
JVM, so a batch in which listings end reads a bucket's files in one go, and writes each that changed once, however many runs it
holds.  The state holds files that are stored or listed: others are forgotten with their failures.  A file that isn't stored and failed
MAX_ATTEMPTS times waits; a bucket has a timer for the wait that is over first, and when it expires, a "retry" says for each wait that
is over, whether or not a listing came.  Timers follow the clock and not a watermark, which would drop late rows.

Order: events are put in order within a batch (run, then links, the end, outcomes).  Between batches a run's links may come
after its end and are then acted on as they come; of an earlier run than the last that ended, they only say that the file was seen.
A run's end that comes again changes nothing.  Outcomes hold for the file from when they come.

Edge cases: events without an id or a kind that isn't known are left out (an end needs no id); a file without a partition has a null
one; outcomes of files that were never listed are kept until the next listing ends, stored files for good.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from parchment.plans.sync import MAX_ATTEMPTS, RETRY_HOURS

LISTED, ENDED, STORED, FAILED = "listed", "ended", "stored", "failed"
EVENTS = "kind string, run long, seq long, at timestamp, id string, partition string, line string"
ACTIONS = "id string, partition string, run long, at timestamp, action string"
BUCKETS = 256
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_COLUMNS = ("kind", "run", "seq", "us", "id", "partition", "line")
_TOLD = "id string, partition string, run long, us long, action string"
_ROW = {"id": object, "partition": object, "run": "int64", "us": "int64", "action": object}
_ORDER = {LISTED: 0, ENDED: 1, STORED: 2, FAILED: 2}
_FILE = "run long, first long, place string, line string, home string, kept string, known boolean, listed boolean, attempts int, failed_at long"
_RETRY_MS = RETRY_HOURS * 3_600_000
_FRAME = 10_000


class File(NamedTuple):
    """The last run that listed a file with its least partition and first link there, and what is stored of it."""

    run: int = -1
    first: int | None = None
    place: str | None = None
    line: str | None = None
    home: str | None = None
    kept: str | None = None
    known: bool = False
    listed: bool = False
    attempts: int = 0
    failed_at: int | None = None

    def seen(self, run: int, seq: int, place: str | None, line: str | None) -> File:
        """With a link; links of a run may come in any order."""
        if run < self.run:
            return self
        if run > self.run:
            return self._replace(run=run, first=seq, place=place, line=line)
        least = min((p for p in (self.place, place) if p is not None), default=None)
        return self._replace(place=least, **({"first": seq, "line": line} if self.first is None or seq < self.first else {}))

    def waiting(self, at: int) -> bool:
        return self.attempts >= MAX_ATTEMPTS and self.failed_at is not None and self.failed_at + _RETRY_MS > at

    def place_told(self) -> str | None:
        """The partition that holds the file, or the one that it is listed in."""
        return self.home if self.home is not None else self.place

    def settled(self, run: int, at: int) -> tuple[File | None, list[str]]:
        """(state, actions) when the run's listing has ended; no state where there is nothing left to know."""
        live = self.run == run
        if not self.known:
            return (self, ["skip" if self.waiting(at) else "fetch"]) if live else (None, [])
        if not live:
            return self._replace(listed=False, attempts=0, failed_at=None), ["delist"] if self.listed else []
        what = ([] if self.listed else ["relist"]) + (["update"] if self.line != self.kept else [])
        return self._replace(listed=True, kept=self.line), what


def _order(event: tuple) -> tuple:
    kind, run, seq, _, uid, *_ = event
    return run, _ORDER[kind], seq, uid or ""


def _frame(told: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series(v, dtype=t) for (c, t), v in zip(_ROW.items(), zip(*told, strict=True) if told else [()] * len(_ROW), strict=True)})


class FileStates(StatefulProcessor):
    """One bucket of files."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.files = handle.getMapState("files", "id string", _FILE)
        self.ended = handle.getValueState("ended", "run long, at timestamp")
        self.waits = handle.getMapState("waits", "id string", "until long")
        self.due = handle.getValueState("due", "until long")

    def _get(self, uid: str) -> File | None:
        got = self.files.getValue((uid,))
        return File(*got) if got is not None else None

    def _put(self, uid: str, old: File | None, new: File | None) -> None:
        if new == old:
            return
        if new is None:
            self.files.removeKey((uid,))
        else:
            self.files.updateValue((uid,), tuple(new))

    def _wake(self, until: int) -> None:
        """A bucket has one timer, for the wait that is over first."""
        due = self.due.get()
        if due is not None and due[0] <= until:
            return
        if due is not None:
            self.handle.deleteTimer(due[0])
        self.handle.registerTimer(until)
        self.due.update((until,))

    def _last(self) -> tuple[int, int | None]:
        """The last run that ended, and when (in microseconds)."""
        last = self.ended.get()
        return (last[0], round(last[1].timestamp() * 1_000_000)) if last is not None else (-1, None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - the interface's names
        before = run, at = self._last()
        # frames and not rows: Spark takes some 100 microseconds to make a Row of each event
        events = sorted((e for part in rows for e in zip(*(part[c].tolist() for c in _COLUMNS), strict=True)), key=_order)
        # each call to the store is a message to the JVM: files are read once and written once in a batch, however many runs end in it
        whole = any(e[0] == ENDED and e[1] > run for e in events)
        files: dict[str, File | None] = {uid: File(*value) for (uid,), value in self.files.iterator()} if whole else {}
        stored, waits, told = dict(files), {}, []

        for kind, of, seq, when, uid, partition, line in events:
            if kind == ENDED:
                if of <= run:
                    continue
                run, at = of, when
                for uid, old in files.items():
                    if old is not None:
                        files[uid], what = old.settled(run, at // 1000)
                        told += ((uid, old.place_told(), run, at, action) for action in what)
                if len(told) >= _FRAME:
                    yield _frame(told)
                    told = []
                continue
            if uid not in files:
                files[uid] = stored[uid] = None if whole else self._get(uid)
            now = files[uid] or File()
            if kind == LISTED:
                seen_in, now = now.run, now.seen(of, seq, partition, line)
                if of == run:  # after its end
                    if now.known:
                        now, what = now.settled(run, at // 1000)
                    else:
                        what = [] if seen_in == run else now.settled(run, at // 1000)[1]
                    told += ((uid, now.place_told(), run, at, action) for action in what)
            elif kind == STORED:
                live = now.run == run >= 0
                now = now._replace(known=True, listed=live, kept=now.line if live else now.kept, home=now.home if now.home is not None else partition, attempts=0, failed_at=None)
                waits.pop(uid, None)
            else:
                now = now._replace(attempts=now.attempts + 1, failed_at=when // 1000)
                if now.attempts >= MAX_ATTEMPTS and not now.known:  # stored files are asked for without a wait
                    waits[uid] = now.failed_at + _RETRY_MS
            files[uid] = now
        for uid, new in files.items():
            self._put(uid, stored[uid], new)
        for uid, until in waits.items():
            self.waits.updateValue((uid,), (until,))
        if waits:
            self._wake(min(waits.values()))
        if (run, at) != before:
            self.ended.update((run, datetime.fromtimestamp(at // 1_000_000).replace(microsecond=at % 1_000_000)))
        yield _frame(told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now, (run, at), told = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentProcessingTimeInMs()), self._last(), []
        self.due.clear()
        waits = [(uid, until) for (uid,), (until,) in self.waits.iterator()]
        for uid, until in waits:
            if until > now:
                continue
            self.waits.removeKey((uid,))
            file = self._get(uid)
            # a later failure has its own wait
            if at is not None and file is not None and not file.known and file.run == run and file.attempts >= MAX_ATTEMPTS and file.failed_at + _RETRY_MS == until:
                told.append((uid, file.place_told(), run, at, "retry"))
        left = [until for _, until in waits if until > now]
        if left:
            self._wake(min(left))
        yield _frame(told)

    def close(self) -> None:
        pass


def actions(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """What to do about which file (ACTIONS), from a stream of EVENTS.  The number of buckets must stay as long as the checkpoint does."""
    known = events.where(F.col("kind").isin(*_ORDER) & F.col("run").isNotNull() & F.col("at").isNotNull() & ((F.col("kind") == ENDED) | F.col("id").isNotNull()))
    own = F.array(F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    dealt = known.withColumn("bucket", F.explode(F.when(F.col("kind") == ENDED, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(own)))
    numbered = dealt.select("bucket", "kind", "run", F.coalesce("seq", F.lit(-1)).alias("seq"), F.unix_micros("at").alias("us"), "id", "partition", "line")
    told = numbered.groupBy("bucket").transformWithStateInPandas(FileStates(), _TOLD, "Append", "ProcessingTime")
    return told.select("id", "partition", "run", F.timestamp_micros("us").alias("at"), "action")


def run(events: DataFrame, out: str, checkpoint: str, buckets: int = BUCKETS, every: str | None = None) -> StreamingQuery:
    """Append the actions of what has come to Parquet files in out, each once; a query that is started again goes on from the checkpoint.

    With every (as "1 minute") it goes on until it is stopped, and timers expire without events; else it ends when all that has come
    is done, and timers expire with a later batch (batches without data would follow each other for ever).
    """
    conf = events.sparkSession.conf
    needed = {"spark.sql.streaming.stateStore.providerClass": STORE, "spark.sql.streaming.noDataMicroBatches.enabled": str(every is not None).lower()}
    before = {k: conf.get(k, None) for k in needed}
    for k, v in needed.items():
        conf.set(k, v)
    try:  # a query keeps the settings that it was started with
        writer = actions(events, buckets).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start(out)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(id, and the columns of its state) of every file that the stream knows, as a table."""
    got = spark.read.format("statestore").option("stateVarName", "files").load(checkpoint)
    return got.select("user_map_key.id", "user_map_value.*")
