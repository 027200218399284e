"""A sync run: leave out what didn't change, plan, ask politely on the driver, extract in tasks, merge, commit one version.

A partition whose units have the fingerprint of the last complete run, that has no failure and holds no file to ask
about, is neither read nor joined.  Fetched bytes are written to the store's staging area before any retryable stage
reads them, so a task that is repeated never asks the site again; a run that was cut off is taken up where it stopped, as
the next run on the same version finds its bytes.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parchment.operators.grouping import line_digest
from parchment.plans.store import SnapshotStore
from parchment.plans.sync import LEASE_MINUTES, MAX_ATTEMPTS, Options, after_failure, changed_on_server, forgotten, partition_due, retry_due, same_content, sticky, sync_plan
from parchment.schema import DOCUMENTS, conform
from parchment.sources.extract import Pdf, extract_files, poppler
from parchment.sources.http import KEPT_HEADERS, Blocked, Fetcher, QuotaExhausted

RUNS_KEPT = 20
FETCHED = "id string, file binary, etag string, last_modified string, error string"
FAILED = "id string, attempts int, at string, error string, partition string"
FATAL = (Blocked, QuotaExhausted)
#: Why a run stopped that is to commit and go on.
CHECKPOINT = "checkpoint"


class Leased(RuntimeError):
    """Another writer is at work on the dataset."""


@dataclass
class Run:
    """What a run may do, and what it did."""

    now: str
    writer: str = "local"
    deadline: float = float("inf")
    max_files: int | None = None
    only: frozenset[str] | None = None
    held: bool = False
    fetch_batch: int = 64
    clock: Callable[[], float] = time.monotonic
    counts: dict[str, int] = field(default_factory=dict)
    stopped: str | None = None
    #: Seconds of asking after which a run stops to commit, and how many runs that made.
    commit_every: float = float("inf")
    slices: int = 0
    #: Whether there is room for what is fetched.
    room: Callable[[], bool] = lambda: True


def lease_of(manifest: dict, writer: str, minutes_since: float | None) -> dict | None:
    """Another writer's lease, if it is fresh."""
    lease = manifest.get("writer") or {}
    return lease if lease.get("by") not in (None, writer) and minutes_since is not None and minutes_since < LEASE_MINUTES else None


def minutes_between(before: str | None, now: str) -> float | None:
    return (datetime.fromisoformat(now) - datetime.fromisoformat(before)).total_seconds() / 60 if before else None


def fingerprints(units: DataFrame) -> DataFrame:
    line = F.concat("id", F.lit("\t"), F.sha2("entries", 256))
    return units.groupBy("partition").agg(line_digest(line).alias("fingerprint"))


def due_partitions(now: DataFrame, stored: DataFrame, failures: DataFrame, options: Options) -> DataFrame:
    """Partitions that a run must look at: now (partition, fingerprint), stored (partition, fingerprint, complete, undated, last_term).

    All but those of equal fingerprint that are complete, without a failure whose wait is over, and without files to ask about.
    """
    at = F.lit(options.now).cast("timestamp_ntz")
    again = retry_due(failures, at).union(failures.where(F.col("attempts") < MAX_ATTEMPTS).select("partition")).distinct().withColumn("_again", F.lit(True))
    both = now.join(stored.withColumnRenamed("fingerprint", "_was"), "partition", "full_outer").join(again, "partition", "left")
    same = F.col("fingerprint").eqNullSafe(F.col("_was")) & F.coalesce("complete", F.lit(False)) & F.col("_again").isNull()
    asked = partition_due(options.mutable, options.revalidate_all, F.col("undated"), F.col("last_term"), options.current_term)
    return both.where(F.lit(options.refetch) | ~same | asked).select("partition")


def _asked(todo: Iterable[tuple[str, str]], ask: Callable[[str], tuple[bytes | None, dict]], run: Run, write: Callable[[list[tuple]], None]) -> None:
    """Ask in order, one at a time, handing over bounded batches; a refusal by the site ends the run, a bad file doesn't.

    write() renews the writer's lease, so a run that lost it stops with the next batch.
    """
    batch: list[tuple] = []
    pause, asked = run.clock() + run.commit_every, False
    for uid, url in todo:
        if run.stopped or run.clock() > run.deadline:
            run.stopped = run.stopped or "budget"
            break
        if not batch and not run.room():
            run.stopped = "no room"
            break
        if asked and run.clock() >= pause:  # after one file at least
            run.stopped = CHECKPOINT
            break
        asked = True
        try:
            data, headers = ask(url)
            batch.append((uid, data, headers.get("etag"), headers.get("last-modified"), None))
        except FATAL as e:
            run.stopped = f"{type(e).__name__}: {e}"
            break
        except Exception as e:  # noqa: BLE001 - one document's failure is recorded with it
            batch.append((uid, None, None, None, f"{type(e).__name__}: {e}"[:300]))
        if len(batch) >= run.fetch_batch:
            write(batch)
            batch = []
    if batch:
        write(batch)


def _validators(client: Fetcher, url: str) -> tuple[None, dict]:
    """The headers that tell whether a file changed, without its bytes."""
    got = client.request("HEAD", url)
    if got.status != 200:
        raise ValueError(f"status {got.status} for {url}")
    return None, {k: v for k, v in got.headers.items() if k in KEPT_HEADERS}


def changed_files(heads: DataFrame, stored: DataFrame) -> DataFrame:
    """Ids of heads (id, etag, last_modified) whose validators differ from the stored ones."""
    old = stored.select("id", F.col("etag").alias("_etag"), F.col("last_modified").alias("_modified"))
    return heads.join(old, "id").where(changed_on_server([(F.col("_etag"), F.col("etag")), (F.col("_modified"), F.col("last_modified"))])).select("id")


def sync(store: SnapshotStore, units: DataFrame, client: Fetcher, run: Run, options: Options, html: bool = False, read_pdf: Callable[[bytes], Pdf] = poppler) -> dict:
    """Bring the store up to units (id, url, partition, term, date, docket, title, entries, document_type); returns the manifest.

    Partitions without a change are neither read nor written.  Failures count on; after MAX_ATTEMPTS a file waits a day.
    """
    spark, base = store.spark, store.manifest()
    for lease in (base.get("writer") or {}, (store.leases() or [{}])[-1]):
        if lease_of({"writer": lease}, run.writer, minutes_between(lease.get("at"), run.now) if not lease.get("ended") else None):
            raise Leased(lease["by"])
    token, began = store.acquire(run.writer, run.now), run.clock()
    beat = lambda ended=False: store.renew(token, run.writer, (datetime.fromisoformat(run.now) + timedelta(seconds=run.clock() - began)).isoformat(timespec="seconds"), ended)
    failed = [(k, v["attempts"], v["at"], v["error"], v.get("partition")) for k, v in base["failures"].items()]
    failures = spark.createDataFrame(failed, FAILED)
    timed = failures.withColumn("at", F.to_timestamp_ntz("at"))
    if run.only is not None:
        units = units.join(F.broadcast(spark.createDataFrame([(x,) for x in sorted(run.only)], "partition string")), "partition", "left_semi")
    every = units
    units = sticky(units, store.read(manifest=base).select("id", "partition"))
    prints = fingerprints(units)
    known = [(k, e.get("fingerprint"), bool(e.get("complete")), e.get("undated"), e.get("last_term")) for k, e in base["partitions"].items() if run.only is None or k in run.only]
    due = [r.partition for r in due_partitions(prints, spark.createDataFrame(known, "partition string, fingerprint string, complete boolean, undated long, last_term int"), timed, options).collect()]  # partition names
    named = F.broadcast(spark.createDataFrame([(x,) for x in due], "partition string"))
    units = units.join(named, "partition", "left_semi")
    stored = store.read(due, base)
    plan = sync_plan(units, stored.drop("file"), timed, options).join(stored.select("id", "media_type", F.col("checked_at").alias("_asked")), "id", "left")
    # what this run asked for before its last commit; times are the run's own
    tried = failures.where(F.col("at") == run.now).select("id", F.lit(True).alias("_tried"))
    todo = ~(F.coalesce(F.col("_asked") == run.now, F.lit(False)) | F.coalesce("_tried", F.lit(False)))
    plan = plan.join(tried, "id", "left").withColumns({c: F.col(c) & todo for c in ("fetch", "revalidate")}).drop("_asked", "_tried").cache()
    links = units.select("id", "url")
    first = F.col("fetch") | (F.col("revalidate") & (F.lit(html) | F.coalesce(F.col("media_type") == "text/html", F.lit(False))))
    inbox, heads = (f"{store.root}/_staging/{kind}-of-{base['version']:09d}" for kind in ("inbox", "heads"))

    def ask(rows: DataFrame, path: str, how: Callable[[str], tuple[bytes | None, dict]]) -> DataFrame:
        """Ask for rows that an earlier run on this version hasn't got already."""
        spark.createDataFrame([], FETCHED).write.mode("append").parquet(path)
        had = spark.read.schema(FETCHED).parquet(path).where("error is null").select("id")
        rest = rows.join(links, "id").join(had, "id", "left_anti").select("partition", "id", "url").orderBy(F.desc("partition"), "id")
        listed = ((r.id, r.url) for r in (rest.limit(run.max_files) if run.max_files is not None else rest).select("id", "url").toLocalIterator())

        def write(batch: list[tuple]) -> None:
            spark.createDataFrame(batch, FETCHED).coalesce(1).write.mode("append").parquet(path)
            beat()

        _asked(listed, how, run, write)
        found = spark.read.schema(FETCHED).parquet(path)
        return found.where("error is null").dropDuplicates(["id"]).unionByName(found.where("error is not null").join(found.where("error is null").select("id"), "id", "left_anti").dropDuplicates(["id"]))

    if html:  # other files are asked for their headers only
        answers = spark.createDataFrame([], FETCHED)
    else:
        answers = ask(plan.where(F.col("revalidate") & ~first), heads, lambda url: _validators(client, url))
    paused = run.stopped == CHECKPOINT
    run.stopped = None if paused else run.stopped  # files found changed are fetched in the same slice, or would be asked about again
    stale = changed_files(answers.where("error is null"), stored)
    got = ask(plan.where(first).select("id", "partition").unionByName(plan.join(stale, "id").select("id", "partition")), inbox, client.fetch)
    run.stopped = run.stopped or (CHECKPOINT if paused else None)
    good = got.where("error is null").join(units, "id").withColumn("html", F.lit(html))
    extracted = f"{store.root}/_staging/text-{uuid.uuid4().hex}"
    extract_files(good, read_pdf).write.parquet(extracted)  # once: several actions read it
    text = spark.read.parquet(extracted)
    now, old = F.lit(run.now), stored.select("id", F.col("first_seen_at").alias("_first"), F.col("file_sha256").alias("_sha"), F.col("text").alias("_text"), F.col("file").alias("_file"), F.col("fetched_at").alias("_fetched"), F.col("partition").alias("_home"))
    fresh = good.join(text.where("error is null").drop("error"), "id").join(old, "id", "left").withColumn("file_sha256", F.sha2("file", 256))
    same = F.coalesce(same_content(F.col("media_type"), F.col("_text"), F.col("text"), F.col("_sha"), F.col("file_sha256")), F.lit(False))
    keep = lambda stored_one, new: F.when(same, stored_one).otherwise(new)
    fresh = fresh.select(
        *[c for c in fresh.columns if c not in ("file", "file_sha256", "partition") and not c.startswith("_")], keep(F.col("_file"), F.col("file")).alias("file"), keep(F.col("_sha"), F.col("file_sha256")).alias("file_sha256"),
        F.coalesce("_home", "partition").alias("partition"), F.lit(True).alias("listed"), F.coalesce("_first", now).alias("first_seen_at"), keep(F.col("_fetched"), now).alias("fetched_at"), now.alias("checked_at"),
        F.when(F.col("_sha").isNull(), "added").when(same, "unchanged").otherwise("replaced").alias("_what"),
    ).withColumn("file_size", F.octet_length("file").cast("long"))
    what = {r["_what"]: r["count"] for r in fresh.groupBy("_what").count().collect()}
    checked = answers.where("error is null").join(stale, "id", "left_anti").select("id", F.lit(True).alias("_checked"))
    marks = plan.select("id", "delist", "relist", "update").join(checked, "id", "left").where("delist or relist or update or _checked")
    columns = [c for c in ("url", "term", "date", "docket", "title", "entries") if c in units.columns]
    new = units.select("id", *(F.col(c).alias(f"_{c}") for c in columns))
    rest = stored.join(fresh.select("id"), "id", "left_anti").join(marks, "id").join(new, "id", "left")
    rest = rest.withColumn("listed", F.when(F.col("delist"), False).when(F.col("relist"), True).otherwise(F.col("listed"))).withColumn("delisted_at", F.when(F.col("delist"), now).when(~F.col("relist"), F.col("delisted_at")))
    rest = rest.withColumn("checked_at", F.when(F.col("_checked"), now).otherwise(F.col("checked_at")))
    for c in columns:
        rest = rest.withColumn(c, F.when(F.col("update"), F.col(f"_{c}")).otherwise(F.col(c)))
    staged = f"{store.root}/_staging/changed-{uuid.uuid4().hex}"
    conform(fresh, DOCUMENTS).unionByName(conform(rest, DOCUMENTS)).write.parquet(staged)
    changed = spark.read.schema(DOCUMENTS).parquet(staged)
    touched = [r.partition for r in changed.select("partition").distinct().collect()]  # partition names
    homes = units.select("id", "partition")
    errors = got.where("error is not null").select("id", "error").unionByName(answers.where("error is not null").select("id", "error")).unionByName(text.where("error is not null").select("id", "error")).join(homes, "id", "left")
    left = failures.join(fresh.select("id"), "id", "left_anti")
    if run.only is None:
        left = left.join(forgotten(left, every.select("id"), options.held).select("id"), "id", "left_anti")
    after = after_failure(left, errors, F.lit(run.now)).collect()  # files that failed; the manifest holds them
    run.counts = {k: 0 for k in ("added", "replaced", "unchanged")} | what | {k: plan.where(v).count() for k, v in (("delisted", "delist"), ("relisted", "relist"), ("updated", "update"))} | {"failed": errors.count(), "asked": answers.count(), "partitions": len(due)}
    run.counts["unchanged"] += checked.count()
    kept = {r.id: {"attempts": r.attempts, "error": r.error, "at": r.at, "partition": r.partition} for r in after}
    record = {"at": run.now, "writer": run.writer, "stopped": run.stopped, **run.counts}
    whole_run = run.stopped is None and run.max_files is None and not options.held
    extra = {"failures": kept, "runs": [*base["runs"][-(RUNS_KEPT - 1) :], record], "writer": {"by": run.writer, "at": run.now, "ended": True}}
    if whole_run and run.only is None:
        extra["listing"] = {"at": run.now, "count": every.count()}
    failing = {f["partition"] for f in kept.values()}
    stamps = {r.partition: {"fingerprint": r.fingerprint, "complete": whole_run and r.partition not in failing} for r in prints.collect() if r.partition in set(due)}
    whole = store.read(touched, base).join(changed.select("id"), "id", "left_anti").unionByName(changed)
    manifest = store.commit(whole, base, stamps=stamps, token=token, **extra)
    beat(ended=True)
    plan.unpersist()
    return manifest


def status(manifest: dict) -> dict:
    """What a manifest holds and where its gaps are."""
    entries, failures = manifest["partitions"].values(), manifest["failures"]
    total = lambda k: sum(e.get(k) or 0 for e in entries)
    out = {"rows": total("rows"), "listed": total("listed"), "delisted": total("rows") - total("listed"), "file_bytes": total("file_bytes"), "failures": len(failures), "given_up": sum(f["attempts"] >= MAX_ATTEMPTS for f in failures.values())}
    listing = manifest.get("listing") or {}
    out |= {"incomplete": sum(not e.get("complete") for e in entries), "stopped": (manifest.get("runs") or [{}])[-1].get("stopped")}
    # listed by the site and not stored, whether they failed or no run has reached them
    missing = max((listing.get("count") or 0) - out["listed"], 0)
    out |= {"missing": missing, "unreached": max(missing - len(failures), 0), "listed_at": listing.get("at")}
    return out | {"whole": bool(listing) and not failures and out["listed"] == listing.get("count")}
