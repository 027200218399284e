"""Cases kept by term: only terms with a reason are built again, one commit each; the others are carried over as they are.

A term's reason comes from what its cases were built of (a digest of its source rows), the builder's version, whether it was
complete, and docket pages that are due.  Docket pages that are stored are carried over and their bytes parsed again, so a newer parser reaches
them without asking the site; those due are asked for, conditionally where they were found before.  A page that can't be had now keeps what is
stored.  A run that is cut off has committed the terms before, and the next one finds the rest with a reason still.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.functions import text as T
from parchment.operators.cases import GRANTED, OPINIONS, REPORTS, TRANSCRIPTS, attributed
from parchment.operators.grouping import line_digest
from parchment.plans.casebuild import BUILDER, NEWER, OLDER, case_rows, dockets_due, fetch_docket, rebuild_reasons, recordings
from parchment.plans.store import SnapshotStore
from parchment.plans.sync import term_order
from parchment.schema import CASES
from parchment.sources.dockets import parse_dockets
from parchment.sources.http import Blocked, Fetcher, QuotaExhausted

PAGES = "term int, docket string, url string, format string, found boolean, fetched_at string, etag string, last_modified string, html binary"
BUILT = "term int, signature string, builder int, complete boolean"


@dataclass
class Build:
    """What a run may do, and what it did: a reason for every term that was built, and docket pages asked for and failed."""

    now: str
    current_term: int
    client: Fetcher | None = None
    deadline: float = float("inf")
    clock: Callable[[], float] = time.monotonic
    built: dict[int, str] = field(default_factory=dict)
    asked: int = 0
    failed: dict[str, str] = field(default_factory=dict)
    stopped: str | None = None

    def out_of_time(self) -> bool:
        if self.clock() > self.deadline:
            self.stopped = self.stopped or "budget"
        return self.stopped is not None


def sources(spark: SparkSession, root: str) -> DataFrame:
    """Rows of all source collections, with the collection and the term whose cases they can be part of."""
    docs = None
    for name in (*OPINIONS, TRANSCRIPTS, GRANTED, REPORTS):
        part = SnapshotStore(spark, f"{root}/{name}").read().drop("file").withColumn("collection", F.lit(name))
        docs = part if docs is None else docs.unionByName(part)
    listed = F.regexp_extract("partition", r"^OT([0-9]{4})\z", 1)
    return docs.withColumn("case_term", F.when(F.col("collection").isin(GRANTED, REPORTS), F.col("term")).when(listed != "", listed.cast("int")))


def signatures(docs: DataFrame) -> DataFrame:
    """(term, signature): a digest of all of the source rows that a term's cases are built of."""
    line = F.to_json(F.struct("collection", "id", "url", "date", "docket", "title", F.sha2("entries", 256).alias("entries"), F.sha2("text", 256).alias("text"), F.sha2("ocr_text", 256).alias("ocr_text")), {"ignoreNullFields": "false"})
    return docs.where("case_term is not null").groupBy(F.col("case_term").alias("term")).agg(line_digest(line).alias("signature"))


def stored_pages(cases: DataFrame) -> DataFrame:
    """PAGES that the stored cases hold."""
    own = {"url": "docket_url", "format": "docket_format", "found": "docket_found", "fetched_at": "docket_fetched_at", "etag": "docket_etag", "last_modified": "docket_last_modified", "html": "docket_html"}
    return cases.where("docket_url is not null").select("term", "docket", *(F.col(c).alias(n) for n, c in own.items()))


def due_pages(cases: DataFrame, pages: DataFrame, run: Build) -> DataFrame:
    """(term, docket) whose page is to be asked for; a page that is stored as missing was tried under all its addresses."""
    every = F.transform(T.docket_urls("docket", NEWER, OLDER), lambda u: u["url"])
    known = pages.select("docket", "found", F.translate("fetched_at", "T", " ").alias("fetched_at"), every.alias("tried"))
    return dockets_due(cases, known, run.current_term, F.lit(run.now.replace("T", " ")).cast("timestamp_ntz"))


def ask_pages(due: DataFrame, pages: DataFrame, run: Build) -> list[tuple]:
    """Answers for a term's due dockets, in order; what fails is noted and keeps its stored page, a refusal ends the asking."""
    rows = due.join(pages.select("docket", F.struct(*[c for c in pages.columns if c != "docket"]).alias("before")), "docket", "left").withColumn("urls", T.docket_urls("docket", NEWER, OLDER))
    out = []
    for r in rows.orderBy("docket").toLocalIterator():  # politely, one after another: the site sets the pace
        if run.out_of_time():
            break
        before = r.before.asDict() | {"html": bytes(r.before.html or b"")} if r.before else None
        try:
            got = fetch_docket(run.client, [(u.format, u.url) for u in r.urls], run.now, before)
        except (Blocked, QuotaExhausted) as e:
            run.stopped = f"{type(e).__name__}: {e}"
            break
        except Exception as e:  # noqa: BLE001 - one page's failure is noted, and the next is asked for
            run.failed[r.docket] = f"{type(e).__name__}: {e}"[:300]
            continue
        run.asked += 1
        out.append((r.term, r.docket, got["url"], got["format"], got["found"], got["fetched_at"], got.get("etag"), got.get("last_modified"), bytearray(got["html"] or b"")))
    return out


def build_term(docs: DataFrame, store: SnapshotStore, term: int, run: Build, today: date) -> DataFrame:
    """A term's finished cases, written; docket pages are asked for, carried over and parsed again."""
    spark, place = store.spark, f"{store.root}/_staging/term-{uuid.uuid4().hex}"
    attributed(docs.where(F.col("case_term") == term), F.lit(today)).where(F.col("term") == term).write.parquet(f"{place}/attached")  # a long plan, read several times
    attached = spark.read.parquet(f"{place}/attached")
    cases = attached.select("term", "docket").distinct()
    pages, audio = stored_pages(store.read([f"OT{term}"])).join(cases, ["term", "docket"], "left_semi"), None
    if run.client is not None:
        answers = spark.createDataFrame(ask_pages(due_pages(cases, pages, run), pages, run), PAGES)
        answers.write.parquet(f"{place}/pages")
        answers = spark.read.schema(PAGES).parquet(f"{place}/pages")
        pages = pages.join(answers.select("term", "docket"), ["term", "docket"], "left_anti").unionByName(answers)
        heard = {r.docket for r in attached.where(F.col("collection") == TRANSCRIPTS).select("docket").distinct().collect()}  # one term's
        found = recordings(run.client, term, heard, lambda text: [d for d in heard if d in text], run.out_of_time)[0] if heard and not run.out_of_time() else {}
        audio = spark.createDataFrame([(d, x["page_url"], x["mp3_url"], x["date"]) for d, x in found.items()], "docket string, page_url string, mp3_url string, date string")
    said = parse_dockets(pages.where("found").select("url", "html", F.lit(200).alias("status")))
    case_rows(attached, pages, said, audio).write.parquet(f"{place}/rows")
    return spark.read.schema(CASES).parquet(f"{place}/rows")


def build_cases(spark: SparkSession, root: str, today: date, run: Build) -> dict:
    """Build the terms that have a reason, the current ones first, and commit each; returns the manifest."""
    store = SnapshotStore(spark, f"{root}/cases", CASES, "docket", F.concat(F.lit("OT"), F.col("term")))
    manifest, docs = store.manifest(), sources(spark, root)
    built = spark.createDataFrame([(int(k[2:]), e.get("signature"), e.get("builder"), e.get("complete")) for k, e in manifest["partitions"].items()], BUILT)
    held = store.read(manifest=manifest)
    due = due_pages(held.select("term", "docket"), stored_pages(held), run) if run.client is not None else held.select("term", "docket").limit(0)
    now = signatures(docs)
    reasons = rebuild_reasons(now, built, due).join(now, "term")
    ordered = term_order(reasons.join(built.select("term", "complete"), "term", "left"), "term", F.coalesce("complete", F.lit(False)), run.current_term)
    for r in ordered.orderBy("place").collect():  # one row a term
        if run.out_of_time():
            break
        failed = len(run.failed)
        rows = build_term(docs, store, r.term, run, today)
        whole = run.stopped is None and len(run.failed) == failed
        manifest = store.commit(rows, manifest, stamps={f"OT{r.term}": {"signature": r.signature, "builder": BUILDER, "complete": whole, "reason": r.reason, "built_at": run.now}})
        run.built[r.term] = r.reason
    return manifest
