"""python -m parchment list|run|verify|card|summarize|cases: the catalog's collections in a store folder."""

from __future__ import annotations

import argparse
import hashlib
import json
import time
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment import cards
from parchment.operators.grouping import seeded_sample, summarize
from parchment.operators.typed import day_of, typed
from parchment.operators.verify import verify
from parchment.plans import caseterms
from parchment.plans.budget import sync_in_slices, turns, waiting_order
from parchment.plans.casebuild import coverage
from parchment.plans.caseterms import Build
from parchment.plans.deepcheck import DeepCheck
from parchment.plans.recount import changed_keys, changed_partitions, recounted
from parchment.plans.runner import Run, status
from parchment.plans.store import SnapshotStore
from parchment.plans.sync import MAX_ATTEMPTS, Options, live_diff
from parchment.schema import CASES, DOCUMENTS
from parchment.session import local_session, ship
from parchment.sources.catalog import ABOUT_PAGES, COLLECTIONS, Collection
from parchment.sources.http import Fetcher
from parchment.sources.html import main_column, parse
from parchment.sources.listing import ENTRY, SITE, ListingError, october_term, rules, shown_terms, unlinked_rows

UNITS = "id string, url string, partition string, term int, date string, docket string, title string, entries string, document_type string"


def crawl(collection: Collection, client: Fetcher, today: date) -> tuple[dict[str, dict], list[tuple]]:
    """(outcome of every listing page, placed links); a page of another term is read again once, then left out."""
    rule = rules(today, {SITE + k: v for k, v in ABOUT_PAGES.items()})[collection.name]
    pages, found = {}, []

    def read(url: str, term: int | None):
        got = client.request("GET", url)
        if 300 <= got.status < 400:
            if term is None:
                raise ListingError(f"{url} redirected")
            return None, [], 0
        if got.status != 200:
            raise ListingError(f"{url} answered {got.status}")
        main = main_column(parse(got.content))
        others = sorted(shown_terms(main) - {term}) if term is not None else []
        if others:
            return [], others, 0
        placed = rule.read(main, url, term)
        if term is not None:
            days = [d for _, _, e, _ in placed if (d := day_of(collection.name, e, today))]
            terms = [october_term(date.fromisoformat(d)) for d in days]
            if terms and terms.count(term) * 2 < len(terms):
                others = sorted(set(terms) - {term})
        return placed, others, unlinked_rows(main, term, today) if not placed and collection.name.endswith("opinions-of-the-court") else 0

    for url, term in collection.listing(today):
        placed, others, unlinked = read(url, term)
        if others or unlinked:
            again, still, _ = read(url + ("&" if "?" in url else "?") + "reread=1", term)
            placed = again if again and not still else []
        pages[url] = {"term": term, "entries": len(placed or []), "redirected": placed is None} | ({"shown_term": others} if others else {}) | ({"unlinked_rows": unlinked} if unlinked else {})
        found += placed or []
    return pages, found


def units_of(spark: SparkSession, collection: Collection, found: list[tuple], today: date) -> DataFrame:
    """Files with their typed columns; a listing fits on the driver that read it page by page."""
    by: dict[str, list] = {}
    for uid, url, entry, partition in found:
        row = by.setdefault(uid, [url, partition, []])
        row[1] = min(row[1], partition)
        row[2].append(entry)
    names = [x.split(" ")[0].strip("`") for x in ENTRY.split(", ")]
    rows = [
        (collection.name, uid, url, partition, json.dumps(entries, sort_keys=True, ensure_ascii=False), entries[0].get("document_type"), {k: entries[0].get(k) for k in names})
        for uid, (url, partition, entries) in by.items()
    ]
    kind = f"collection string, id string, url string, partition string, entries string, document_type string, entry struct<{', '.join(x.replace(' ', ':', 1) for x in ENTRY.split(', '))}>"
    return typed(spark.createDataFrame(rows, kind), today).select(*(x.split(" ")[0] for x in UNITS.split(", ")))


def stored_rows(store: SnapshotStore, manifest: dict) -> DataFrame:
    """All rows with the partition whose file they lie in."""
    return store.read_placed(manifest)


#: Files that may differ between a listing and the store before it counts: the site changes while it is read.
TOLERANCE = 2


def live_problems(spark: SparkSession, rows: DataFrame, manifest: dict, units: DataFrame) -> list[dict]:
    """What the site lists now against what is stored, where more than TOLERANCE files differ."""
    given_up = spark.createDataFrame([(k,) for k, f in manifest["failures"].items() if f["attempts"] >= MAX_ATTEMPTS], "id string")
    counts = {r.kind: r["count"] for r in live_diff(units.select("id"), rows.where("listed").select("id"), given_up).groupBy("kind").count().collect()}
    return [{"scope": "live", "key": None, "problem": f"{n} files {kind}"} for kind, n in sorted(counts.items()) if kind != "missing_but_failed" and n > TOLERANCE]


def download_problems(rows: DataFrame, client: Fetcher, n: int, seed: str) -> list[dict]:
    """A seeded sample of listed files, fetched again and compared by hash; pages that change with every request aren't compared."""
    out = []
    for r in seeded_sample(rows.where("listed and media_type <> 'text/html'").select("id", "url", "file_sha256"), "id", n, seed).collect():
        data, _ = client.fetch(r.url)
        if hashlib.sha256(data).hexdigest() != r.file_sha256:
            out.append({"scope": "download", "key": r.id, "problem": "the site's bytes differ"})
    return out


def recount(store: SnapshotStore, manifest: dict) -> DataFrame:
    """(partition, key, before, now) of the summary's values that differ from the summary of the version last recounted.

    Only partitions whose files changed since are read.  The new summary is kept beside the version's files.
    """
    kept = [v for v in store.versions() if store._exists(f"_summaries/{v:09d}")]
    path = f"{store.root}/_summaries/{manifest['version']:09d}"
    if not kept:
        summarize(store.read(manifest=manifest)).write.mode("overwrite").parquet(path)
        summary = store.spark.read.parquet(path)
        return changed_keys(summary.limit(0), summary)
    old = store.spark.read.parquet(f"{store.root}/_summaries/{kept[-1]:09d}")
    if kept[-1] == manifest["version"]:
        return changed_keys(old, old)
    changed = changed_partitions(store.files(store.manifest(kept[-1])), store.files(manifest)).cache()
    names = [r.partition for r in changed.collect()]  # partition names
    recounted(old, changed, summarize(store.read(names, manifest))).write.mode("overwrite").parquet(path)
    return changed_keys(old, store.spark.read.parquet(path))


def build_cases(spark: SparkSession, root: str, today: date, run: Build | None = None) -> dict:
    """Cases of the terms that have a reason, from the stores of their source collections; a commit a term."""
    run = run or Build(now=datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S"), current_term=october_term(today))
    return caseterms.build_cases(spark, root, today, run)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="parchment")
    p.add_argument("command", choices=("list", "run", "verify", "card", "summarize", "cases"))
    p.add_argument("--dataset", action="append", choices=tuple(COLLECTIONS), help="default: all")
    p.add_argument("--store", required=True, help="a folder that driver and executors share")
    p.add_argument("--budget-minutes", type=float, default=300.0)
    p.add_argument("--reserve-minutes", type=float, default=10.0, help="run: what of the budget is kept for each collection that is still to come")
    p.add_argument("--commit-minutes", type=float, default=10.0, help="run: commit after so many minutes of asking")
    p.add_argument("--min-free-gb", type=float, default=10.0, help="run: stop asking when the store's file system has less left")
    p.add_argument("--max-units", type=int)
    p.add_argument("--partitions")
    p.add_argument("--refetch", action="store_true")
    p.add_argument("--revalidate-all", action="store_true")
    p.add_argument("--deep", action="store_true")
    p.add_argument("--live", action="store_true")
    p.add_argument("--redownload", type=int, default=0)
    p.add_argument("--seed", default="0")
    p.add_argument("--offline", action="store_true", help="cases: ask for no docket page and no recording")
    args = p.parse_args(argv)
    today, now = date.today(), datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S")
    spark, client, bad = local_session("parchment"), Fetcher(), 0
    ship(spark)
    if args.command == "cases":
        build = Build(now, october_term(today), None if args.offline else client, time.monotonic() + 60 * args.budget_minutes)
        build_cases(spark, args.store, today, build)
        print(json.dumps({"built": build.built, "asked": build.asked, "failed": build.failed, "stopped": build.stopped}))
        rows = coverage(SnapshotStore(spark, f"{args.store}/cases", CASES, "docket").read()).collect()
        print(cards.cases_card([tuple(r) for r in rows]))
        return int(build.stopped not in (None, "budget"))
    stores = {name: SnapshotStore(spark, f"{args.store}/{name}", DOCUMENTS) for name in args.dataset or COLLECTIONS}
    order = waiting_order({name: store.manifest() for name, store in stores.items()}) if args.command == "run" else list(stores)
    shares = turns(order, 60 * args.budget_minutes, 60 * args.reserve_minutes, time.monotonic) if args.command == "run" else ((name, 0.0) for name in order)
    for name, deadline in shares:
        collection, store = COLLECTIONS[name], stores[name]
        manifest = store.manifest()
        if args.command in ("list", "run") or (args.command == "verify" and args.live):
            pages, found = crawl(collection, client, today)
            units = units_of(spark, collection, found, today)
        if args.command == "list":
            counts = {r.partition: r["count"] for r in units.groupBy("partition").count().collect()}
            print(json.dumps({"collection": name, "entries": len(found), "pages": len(pages), "partitions": dict(sorted(counts.items()))}))
        elif args.command == "run":
            before = (manifest.get("listing_pages") or {}).items()
            lost = [u for u, x in before if x["entries"] and not pages.get(u, {}).get("entries")]
            explained = [u for u in lost if pages.get(u, {}).get("shown_term") or pages.get(u, {}).get("unlinked_rows")]
            if set(lost) - set(explained):
                raise ListingError(f"pages that had entries have none: {sorted(set(lost) - set(explained))[:10]}")
            run = Run(now=now, deadline=deadline, room=lambda store=store: store.free_bytes() > args.min_free_gb * 1e9, max_files=args.max_units, only=frozenset(args.partitions.split(",")) if args.partitions else None, held=bool(lost))
            options = Options(now=now.replace("T", " "), current_term=october_term(today), mutable=collection.mutable, refetch=args.refetch, revalidate_all=args.revalidate_all, held=bool(lost))
            done = sync_in_slices(store, units, client, run, options, 60 * args.commit_minutes, html=collection.html)
            print(json.dumps({"collection": name, "stopped": run.stopped, **run.counts, **status(done)}))
            bad |= run.stopped not in (None, "budget")
        elif args.command == "verify":
            entries = [(k, e["rows"], e.get("listed"), e.get("ids_sha256")) for k, e in manifest["partitions"].items()]
            stored = stored_rows(store, manifest)
            problems = verify(stored, spark.createDataFrame(entries, "partition string, rows long, listed long, ids_sha256 string"))
            if args.deep:  # reads files that no deep check has read, and tells what all have found
                check = DeepCheck(store)
                check.run(manifest, time.time() + 60 * args.budget_minutes)
                problems = problems.unionByName(check.problems(manifest))
                print(json.dumps({"collection": name, "files_read": check.checked, "files_left": check.due(manifest).count()}))
            path = f"{args.store}/{name}/_problems/{now.replace(':', '')}"
            problems.write.parquet(path)  # all of them; the shown ones are a sample
            problems = spark.read.parquet(path)
            total, rows = problems.count(), [r.asDict() for r in problems.orderBy("scope", "key", "problem").limit(100).collect()]
            rows += live_problems(spark, stored, manifest, units) if args.live else []
            rows += download_problems(stored, client, args.redownload, args.seed) if args.redownload else []
            print(json.dumps({"collection": name, "stored_problems": total, "all_in": path, "shown": rows}))
            bad |= bool(rows)
        elif args.command == "card":
            print(cards.collection_card(collection, manifest))
        else:
            for r in recount(store, manifest).collect():
                print(json.dumps({"collection": name} | r.asDict()))
    return int(bad)
