"""Cases by term: what is built and why, docket pages that are asked for, carried over and parsed again, and recounts by deltas."""

import hashlib
from datetime import date

from pyspark.sql import functions as F

from parchment.cli import recount
from parchment.operators.grouping import summarize
from parchment.plans import caseterms
from parchment.plans.casebuild import NEWER
from parchment.plans.caseterms import Build
from parchment.plans.recount import changed_keys
from parchment.plans.store import SnapshotStore
from parchment.schema import DOCUMENTS, conform
from parchment.sources.http import Fetcher, Response

TODAY = date(2026, 9, 27)
PAGE = "<div id='pagemaindiv'>No. {0}<br>Title: {1}<br>Docketed: March 2, 2020</div>"


def site(pages, asked):
    def send(method, url, headers):
        asked.append((url, headers.get("If-None-Match")))
        if url not in pages:
            return Response(404, {}, b"")
        if isinstance(pages[url], Response):
            return pages[url]
        tag = hashlib.sha256(pages[url]).hexdigest()[:9]
        return Response(304, {}, b"") if headers.get("If-None-Match") == tag else Response(200, {"etag": tag}, pages[url])

    return Fetcher(send=send, clock=lambda: 0.0, sleep=lambda s: None)


def opinions(spark, rows):
    made = [(i, f"OT{term}", f"https://h/{i}", term, docket, title, f"text of {i}", "born_digital", True, "application/pdf") for i, term, docket, title in rows]
    return conform(spark.createDataFrame(made, "id string, partition string, url string, term int, docket string, title string, text string, text_source string, listed boolean, media_type string"), DOCUMENTS)


def test_terms_with_a_reason_are_built(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    source = SnapshotStore(spark, f"{root}/opinions-of-the-court")
    first = source.commit(opinions(spark, [("a.pdf", 2019, "19-1", "A v. B"), ("b.pdf", 2019, "19-2", "C v. D")]), source.manifest())
    asked, pages = [], {f"{NEWER}19-1.html": PAGE.format("19-1", "Page v. Name").encode()}
    client = site(pages, asked)
    late = Build("2026-09-01T00:00:00", 2026, client, 50.0, lambda: 99.0)  # no time is left: nothing is built, nothing is lost
    assert caseterms.build_cases(spark, root, TODAY, late)["version"] == 0 and late.built == {} and late.stopped == "budget"
    run = Build("2026-09-01T01:00:00", 2026, client)
    manifest = caseterms.build_cases(spark, root, TODAY, run)
    store = SnapshotStore(spark, f"{root}/cases", caseterms.CASES, "docket", F.concat(F.lit("OT"), F.col("term")))
    assert run.built == {2019: "new"} and run.asked == 2 and not run.failed
    got = {r.docket: r for r in store.read().collect()}
    assert (got["19-1"].case_name, got["19-1"].docket_found, got["19-2"].case_name, got["19-2"].docket_found) == ("Page v. Name", True, "C v. D", False)
    # nothing is due soon after: no term is built and nothing is asked
    asked.clear()
    again = Build("2026-09-01T02:00:00", 2026, client)
    assert caseterms.build_cases(spark, root, TODAY, again) == manifest and again.built == {} and asked == []
    # a source row changes and pages grow old: one answers that it is the same and is parsed again, one can't be had and keeps what
    # is stored, so that the next run tries it again
    source.commit(opinions(spark, [("a.pdf", 2019, "19-1", "A v. B, changed"), ("b.pdf", 2019, "19-2", "C v. D")]), first)
    pages[f"{NEWER}19-2.html"] = Response(500, {}, b"")
    late = Build("2026-11-01T00:00:00", 2026, client)
    last = caseterms.build_cases(spark, root, TODAY, late)
    assert late.built == {2019: "sources"} and set(late.failed) == {"19-2"} and any(tag for _, tag in asked)
    assert last["partitions"]["OT2019"]["complete"] is False
    got = {r.docket: r for r in store.read().collect()}
    assert (got["19-1"].case_name, got["19-1"].docketed_date, got["19-1"].docket_fetched_at) == ("Page v. Name", "2020-03-02", "2026-11-01T00:00:00") and "changed" in got["19-1"].source_rows
    assert (got["19-2"].docket_found, got["19-2"].docket_fetched_at) == (False, "2026-09-01T01:00:00")


def test_recounts_read_what_changed(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    rows = [(f"{i}.pdf", 2000 + i % 3, f"{i}-1", "x") for i in range(9)]
    first = store.commit(opinions(spark, rows), store.manifest())
    assert recount(store, first).where("key = 'rows'").count() == 3 and recount(store, first).count() == 0
    second = store.commit(opinions(spark, [*rows[0:9:3], ("new.pdf", 2000, "9-9", "y")]), first)
    got = {(r.partition, r.key): (r.before, r.now) for r in recount(store, second).collect()}
    assert got[("OT2000", "rows")] == ("3", "4") and {p for p, _ in got} == {"OT2000"}
    kept = spark.read.parquet(f"{store.root}/_summaries/{second['version']:09d}")
    assert changed_keys(kept, summarize(store.read())).count() == 0  # from the last summary and the change: the full recount
