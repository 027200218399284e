"""Plan, store, verification, cases, client and stream."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from parchment.operators import segments, verify
from parchment.operators.cases import assemble, attributed
from parchment.plans import sync
from parchment.plans.store import SnapshotStore, Superseded
from parchment.schema import DOCUMENTS, conform, differences
from parchment.sources.dockets import parse_dockets
from parchment.sources.http import Blocked, Disallowed, Fetcher, QuotaExhausted, Response, Unavailable
from parchment.streaming import sync_stream

NOW = "2026-09-27 00:00:00"


def plan(spark, units, stored, failures=(), **options):
    u = spark.createDataFrame(units, "id string, partition string, title string")
    s = spark.createDataFrame(stored, "id string, partition string, title string, listed boolean, term int")
    f = spark.createDataFrame(list(failures), "id string, attempts int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    return {r.id: r for r in sync.sync_plan(u, s, f, sync.Options(now=NOW, current_term=2025, **options)).collect()}


def test_sync_plan_says_everything_at_once(spark):
    got = plan(
        spark, [("new", "P", "t"), ("same", "P", "t"), ("moved", "Q", "t"), ("edited", "P", "u"), ("back", "P", "u"), ("wait", "P", "t"), ("again", "P", "t")],
        [("same", "P", "t", True, 2000), ("moved", "P", "t", True, 2000), ("edited", "P", "t", True, 2025), ("back", "P", "t", False, None), ("gone", "P", "t", True, 2025), ("gone before", "P", "t", False, 2025)],
        [("wait", 3, "2026-09-26 12:00:00"), ("again", 3, "2026-09-25 12:00:00")], mutable=True,
    )
    assert {k: r.action for k, r in got.items()} == {"new": "new", "same": "unchanged", "moved": "unchanged", "edited": "changed", "back": "relisted", "wait": "waiting", "again": "new", "gone": "delisted", "gone before": "unchanged"}
    assert got["moved"].partition == "P" and got["back"].update and got["back"].revalidate and got["edited"].revalidate and not got["same"].revalidate


def test_a_held_page_delists_nothing_and_a_second_run_does_nothing(spark):
    assert not plan(spark, [], [("gone", "P", "t", True, 2025)], held=True)["gone"].delist
    again = plan(spark, [("a", "P", "t")], [("a", "P", "t", True, 2000)])["a"]
    assert not any((again.fetch, again.delist, again.relist, again.update, again.revalidate))


def test_failures(spark):
    old = spark.createDataFrame([("a", "P", 2, "x"), ("b", "P", 1, "y")], "id string, partition string, attempts int, error string").withColumn("at", F.lit(NOW).cast("timestamp_ntz"))
    failed = spark.createDataFrame([("a", "P", "e" * 400), ("c", "P", "z")], "id string, partition string, error string")
    rows = {r.id: r for r in sync.after_failure(old, failed, F.lit(NOW).cast("timestamp_ntz")).collect()}
    assert (rows["a"].attempts, len(rows["a"].error), rows["b"].attempts, rows["c"].attempts) == (3, 300, 1, 1)


def test_page_spans(spark):
    df = spark.createDataFrame([("f", p, p in (2, 4), p == 6) for p in range(1, 9)] + [("g", 1, True, True)], "f string, p int, s boolean, x boolean")
    assert sorted(tuple(r) for r in segments.page_spans(df, "f", "p", "s", "x").collect()) == [("f", 2, 3), ("f", 4, 5), ("g", 1, 1)]


def document(i, partition, **more):
    return {"id": i, "partition": partition, "listed": True, "text_source": "html", "text": "t", "file": b"x", "file_sha256": "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881", "file_size": 1} | more


def test_store_commits_whole_versions(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    frame = lambda rows: conform(spark.createDataFrame([{k: v for k, v in r.items()} for r in rows], "id string, partition string, listed boolean, text_source string, text string, file binary, file_sha256 string, file_size long"), DOCUMENTS)
    base = store.manifest()
    one = store.commit(frame([document("b", "OT2020"), document("a", "OT2020"), document("c", "a/b=c")]), base)
    assert {k: v["rows"] for k, v in one["partitions"].items()} == {"OT2020": 2, "a/b=c": 1}
    with pytest.raises(Superseded):
        store.commit(frame([document("z", "OT2020")]), base)
    two = store.commit(frame([document("a", "OT2020", text="new")]), one)
    assert sorted((r.id, r.text) for r in store.read(["OT2020"]).collect()) == [("a", "new")] and store.read().count() == 2
    assert [r.id for r in store.read(["OT2020"], one).orderBy("id").collect()] == ["a", "b"]
    assert store.read().schema == DOCUMENTS and two["version"] == 2 and store.vacuum(keep=1) and store.read().count() == 2


def test_each_planted_defect_is_its_own_problem(spark):
    rows = [document("ok", "P"), document("dup", "P"), document("dup", "P"), document("null text", "P", text=None), document("stray", "Q"), document("odd", "P", text_source="x"), document("no sha", "P", file_sha256=None), document("bytes", "P", file=b"y")]
    df = spark.createDataFrame(rows, "id string, partition string, listed boolean, text_source string, text string, file binary, file_sha256 string, file_size long").withColumn("ocr_text", F.lit(None).cast("string")).withColumn("_stored_in", F.lit("P"))
    manifest = spark.createDataFrame([("P", 9, 8, None), ("Q", 1, 1, None)], "partition string, rows long, listed long, ids_sha256 string")
    found = {(r.key, r.problem) for r in verify.verify(df, manifest, deep=True).collect()}
    assert found == {
        ("dup", "id in 2 rows"), ("null text", "is html with text null and ocr_text null"), ("stray", "row with partition Q"), ("odd", "text_source x"), ("odd", "is x with text set and ocr_text null"), ("no sha", "no file_sha256"),
        ("bytes", "file_sha256 differs from the bytes"), (None, "8 rows, the manifest says 9"), (None, "in the manifest but not stored"),
    }


def test_schema_differences():
    assert differences(DOCUMENTS, DOCUMENTS) == []
    assert differences(type(DOCUMENTS)(DOCUMENTS.fields[::-1]), DOCUMENTS) == ["has the schema's columns in another order"]
    assert differences(type(DOCUMENTS)(DOCUMENTS.fields[1:]), DOCUMENTS) == ["has no column id"]


PAGES = [
    "589\n1 of 2\nPRELIMINARY PRINT", "OCTOBER TERM, 2019 132\nSyllabus\nONE v. TWO", "OCTOBER TERM, 2019 136\nPer Curiam\nSTATE v. PERSON", "OCTOBER TERM, 2019 139\nSyllabus\nTHREE v. FOUR",
    "Page Proof Pending Publication\n140 THREE v. FOUR\ndissenting", "Reporter’s Note\nnumbered 901.", "ORDERS FOR OCTOBER 7, 2019",
]


def test_attribution(spark):
    entry = lambda page, docket, name: {"page": page, "link_text": name, "row": {"Docket": docket, "Name": name, "Date": "2/25/20", "Citation": f"589 U.S. {page}"}}
    text = "".join(p + "\f" for p in PAGES)
    volume = "".join(p + "\f" for p in ["OCTOBER TERM, 2005 1\nSyllabus\nAAA v. BBB\ncertiorari to\nNo. 04–12. Argued October 3, 2005—Decided January 5, 2006\nt", "2 AAA v. BBB\nCite as: 546 U. S. 1 (2006)", "OCTOBER TERM, 2005 3\nPer Curiam\nCCC v. DDD\nNo. 04–99. Decided May 5, 2006", "ORDERS FOR X"])
    rows = [
        ("opinions-of-the-court", "pp.pdf", "OT2019", 2019, "18-1", "One v. Two", [entry(2, "18-1", "One v. Two"), entry(4, "18-2", "Three v. Four"), entry(3, "19-9", "State v. Person")], text),
        ("opinions-of-the-court", "s.pdf", "OT2019", 2019, "19-1, 19-2", "E v. F", [entry(None, "19-1, 19-2", "E v. F")] * 2, "slip *Together with No. 19–3, G v. H, on certiorari to x\f"),
        ("argument-transcripts", "t.pdf", "OT2019", 2019, "19-1", "E v. F", [], "talk\f"),
        ("us-reports", "x/546us1.pdf", "volumes-540-549", 2005, None, "Volume 546", [], volume),
        ("granted-noted-cases-list", "g.pdf", "all", 2019, None, "October Term 2019", [], "19-1 E V. F\nCourt: x\n19-77 LATER V. CASE\n"),
    ]
    docs = spark.createDataFrame([(c, i, "u", p, t, "2020-02-25", d, ti, json.dumps(e), "born_digital", x, None) for c, i, p, t, d, ti, e, x in rows], "collection string, id string, url string, partition string, term int, date string, docket string, title string, entries string, text_source string, text string, ocr_text string")
    got = attributed(docs, F.lit(date(2026, 9, 27)))
    found = {(r.term, r.docket, r.collection[:3]): r for r in got.collect()}
    assert {k: r.pages for k, r in found.items() if r.pages} == {(2019, "18-1", "opi"): [2, 2], (2019, "19-9", "opi"): [3, 3], (2019, "18-2", "opi"): [4, 5], (2005, "04-12", "us-"): [1, 2], (2005, "04-99", "us-"): [3, 3]}
    assert found[2019, "18-2", "opi"].text == PAGES[3] + "\f" + PAGES[4] + "\f" and found[2019, "18-2", "opi"].citation == "589 U.S. 4"
    assert (found[2005, "04-12", "us-"].title, found[2005, "04-12", "us-"].date, found[2005, "04-12", "us-"].citation) == ("AAA v. BBB", "2006-01-05", "546 U.S. 1")
    assert found[2019, "19-3", "opi"].title == "E v. F" and (2019, "19-77", "gra") in found
    cases = {r.docket: r for r in assemble(got).collect()}
    assert (cases["19-1"].case_name, cases["19-1"].opinions, cases["19-1"].transcripts, cases["19-77"].case_name) == ("E v. F", 1, 1, "LATER V. CASE")


def test_docket_pages(spark):
    newer = b"""<div id="pagemaindiv"><table><tr><td>No. 31A7</td></tr><tr><td>Title:</td><td>Quill &amp; Co., Applicant<br>v.<br>Harbor Board</td></tr><tr><td>Docketed:</td><td>March 3, 2031</td></tr>
    <tr><td>Linked with:</td><td>31A6</td></tr><tr><td>Lower Ct:</td><td>Court of Northmoor</td></tr><tr><td>&nbsp;&nbsp;Case Numbers:</td><td>(30-55)</td></tr><tr><td>&nbsp;&nbsp;Decision Date:</td><td>January 9, 2031</td></tr></table><a href="qp.pdf">Questions Presented</a>
    <table><tr><td>Mar 03 2031</td><td>Request lodged.<span class="documentlinks"><a href=https://h/r.pdf>Request</a></span></td></tr><tr><td>no date</td><td>x</td></tr></table><div id="Contacts">Attorneys<br>Ann Lee</div></div>"""
    older = b"<table><tr><td>No. 01-2</td></tr></table><table><tr><td>Attorneys for Petitioner:</td></tr><tr><td>~~~~</td></tr><tr><td>B. Roe&nbsp;</td></tr></table> caf\xe9"
    rows = [("https://h/d/n", newer, 200), ("https://h/o", older, 200), ("u1", b"<title>404 - Page Not Found</title>", 200), ("u2", b"x", 404)]
    got = {r.url: r for r in parse_dockets(spark.createDataFrame(rows, "url string, html binary, status int")).collect()}
    d = got["https://h/d/n"]
    assert (d.docket, d.case_name, d.docketed_date, d.linked_with, d.lower_court) == ("31A7", "Quill & Co., Applicant v. Harbor Board", "2031-03-03", "31A6", "Court of Northmoor")
    assert (d.lower_court_case_numbers, d.lower_court_decision_date, d.questions_presented_url, d.attorneys) == (["(30-55)"], "2031-01-09", "https://h/d/qp.pdf", "Ann Lee")
    assert [(p.date, p.text, [tuple(x) for x in p.documents]) for p in d.proceedings] == [("2031-03-03", "Request lodged.", [("Request", "https://h/r.pdf")])]
    o = got["https://h/o"]
    assert (o.found, o.docket, o.attorneys, o.case_name, o.proceedings) == (True, "01-2", "Attorneys for Petitioner:\nB. Roe", None, []) and "caf\u00e9" in o.text
    assert not got["u1"].found and not got["u2"].found and got["u2"].text is None


def client(*statuses, headers=None):
    left, slept, now = list(statuses), [], [0.0]

    def send(method, url, _headers):
        if left[0] == "drop":
            left.pop(0)
            raise OSError
        return Response(left.pop(0), headers or {}, b"body")

    def sleep(s):
        slept.append(s)
        now[0] += s

    return Fetcher(send=send, clock=lambda: now[0], sleep=sleep), slept


def test_client():
    f, slept = client(200, 200)
    f.request("GET", "https://h/a"), f.request("GET", "https://h/b")
    assert slept == [pytest.approx(1.1)] and f.received == 8
    with pytest.raises(Blocked):
        client(403)[0].request("GET", "https://h/a")
    with pytest.raises(Disallowed):
        client(200)[0].request("GET", "https://h/Images/a")
    with pytest.raises(ValueError, match="https"):
        client(200)[0].request("GET", "http://h/a")
    f, slept = client(429, 429, 429, headers={"retry-after": "7"})
    with pytest.raises(QuotaExhausted):
        f.request("GET", "https://h/a")
    assert slept == [7, 7]
    f, slept = client(500, "drop", 200)
    assert f.request("GET", "https://h/a").status == 200 and slept == [4, 8]
    with pytest.raises(Unavailable):
        client(*[500] * 6)[0].request("GET", "https://h/a")


def test_stream_ends_where_a_batch_does(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([(f"k{j % 4}", i * 10 + j, f"v{i}{j}") for j in range(i, 8)], "id string, seq long, v string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    kept = {}

    def write(rows, n):
        kept[n] = rows.collect()

    def read():
        return spark.createDataFrame(kept[max(kept)], "id string, seq long, v string") if kept else None

    stream = spark.readStream.schema("id string, seq long, v string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    sync_stream.run(stream, read, write, "id", "seq", f"{tmp_path}/cp").awaitTermination()
    whole = spark.read.parquet(f"{tmp_path}/in")
    assert sorted(map(tuple, kept[max(kept)])) == sorted(map(tuple, sync_stream.merge(whole.limit(0), whole, "id", "seq").collect())) and len(kept) == 3
