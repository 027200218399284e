"""Whole runs against a site in memory, extraction, and the rendered cards."""

import hashlib
import sys
from datetime import date

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from parchment import cards
from parchment.cli import UNITS, build_cases, crawl, download_problems, live_problems, stored_rows, units_of
from parchment.operators.verify import verify
from parchment.plans.runner import Leased, Run, lease_of, status, sync
from parchment.plans.store import SnapshotStore
from parchment.plans.sync import Options
from parchment.sources import extract
from parchment.sources.catalog import COLLECTIONS
from parchment.sources.http import Fetcher, Response
from parchment.sources.listing import SITE

TODAY = date(2026, 9, 27)
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the executors have no tests


class Site:
    """Pages by url; counts what was asked."""

    def __init__(self, pages):
        self.pages, self.asked, self.now = pages, [], 0.0

    def client(self):
        def send(method, url, headers):
            self.asked.append((method, url))
            if url not in self.pages:
                return Response(404, {}, b"")
            data = self.pages[url]
            return data if isinstance(data, Response) else Response(200, {"etag": hashlib.sha256(data).hexdigest()[:12]}, data)

        def sleep(s):
            self.now += s

        return Fetcher(send=send, clock=lambda: self.now, sleep=sleep)


def read_pdf(data):
    return extract.Pdf(1, data.decode() + "\f", {})


def run(store, spark, site, rows, now, **options):
    units = spark.createDataFrame([(i, f"https://h/{i}", p, 2020, None, None, t, "[]", "pdf") for i, p, t in rows], UNITS)
    r = Run(now=now)
    manifest = sync(store, units, site.client(), r, Options(now=now.replace("T", " "), current_term=2025, **options), read_pdf=read_pdf)
    return r.counts, manifest, {x.id: x for x in store.read().drop("file").collect()}


def test_files_are_asked_about_by_their_headers(spark, tmp_path):
    store, site = SnapshotStore(spark, f"file://{tmp_path}/s"), Site({f"https://h/{i}": b"%PDF-" + i.encode() for i in "ab"})
    rows = [("a", "OT1", "A"), ("b", "OT1", "B")]
    run(store, spark, site, rows, "2026-09-01T00:00:00")
    site.pages["https://h/b"] = b"%PDF-changed"
    site.asked.clear()
    counts, _, stored = run(store, spark, site, rows, "2026-09-02T00:00:00", revalidate_all=True)
    assert sorted(site.asked) == [("GET", "https://h/b"), ("HEAD", "https://h/a"), ("HEAD", "https://h/b")]
    assert (counts["replaced"], counts["unchanged"], counts["asked"]) == (1, 1, 2)
    assert stored["b"].text == "%PDF-changed\f" and {r.checked_at for r in stored.values()} == {"2026-09-02T00:00:00"} and stored["a"].fetched_at == "2026-09-01T00:00:00"


def test_partitions_without_a_change_are_left_alone(spark, tmp_path):
    store, site = SnapshotStore(spark, f"file://{tmp_path}/s"), Site({f"https://h/{i}": b"%PDF-" + i.encode() for i in "abc"})
    rows = [("a", "OT1", "A"), ("b", "OT2", "B")]
    _, first, _ = run(store, spark, site, rows, "2026-09-01T00:00:00")
    counts, second, _ = run(store, spark, site, rows, "2026-09-02T00:00:00")
    assert counts["partitions"] == 0 and second["partitions"] == first["partitions"] and second["version"] == 2
    counts, third, _ = run(store, spark, site, [*rows, ("c", "OT2", "C")], "2026-09-03T00:00:00")
    assert counts["partitions"] == counts["added"] == 1 and third["partitions"]["OT1"] == first["partitions"]["OT1"] and third["partitions"]["OT2"] != first["partitions"]["OT2"]


def test_a_run_that_was_cut_off_is_taken_up(spark, tmp_path):
    store, site = SnapshotStore(spark, f"file://{tmp_path}/s"), Site({f"https://h/{i}": b"%PDF-" + i.encode() for i in "abc"})
    units = spark.createDataFrame([(i, f"https://h/{i}", "OT1", 2020, None, None, i, "[]", "pdf") for i in "abc"], UNITS)

    class Lost(RuntimeError):
        pass

    def lose(data):
        raise Lost

    real, client = store.commit, site.client()
    store.commit = lambda *_, **__: lose(None)  # the driver goes before it commits
    with pytest.raises(Lost):
        sync(store, units, client, Run(now="2026-09-01T00:00:00"), Options(now="2026-09-01 00:00:00", current_term=2025), read_pdf=read_pdf)
    store.commit, asked = real, len(site.asked)
    manifest = sync(store, units, client, Run(now="2026-09-01T01:00:00"), Options(now="2026-09-01 01:00:00", current_term=2025), read_pdf=read_pdf)
    assert len(site.asked) == asked == 3 and manifest["partitions"]["OT1"]["rows"] == 3


def test_another_writers_lease_ends_a_run(spark, tmp_path):
    store, site = SnapshotStore(spark, f"file://{tmp_path}/s"), Site({"https://h/a": b"%PDF-a"})
    _, manifest, _ = run(store, spark, site, [("a", "OT1", "A")], "2026-09-01T00:00:00")
    store.commit(store.read().limit(0), manifest, writer={"by": "other", "at": "2026-09-01T00:00:00", "ended": False})
    with pytest.raises(Leased):
        run(store, spark, site, [("a", "OT1", "A")], "2026-09-01T00:10:00")
    assert run(store, spark, site, [("a", "OT1", "A")], "2026-09-01T02:00:00")[1]["version"] == 3


def test_runs_one_after_another(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    site = Site({f"https://h/{i}": b"%PDF-" + i.encode() for i in "abc"})
    rows = [("a", "OT1", "A"), ("b", "OT1", "B"), ("c", "OT2", "C"), ("d", "OT2", "D")]
    counts, manifest, stored = run(store, spark, site, rows, "2026-09-01T00:00:00")
    assert (counts["added"], counts["failed"], set(stored)) == (3, 1, {"a", "b", "c"}) and manifest["failures"]["d"]["attempts"] == 1
    assert stored["a"].text == "%PDF-a\f" and stored["a"].text_source == "born_digital"
    asked = len(site.asked)
    counts, manifest, again = run(store, spark, site, rows, "2026-09-02T00:00:00")
    assert len(site.asked) == asked + 1 and counts["added"] == counts["replaced"] == 0 and again["a"] == stored["a"] and manifest["failures"]["d"]["attempts"] == 2
    # a row leaves the listing, another changes its title, the failed one appears
    site.pages["https://h/d"] = b"%PDF-d"
    counts, manifest, third = run(store, spark, site, [("b", "OT9", "B2"), ("c", "OT2", "C"), ("d", "OT2", "D")], "2026-09-03T00:00:00")
    assert (counts["delisted"], counts["updated"], counts["added"]) == (1, 1, 1) and not manifest["failures"]
    assert (third["a"].listed, third["a"].delisted_at, third["b"].title, third["b"].partition) == (False, "2026-09-03T00:00:00", "B2", "OT1")
    counts, _, fourth = run(store, spark, site, rows, "2026-09-04T00:00:00")
    assert counts["relisted"] == 1 and fourth["a"].listed and fourth["a"].delisted_at is None and fourth["a"].first_seen_at == "2026-09-01T00:00:00"
    # refetching finds one file changed
    site.pages["https://h/a"] = b"%PDF-new"
    counts, manifest, fifth = run(store, spark, site, rows, "2026-09-05T00:00:00", refetch=True)
    assert (counts["replaced"], counts["unchanged"]) == (1, 3) and fifth["b"].fetched_at == "2026-09-01T00:00:00" and fifth["a"].fetched_at == "2026-09-05T00:00:00"
    want = {"rows": 4, "listed": 4, "delisted": 0, "file_bytes": 8 + 3 * 6, "failures": 0, "given_up": 0, "whole": True, "incomplete": 0, "missing": 0, "unreached": 0, "stopped": None, "listed_at": "2026-09-05T00:00:00"}
    assert status(manifest) == want
    entries = [(k, e["rows"], e["listed"], e["ids_sha256"]) for k, e in manifest["partitions"].items()]
    assert verify(stored_rows(store, manifest), spark.createDataFrame(entries, "partition string, rows long, listed long, ids_sha256 string"), deep=True).count() == 0


def test_a_refusal_stops_the_run_and_keeps_what_it_has(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    site = Site({"https://h/b": b"%PDF-b", "https://h/a": Response(403, {}, b"")})
    units = spark.createDataFrame([(i, f"https://h/{i}", p, 2020, None, None, i, "[]", "pdf") for i, p in (("a", "OT1"), ("b", "OT2"))], UNITS)
    r = Run(now="2026-09-01T00:00:00")
    manifest = sync(store, units, site.client(), r, Options(now="2026-09-01 00:00:00", current_term=2025), read_pdf=read_pdf)
    assert r.stopped.startswith("Blocked") and manifest["listing"] is None and store.read().count() == 1


def test_revalidation_notices_changed_bytes(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s")
    site = Site({f"https://h/{i}": b"%PDF-" + i.encode() for i in "ab"})
    rows = [("a", "OT1", "A"), ("b", "OT2", "B")]
    run(store, spark, site, rows, "2026-09-01T00:00:00")
    site.pages["https://h/a"] = b"%PDF-new"
    counts, _, got = run(store, spark, site, rows, "2026-09-02T00:00:00", revalidate_all=True)
    assert (counts["replaced"], counts["unchanged"]) == (1, 1) and got["a"].text == "%PDF-new\f"
    assert got["b"].checked_at == "2026-09-02T00:00:00" and got["b"].fetched_at == "2026-09-01T00:00:00"


def test_lease():
    held = {"writer": {"by": "other", "at": "x"}}
    assert lease_of(held, "me", 10) and not lease_of(held, "me", 50) and not lease_of(held, "other", 10) and not lease_of({}, "me", None)


def test_crawl(spark):
    row = "<tr><td>{}</td><td>{}</td><td><a href='/o/{}.pdf'>A v. B</a></td></tr>"
    page = lambda term, *rows: f"<div id='pagemaindiv'>Term Year: {term}<table><tr><th>Date</th><th>Docket</th><th>Name</th></tr>{''.join(rows)}</table></div>".encode()
    base = SITE + "/opinions/slipopinion/"
    pages = {f"{base}{y}": Response(302, {}, b"") for y in range(17, 28)}
    pages |= {f"{base}20": page(2020, row.format("10/5/20", "20-1", "x"), row.format("6/1/21", "20-2", "y")), f"{base}21": page(2025), f"{base}21?reread=1": page(2021, row.format("11/1/21", "21-1", "z")), f"{base}22": page(2022, row.format("11/1/23", "1", "w"))}
    pages[f"{base}22?reread=1"] = pages[f"{base}22"]
    outcome, found = crawl(COLLECTIONS["opinions-of-the-court"], Site(pages).client(), TODAY)
    assert [(x[0], x[3]) for x in found] == [("o/x.pdf", "OT2020"), ("o/y.pdf", "OT2020"), ("o/z.pdf", "OT2021")]
    assert outcome[f"{base}22"]["entries"] == 0 and outcome[f"{base}22"]["shown_term"] == [2023] and outcome[f"{base}17"]["redirected"]
    rows = {r.id: r for r in units_of(spark, COLLECTIONS["opinions-of-the-court"], found, TODAY).collect()}
    assert (rows["o/x.pdf"].date, rows["o/x.pdf"].docket, rows["o/x.pdf"].term) == ("2020-10-05", "20-1", 2020)


def test_extraction(spark):
    assert extract.classify(["a", " ", "b"], {1: 0.6, 2: 0.9}) == ("mixed", 2, 1) and extract.classify(["", ""], {}) == ("no_text", 0, 0) and extract.classify(["a"], {1: 0.5}) == ("scanned", 1, 1)
    assert extract.compare("a b", "ab") == (True, True, 0) and extract.compare("ﬁx", "fix") == (False, True, 0) and extract.compare("ab", "abcc") == (False, False, 2)
    for bad in (b"<html>", b""):
        with pytest.raises(extract.WrongKind):
            extract.pdf(bad, read_pdf)
    with pytest.raises(ValueError, match="form feeds"):
        extract.pdf(b"%PDF-", lambda d: extract.Pdf(2, "x\f", {}))
    got = extract.pdf(b"%PDF-x", lambda d: extract.Pdf(1, "ab\f", {}, other_text="a b"))
    assert (got["text"], got["xcheck_equal"], got["xcheck_delta"]) == ("ab\f", True, 0)
    assert extract.page(b"<div id='pagemaindiv'><p>Text</p></div>")["text"] == "Text"
    files = spark.createDataFrame([("a", b"ID3..", "audio", False), ("b", b"xxxx", "video", False), ("c", b"%PDF-", "pdf", False)], "id string, file binary, document_type string, html boolean")
    rows = {r.id: r for r in extract.extract_files(files, read_pdf).collect()}
    assert rows["a"].media_type == "audio/mpeg" and "MP4" in rows["b"].error and rows["c"].text_source == "born_digital"
    made = spark.createDataFrame([(["a", " ", "b"], [0.6, 0.9, None])], "p array<string>, c array<double>").select(extract.classified(F.col("p"), F.col("c")).alias("x")).first().x
    assert tuple(made) == ("mixed", 2, 1)


def test_cards():
    manifest = {"partitions": {"OT2020": {"rows": 2, "listed": 1, "file_bytes": 10}}, "failures": {"x.pdf": {"attempts": 3, "error": "a|b"}}, "listing": {"at": "t", "count": 1}}
    text = cards.collection_card(COLLECTIONS["journal"], manifest)
    assert "2 rows, of which 1 are listed" in text and "| x.pdf | 3 | a/b |" in text and "n<1K" in text
    assert "| Journal | 2 | 1 | incomplete |" in cards.category_card("case-documents", {"journal": manifest}) and "not started" in cards.category_card("about", {})
    assert cards.cases_card([(2020, 1, 1, 1, 0, 0), (None, 1, 1, 1, 0, 0)]).splitlines()[-1].startswith("| all | 1")
    assert cards.code_points({"private_use": 0, "private_use_rows": 0, "replacement": 2, "replacement_rows": 1}) == "1 row with 2 replacement characters."


def test_live_checks_hashes_and_cases(spark, tmp_path):
    root = f"file://{tmp_path}/r"
    store = SnapshotStore(spark, f"{root}/argument-transcripts")
    site = Site({f"https://h/{i}": b"%PDF-" + i.encode() for i in "abcd"})
    rows = [(i, "OT2019", f"Case {i}") for i in "abcd"]
    _, manifest, _ = run(store, spark, site, rows, "2026-09-01T00:00:00")
    stored = stored_rows(store, manifest)
    units = lambda ids: spark.createDataFrame([(i,) for i in ids], "id string")
    assert live_problems(spark, stored, manifest, units("abcd")) == [] == live_problems(spark, stored, manifest, units("bcde"))
    assert live_problems(spark, stored, manifest, units("axyz")) == [{"scope": "live", "key": None, "problem": "3 files extra"}, {"scope": "live", "key": None, "problem": "3 files missing"}]
    assert download_problems(stored, site.client(), 9, "s") == []
    site.pages["https://h/b"] = b"%PDF-other"
    assert [p["key"] for p in download_problems(stored, site.client(), 9, "s")] == ["b"]
    assert store.files().count() == store.hashes().count() >= 1
    dockets = store.read().withColumn("docket", F.concat(F.lit("19-"), F.ascii("id")))
    store.commit(dockets, manifest)
    built = build_cases(spark, root, TODAY)
    assert built["partitions"]["OT2019"]["rows"] == 4 and built["version"] == 1
