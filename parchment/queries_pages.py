"""Queries over small pages of each collection, written for this purpose: what a reading places and types, row by row."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.operators.typed import typed
from parchment.plans import casebuild
from parchment.queries import TODAY, query
from parchment.queries_more import values
from parchment.sources.dockets import parse_dockets
from parchment.sources.listing import SITE, parse_pages

DAY = date.fromisoformat(TODAY)


def _row(heads: str, *cells: str) -> str:
    return f"<table><tr>{''.join(f'<th>{h}</th>' for h in heads.split('|'))}</tr><tr>{''.join(f'<td>{c}</td>' for c in cells)}</tr></table>"


def _a(href: str, text: str) -> str:
    return f"<a href='{href}'>{text}</a>"


_FILED = "<h4>No. 17, Orig.</h4>" + _row("File Date|Document Title", "3/4/19", _a("/o/b.pdf", "Brief"))
#: (collection, term of the page, its column, rows of (id, partition, term, date, docket, title))
PAGES = [
    ("opinions-of-the-court", 2030 - 12, _row("Date|Docket|Name", "3/4/19", "18-5", _a("/op/18-5.pdf", "Hill v. Bay")), [("op/18-5.pdf", "OT2018", 2018, "2019-03-04", "18-5", "Hill v. Bay")]),
    ("opinions-relating-to-orders", 2018, _row("Date|Docket|Name", "3/5/19", "18A6", "Dale v. Fen Revisions:<br>Revisions: " + _a("/op/18a6.pdf", "3/6/19")), [("op/18a6.pdf", "OT2018", 2018, "2019-03-05", "18A6", "Dale v. Fen")]),
    ("in-chambers-opinions", None, _row("Term Year|Date|Docket|Name", "2004", "7/1/05", "04A9", _a("/ic/04a9.pdf", "Moor v. Lake")), [("ic/04a9.pdf", "OT2004", 2004, "2005-07-01", "04A9", "Moor v. Lake")]),
    ("us-reports", None, _a("/v/305us.pdf", "Volume 305 (1938 Term)") + _a("/v/how.pdf", "How to cite"), [("v/305us.pdf", "volumes-300-309", 1938, None, None, "Volume 305 (1938 Term)"), ("v/how.pdf", "other", None, None, None, "How to cite")]),
    ("online-sources-cited-in-opinions", 2018, _row("Case Number|Source", "18-5", _a("/opinions/URLs_Cited/OT2018/18-5/a.pdf", "page")), [("opinions/urls_cited/ot2018/18-5/a.pdf", "OT2018", 2018, None, "18-5", "page")]),
    ("media-files-cited-in-opinions", None, "<table><tr><td>11/3/20</td><td>19-4</td><td>" + _a("/media/video/c.mp4", "Chase - video - mp4") + "</td></tr></table>", [("media/video/c.mp4", "OT2020", 2020, "2020-11-03", "19-4", "Chase - video")]),
    ("argument-transcripts", 2018, _row("Date Argued|Oral Argument", "10/9/18", _a("/t/18-5.pdf", "18-5") + " Hill v. Bay"), [("t/18-5.pdf", "OT2018", 2018, "2018-10-09", "18-5", "Hill v. Bay")]),
    ("calendars-and-lists", None, "<li>October Term 2019 " + _a("/c/m.pdf", "Monday") + "</li><p>" + _a("/c/2018termcal.pdf", "10/1/18") + "</p>" + _a("/c/x.pdf", "Other"), [("c/m.pdf", "OT2019", 2019, None, None, "October Term 2019 Monday"), ("c/2018termcal.pdf", "OT2018", 2018, "2018-10-01", None, "10/1/18"), ("c/x.pdf", "undated", None, None, None, "Other")]),
    ("orders-of-the-court", 2018, "<ul><li>3/4/19 " + _a("/or/l.pdf", "Order List") + "</li></ul>", [("or/l.pdf", "OT2018", 2018, "2019-03-04", None, "Order List")]),
    ("orders-by-circuit", 2018, "<div style='display: block'>3/4/19 " + _a("/orders/ordercasebycircuit/l.pdf", "by Circuit") + "</div>" + _a("/orders/l2.pdf", "no"), [("orders/ordercasebycircuit/l.pdf", "OT2018", 2018, "2019-03-04", None, "by Circuit")]),
    ("granted-noted-cases-list", None, _a("/g/18.pdf", "Cases for October Term 2018"), [("g/18.pdf", "all", 2018, None, None, "Cases for October Term 2018")]),
    ("journal", None, _a("/j/95.pdf", "Journal of 1995"), [("j/95.pdf", "1990s", 1995, None, None, "Journal of 1995")]),
    ("original-jurisdiction-records-and-briefs", None, _FILED, [("o/b.pdf", "orig-017", None, "2019-03-04", "No. 17, Orig.", "Brief")]),
    ("press-releases", None, _row("Date|Subject", "3-4-19", _a("/pr/one", "A portrait")), [("pr/one", "undated", None, "2019-03-04", None, "A portrait")]),
    ("media-advisories", None, _row("Date Posted|Subject", "March 4, 2019", _a("/ma/two", "Seating")), [("ma/two", "2019", None, "2019-03-04", None, "Seating")]),
    ("speeches", None, _a("/s/a.pdf", "A talk, May 8, 2005") + _a("/s/b.pdf", "Undated talk"), [("s/a.pdf", "2005", None, "2005-05-08", None, "A talk, May 8, 2005"), ("s/b.pdf", "undated", None, None, None, "Undated talk")]),
    ("chief-justice-year-end-reports", None, _a("/y/2004.pdf", "Report of 2004"), [("y/2004.pdf", "2004", None, None, None, "Report of 2004")]),
    ("reporters-guide-to-applications", None, "any", [("publicinfo/reportersguide.pdf", "all", None, None, None, "A Reporter's Guide to Applications")]),
    ("services-for-news-media", None, _a("/publicinfo/pioservices.pdf", "here"), [("publicinfo/pioservices.pdf", "all", None, None, None, "Services for News Media")]),
    ("rules-and-guidance", None, _a("/r/2019rules.pdf", "Rules of 2019") + _a("/r/guide.pdf", "Guide") + _a("https://elsewhere.org/x.pdf", "off"), [("r/2019rules.pdf", "2019", None, None, None, "Rules of 2019"), ("r/guide.pdf", "current", None, None, None, "Guide")]),
    ("electronic-filing-documents", None, _a("/elearning/x.pdf", "course") + _a("/e/f.pdf", "Form"), [("e/f.pdf", "current", None, None, None, "Form")]),
    ("supreme-court-bar-documents", None, _a("/b/f.pdf", "Application 2021"), [("b/f.pdf", "2021", None, None, None, "Application 2021")]),
    ("about-the-court", None, "We sit. " + _a("/about/map.pdf", "Map") + _a("/visit/x.pdf", "x"), [("page", "pages", None, None, None, "We sit. Mapx"), ("about/map.pdf", "pdfs", None, None, None, "Map")]),
    ("argument-audio", 2018, _row("Date|Case", "10/9/18", _a("/oral_arguments/audio/2018/18-5", "18-5") + " Hill v. Bay"), [("media/audio/mp3files/18-5.mp3", "2018-10", 2018, "2018-10-09", "18-5", "Hill v. Bay")]),
    ("speeches", None, "", []),
]


@query(values("collection, id, partition, term, date, docket, title", *((c, *r) for c, _, _, rows in PAGES for r in rows)).replace("partition,", '"partition",').replace(" date,", ' "date",'))
def listing_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every collection's reading and typed columns."""
    pages = [(c, SITE + "/page", term, f"<div id='pagemaindiv'>{html}</div>") for c, term, html, _ in PAGES]
    found = parse_pages(spark.createDataFrame(pages, "collection string, page_url string, term int, html string"), DAY).where("id is not null")
    return typed(found, DAY).select("collection", "id", "partition", "term", "date", "docket", "title")


DOCKETS = [
    ("n", "<div id='pagemaindiv'><table><tr><td>No. 31-14</td></tr><tr><td>Title:</td><td>Hill<br>v.<br>Bay</td></tr><tr><td>Docketed:</td><td>March 3, 2031</td></tr><tr><td>Lower Ct:</td><td>Court of Fen</td></tr><tr><td>Case Nos.:</td><td>(30-1, 30-2)</td></tr></table>"
     "<table><tr><td>Mar 03 2031</td><td>Petition filed.</td></tr><tr><td>Mar 09 2031</td><td>Waiver.</td></tr></table></div>", 200, ("31-14", "Hill v. Bay", "2031-03-03", "Court of Fen", "(30-1, 30-2)", "2031-03-03: Petition filed.|2031-03-09: Waiver.")),
    ("o", "<p>No. 01-2</p>", 200, ("01-2", None, None, None, "", "")), ("m", "x", 404, (None, None, None, None, "", "")),
]


@query(values("url, docket, case_name, docketed, court, numbers, entries", *((u, *want) for u, _, _, want in DOCKETS)))
def docket_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What docket pages say, in both layouts and for a page that wasn't found."""
    pages = spark.createDataFrame([(u, h.encode(), s) for u, h, s, _ in DOCKETS], "url string, html binary, status int")
    entries = F.array_join(F.transform("proceedings", lambda p: F.concat_ws(": ", p["date"], p["text"])), "|")
    numbers = F.array_join("lower_court_case_numbers", "|")
    return parse_dockets(pages).select("url", "docket", "case_name", F.col("docketed_date").alias("docketed"), F.col("lower_court").alias("court"), numbers.alias("numbers"), entries.alias("entries"))


@query("""
with o as (select o_custkey % 30 + 1990 term, o_custkey::varchar docket, max(o_orderdate) asked, bool_or(o_orderstatus = 'F') found from orders group by all)
select term::int term, docket from o where date_diff('second', asked, timestamp '2002-01-01 00:00:00') / 3600.0 >= case when term >= 2001 then 6 when found then 168 else 720 end or (not found)""")
def cases_to_ask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases whose page is to be asked for again; a page that wasn't found has an address that wasn't tried."""
    from parchment.queries import table

    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 30 + 1990).cast("int").alias("term"), F.col("o_custkey").cast("string").alias("docket"), "o_orderdate", "o_orderstatus")
    pages = o.groupBy("docket").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("found"), F.max("o_orderdate").alias("fetched_at")).withColumn("tried", F.array().cast("array<string>"))
    return casebuild.dockets_due(o.select("term", "docket"), pages, 2002, F.lit("2002-01-01 00:00:00").cast("timestamp_ntz"))
