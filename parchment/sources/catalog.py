"""The collections: where each is listed and how its files are kept.  Data, not code."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from parchment.sources.listing import SITE, october_term

# ---- fixed values
CATEGORIES = {
    "opinions": ("Opinions", "/opinions/opinions.aspx"),
    "filing-and-rules": ("Filing & Rules", "/filingandrules/"),
    "oral-arguments": ("Oral Arguments", "/oral_arguments/oral_arguments.aspx"),
    "case-documents": ("Case Documents", "/case_documents.aspx"),
    "news-media": ("News Media", "/publicinfo/publicinfo.aspx"),
    "about": ("About", "/about/justices.aspx"),
}
ABOUT_PAGES = {
    "/about/justices.aspx": "Justices",
    "/about/courtatwork.aspx": "The Supreme Court at Work",
    "/about/code-of-conduct-for-justices.aspx": "Code of Conduct for Justices",
    "/about/historyandtraditions.aspx": "History and Traditions",
    "/about/courtbuilding.aspx": "The Supreme Court Building",
    "/about/buildingregulations.aspx": "Building Regulations",
    "/about/faq.aspx": "Frequently Asked Questions",
    "/about/faq_justices.aspx": "Frequently Asked Questions: Supreme Court Justices",
    "/about/faq_general.aspx": "Frequently Asked Questions: General Information",
    "/about/faq_documents.aspx": "Frequently Asked Questions: Locating Court Documents and Information",
}


@dataclass(frozen=True)
class Pages:
    """Listing pages: fixed ones, or one a term from first to last (None: the next term) with {yy} or {yyyy} in the path."""

    path: str
    first: int | None = None
    last: int | None = None
    ahead: int = 1

    def urls(self, today: date) -> list[tuple[str, int | None]]:
        if self.first is None:
            return [(SITE + self.path, None)]
        last = self.last if self.last is not None else october_term(today) + self.ahead
        return [(SITE + self.path.format(yy=f"{t % 100:02d}", yyyy=t), t) for t in range(self.first, last + 1)]


@dataclass(frozen=True)
class Collection:
    name: str
    title: str
    category: str
    pages: tuple[Pages, ...]
    partition_label: str = "October Term"
    mutable: bool = False
    html: bool = False

    def listing(self, today: date) -> list[tuple[str, int | None]]:
        return [x for p in self.pages for x in p.urls(today)]


def _c(name: str, title: str, category: str, *pages: Pages | str, label: str = "October Term", mutable: bool = False, html: bool = False) -> Collection:
    return Collection(name, title, category, tuple(Pages(p) if isinstance(p, str) else p for p in pages), label, mutable, html)


# ---- fixed values: names, titles and addresses of the collections
COLLECTIONS = {
    c.name: c
    for c in (
        _c("opinions-of-the-court", "Opinions of the Court", "opinions", Pages("/opinions/slipopinion/{yy}", 2017)),
        _c("opinions-relating-to-orders", "Opinions Relating to Orders", "opinions", Pages("/opinions/relatingtoorders/{yy}", 2005)),
        _c("in-chambers-opinions", "In-Chambers Opinions", "opinions", "/opinions/in-chambers.aspx"),
        _c("us-reports", "U. S. Reports", "opinions", "/opinions/USReports.aspx", label="volumes"),
        _c("online-sources-cited-in-opinions", "Online Sources Cited in Opinions", "opinions", Pages("/opinions/cited_urls/{yy}", 2005, ahead=0)),
        _c("media-files-cited-in-opinions", "Media Files Cited in Opinions", "opinions", "/media/media.aspx"),
        _c("argument-transcripts", "Argument Transcripts", "oral-arguments", Pages("/oral_arguments/archived_transcripts/{yyyy}", 1968, 1999), Pages("/oral_arguments/argument_transcript/{yyyy}", 2000)),
        _c(
            "calendars-and-lists", "Calendars and Lists", "oral-arguments", "/oral_arguments/calendarsandlists.aspx", "/oral_arguments/earliercourtcalendars.aspx", "/oral_arguments/earlierargumentcalendars.aspx",
            "/oral_arguments/earlierdaycalls.aspx", "/oral_arguments/earlierhearinglists.aspx", mutable=True,
        ),
        _c("orders-of-the-court", "Orders of the Court", "case-documents", Pages("/orders/ordersofthecourt/{yy}", 2003)),
        _c("orders-by-circuit", "Orders by Circuit", "case-documents", Pages("/orders/ordersbycircuit/{yy}", 2009), html=True),
        _c("granted-noted-cases-list", "Granted/Noted Cases List", "case-documents", "/orders/grantednotedlists.aspx", label="all", mutable=True),
        _c("journal", "Journal", "case-documents", "/orders/journal.aspx", "/orders/scannedjournals.aspx", label="decade", mutable=True),
        _c("original-jurisdiction-records-and-briefs", "Original Jurisdiction Records & Briefs", "case-documents", "/casedocuments/original_jurisdiction_cases.aspx", label="case"),
        _c("press-releases", "Press Releases", "news-media", "/publicinfo/press/pressreleases.aspx", label="year", html=True),
        _c("media-advisories", "Media Advisories", "news-media", "/publicinfo/media/mediaadvisories.aspx", label="year", html=True),
        _c("speeches", "Speeches", "news-media", "/publicinfo/speeches/speeches.aspx", label="year"),
        _c("chief-justice-year-end-reports", "Chief Justice's Year-End Reports on the Federal Judiciary", "news-media", "/publicinfo/year-end/year-endreports.aspx", label="year"),
        _c("reporters-guide-to-applications", "A Reporter's Guide to Applications", "news-media", "/publicinfo/publicinfo.aspx", mutable=True),
        _c("services-for-news-media", "Services for News Media", "news-media", "/publicinfo/publicinfo.aspx", mutable=True),
        _c("rules-and-guidance", "Rules and Guidance", "filing-and-rules", "/filingandrules/rules_guidance.aspx", "/ctrules/scannedrules.aspx", label="year or current", mutable=True),
        _c("electronic-filing-documents", "Electronic Filing Documents", "filing-and-rules", "/filingandrules/electronicfiling.aspx", label="year or current", mutable=True),
        _c("supreme-court-bar-documents", "Supreme Court Bar Documents", "filing-and-rules", "/filingandrules/supremecourtbar.aspx", label="year or current", mutable=True),
        _c("about-the-court", "About the Court", "about", *ABOUT_PAGES, label="document kind", mutable=True),
        _c("argument-audio", "Argument Audio", "oral-arguments", Pages("/oral_arguments/argument_audio/{yyyy}", 2010), label="argument month", mutable=True),
    )
}


def dimension(spark: SparkSession) -> DataFrame:
    """The catalog as a table of a fixed two dozen rows."""
    rows = [(i, c.name, c.title, c.category, CATEGORIES[c.category][0], c.partition_label, c.mutable, c.html) for i, c in enumerate(COLLECTIONS.values())]
    return spark.createDataFrame(rows, "place int, name string, title string, category string, category_title string, partition_label string, mutable boolean, html boolean")


def listing_pages(spark: SparkSession, today: date) -> DataFrame:
    """Every page to read: (collection, seq, url, term)."""
    rows = [(c.name, i, url, term) for c in COLLECTIONS.values() for i, (url, term) in enumerate(c.listing(today))]
    return spark.createDataFrame(rows, "collection string, seq int, url string, term int")
