"""Typed columns of a file from its first entry: term, date, docket and title, as one select over all collections.

Where a collection writes them is data; the select applies it, and so does day_of(), for pages that are still being read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parchment.functions import text as T
from parchment.sources.listing import FIXED_TITLES, iso_date, long_date


@dataclass(frozen=True)
class Typed:
    """Sources are fields of an entry, or row.X for the row's cell X; of several the first that says something counts.

    days: (source, form) pairs, form being short, long or head (a short date at the beginning).  cut: what is left of a
    title: revised (up to its revisions), docket (behind its docket), last (up to the last dash) or fixed (by id).
    """

    days: tuple[tuple[str, str], ...] = ()
    docket: tuple[str, str] | None = None
    title: tuple[str, ...] = ("link_text",)
    cut: str = ""
    term: str | None = "term"


_OPINION = Typed((("row.Date", "short"),), ("row.Docket", ""), cut="revised")
_ORDER = Typed((("item", "head"),))
_NEWS = Typed((("row.Date Posted", "short"), ("row.Date Posted", "long"), ("row.Date", "short"), ("row.Date", "long")), title=("link_text", "row.Subject"), term=None)
_TALK = Typed((("link_text", "long"),), term=None)
TYPED = {
    "opinions-of-the-court": _OPINION, "opinions-relating-to-orders": _OPINION, "in-chambers-opinions": _OPINION,
    "argument-transcripts": Typed((("row.Date Argued", "short"),), ("link_text", ""), ("row.Oral Argument",), "docket"),
    "orders-of-the-court": _ORDER, "orders-by-circuit": _ORDER,
    "calendars-and-lists": Typed((("link_text", "short"),), title=("item", "line", "link_text")),
    "us-reports": Typed(term="link_text"),
    "original-jurisdiction-records-and-briefs": Typed((("row.File Date", "short"),), ("group", r"^No\. [0-9]+, Orig\."), ("row.Document Title", "link_text"), term=None),
    "press-releases": _NEWS, "media-advisories": _NEWS, "speeches": _TALK, "chief-justice-year-end-reports": _TALK,
    "online-sources-cited-in-opinions": Typed(docket=("row.Case Number", "")),
    "media-files-cited-in-opinions": Typed((("row.Date", "short"),), ("row.Docket", ""), ("row.Media File", "line", "link_text"), "last"),
    "argument-audio": Typed((("row.Date", "short"), ("row.Date Argued", "short")), ("docket", ""), ("row.Case Name", "row.Case", "row.Oral Argument", "line", "link_text"), "docket"),
    "granted-noted-cases-list": Typed(), "journal": Typed(),
}
_REST = Typed(cut="fixed", term=None)
_HEAD = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}"


def day_of(collection: str, entry: dict, today: date) -> str | None:
    """An entry's date, before there are rows."""
    for source, form in TYPED.get(collection, _REST).days:
        text = (entry.get("row") or {}).get(source[4:]) if source.startswith("row.") else entry.get(source)
        if text:
            head = (re.match(_HEAD, text) or [""])[0] if form == "head" else text
            got = long_date(text) if form == "long" else iso_date(head, today)
            if got or form != "short" or not source.startswith("row.Date Posted"):
                return got
    return None


def _said(source: str) -> Column:
    return T.blank_to_null(F.col("entry.row")[source[4:]] if source.startswith("row.") else F.col(f"entry.{source}"))


def _days(t: Typed) -> tuple[Column, Column]:
    """The texts that a short and a written-out date are read from: of the first source that says something."""
    short = long = F.lit(None).cast("string")
    for source in reversed(list(dict.fromkeys(s for s, _ in t.days))):
        forms, text = {f for s, f in t.days if s == source}, _said(source)
        head = F.regexp_extract(text, _HEAD, 0) if "head" in forms else text
        short = F.when(text.isNotNull(), head if forms & {"short", "head"} else F.lit(None)).otherwise(short)
        long = F.when(text.isNotNull(), text if "long" in forms else F.lit(None)).otherwise(long)
    return short, long


def _title(t: Typed, docket: Column) -> Column:
    title = F.coalesce(*map(_said, t.title))
    if t.cut == "revised":
        before = T.blank_to_null(F.split(F.coalesce(_said("row.Name"), F.lit("")), " Revisions")[0])
        return F.when(F.coalesce(F.col("entry.line").startswith("Revisions"), F.lit(False)), before).otherwise(title)
    if t.cut == "docket":
        behind = F.trim(F.substring(title, F.length(docket) + 1, F.lit(1 << 30)))
        return T.blank_to_null(F.when(F.coalesce(F.startswith(title, docket), F.lit(False)), behind).otherwise(title))
    if t.cut == "last":
        return F.regexp_replace(title, r" - (?!.* - ).*\z", "")
    if t.cut == "fixed":
        names = F.create_map(*(F.lit(x) for pair in FIXED_TITLES.items() for x in pair))
        return F.coalesce(names[F.col("id")], title)
    return title


def _typed(t: Typed) -> Column:
    docket = F.lit(None).cast("string")
    if t.docket:
        docket = T.blank_to_null(F.regexp_extract(_said(t.docket[0]), t.docket[1], 0)) if t.docket[1] else _said(t.docket[0])
    shown = F.regexp_extract(F.coalesce(F.col("entry.link_text"), F.lit("")), r"\(([0-9]{4}) Term\b", 1)
    term = F.lit(None).cast("int") if t.term is None else F.col("entry.term") if t.term == "term" else T.blank_to_null(shown).cast("int")
    short, long = _days(t)
    return F.struct(term.alias("term"), short.alias("short"), long.alias("long"), docket.alias("docket"), _title(t, docket).alias("title"))


def typed(entries: DataFrame, today: date) -> DataFrame:
    """entries (collection, id, entry and others) with term, date, docket and title."""
    out = None
    for reading in {id(t): t for t in (*TYPED.values(), _REST)}.values():
        own = [k for k, t in TYPED.items() if t is reading]
        here = F.col("collection").isin(*own) if own else ~F.col("collection").isin(*TYPED)
        out = F.when(here, _typed(reading)) if out is None else out.when(here, _typed(reading))
    t = F.col("_typed")
    day = F.coalesce(T.iso_date(t["short"], F.lit(today)), T.long_date(t["long"]))  # dates are read once, whatever the collection
    return entries.withColumn("_typed", out).select(*entries.columns, t["term"].alias("term"), day.alias("date"), t["docket"].alias("docket"), t["title"].alias("title"))
