"""Cases from documents: all terms at once, three stages of attribution, each tested against those before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parchment.functions import text as T
from parchment.operators.attribution import consolidated, fallback
from parchment.operators.grouping import first_most_common
from parchment.operators.reports import reports_cases

# ---- fixed values
OPINIONS = ("opinions-of-the-court", "opinions-relating-to-orders", "in-chambers-opinions")
TRANSCRIPTS, GRANTED, REPORTS = "argument-transcripts", "granted-noted-cases-list", "us-reports"
#: Collections whose opinion of a case makes the printed volumes unnecessary.
STRONG = ("opinions-of-the-court", "in-chambers-opinions")
#: The first term whose captions print a docket's year.
YEAR_DOCKETS = 1971

ENTRIES = "array<struct<page:int,row:map<string,string>,link_text:string>>"
ATTACHED = ["term", "docket", "seq", "collection", "id", "url", "date", "title", "text_source", "text", "ocr_text", "citation", "pages"]


def _cell(entry: Column, name: str) -> Column:
    return T.blank_to_null(T.squash(F.try_element_at(entry["row"], F.lit(name))))


def _slice(pages: Column, stops: Column, first: Column, following: Column) -> Column:
    """struct<text, pages>: pages from first to before the next start or first stop page; null where there are none."""
    n = F.size(pages)
    last = F.least(F.coalesce(following - 1, n), n)
    inner = F.when(first + 1 <= last, F.sequence(first + 1, last)).otherwise(F.array().cast("array<int>"))
    last = F.coalesce(F.array_min(F.filter(inner, lambda p: F.get(stops, p - 1))) - 1, last)
    text = F.array_join(F.transform(F.slice(pages, first, F.greatest(last - first + 1, F.lit(0))), lambda p: F.concat(p, F.lit("\f"))), "")
    return F.when(pages.isNotNull() & first.isNotNull() & (first <= last), F.struct(text.alias("text"), F.array(first, last).alias("pages")))


def attributed(docs: DataFrame, today: Column) -> DataFrame:
    """docs (collection, id, url, partition, term, date, docket, title, entries, text_source, text, ocr_text) -> ATTACHED rows.

    Files are keyed by (collection, id, partition); page arrays are made only for files that hold several opinions.
    """
    listed_term = F.regexp_extract("partition", r"^OT([0-9]{4})\z", 1)
    d = docs.withColumn("_term", F.when(listed_term != "", listed_term.cast("int"))).withColumn("_entries", F.from_json("entries", ENTRIES)).withColumn("_seq", F.xxhash64("collection", "id"))
    own_docket = lambda e: F.when(_cell(e, "Docket").isNotNull(), T.row_dockets(_cell(e, "Docket"), F.lit(""))).otherwise(F.array().cast("array<string>"))

    granted = d.where(F.col("collection") == GRANTED).select("term", F.posexplode(T.granted_titles(F.coalesce(F.nullif("text", F.lit("")), "ocr_text"))).alias("seq", "g"), "collection", "id", "url", "text_source")
    granted = granted.select("term", F.col("g.docket").alias("docket"), "seq", "collection", "id", "url", F.lit(None).cast("string").alias("date"), F.col("g.title").alias("title"), "text_source", *(F.lit(None).cast("string").alias(c) for c in ("text", "ocr_text", "citation")), F.lit(None).cast("array<int>").alias("pages"))

    listed = d.where(F.col("collection").isin(*OPINIONS, TRANSCRIPTS) & F.col("_term").isNotNull())
    key = ["_term", "collection", "id"]
    entries = listed.where(F.col("collection").isin(*OPINIONS)).select(*key, F.posexplode("_entries").alias("_pos", "_entry")).withColumn("_dockets", own_docket(F.col("_entry")))
    several = entries.where(F.size("_dockets") > 0).groupBy(*key).agg(F.count_distinct("_dockets").alias("_n")).where("_n > 1").select(*key)
    starts = entries.where((F.size("_dockets") > 0) & F.col("_entry.page").isNotNull()).groupBy("_term", "id").agg(F.sort_array(F.collect_set("_entry.page")).alias("_starts"))

    one = entries.join(several, key, "left_semi").select(*key, "_pos", "_entry", F.explode("_dockets").alias("docket"))
    one = one.withColumn("_k", F.row_number().over(Window.partitionBy(*key, "docket", "_entry.page").orderBy("_pos"))).where("_k = 1")
    files = listed.join(several, key, "left_semi").select(*key, "url", "date", "title", "text_source", *(T.split_pages(F.nullif(c, F.lit(""))).alias(f"_{c}") for c in ("text", "ocr_text")))
    for c in ("_text", "_ocr_text"):
        files = files.withColumn(f"{c}_stops", F.transform(c, T.ends_opinion))
    part = one.join(files, key).join(starts, ["_term", "id"], "left")
    first, following = F.col("_entry.page"), F.array_min(F.filter("_starts", lambda s: s > F.col("_entry.page")))
    part = part.withColumn("_t", _slice(F.col("_text"), F.col("_text_stops"), first, following)).withColumn("_o", _slice(F.col("_ocr_text"), F.col("_ocr_text_stops"), first, following))
    entry = F.col("_entry")
    shared = part.select(
        F.col("_term").alias("term"), T.normalize_docket("docket").alias("docket"), F.col("_pos").alias("seq"), "collection", "id", "url", F.coalesce(T.iso_date(_cell(entry, "Date"), today), "date").alias("date"),
        F.coalesce(_cell(entry, "Name"), T.blank_to_null(T.squash(entry["link_text"])), "title").alias("title"), "text_source", F.col("_t.text").alias("text"), F.col("_o.text").alias("ocr_text"), _cell(entry, "Citation").alias("citation"), F.coalesce("_o.pages", "_t.pages").alias("pages"),
    )

    named = T.row_dockets("docket", "id")
    whole = listed.join(several, key, "left_anti").withColumn("_dockets", F.when(F.size(named) > 0, named).otherwise(T.docket_candidates("entries")))
    cited = F.when(F.col("collection").isin(*OPINIONS), F.try_element_at(F.array_compact(F.transform("_entries", lambda e: _cell(e, "Citation"))), F.lit(1)))
    whole = whole.select(F.col("_term").alias("term"), F.posexplode("_dockets").alias("seq", "_d"), "collection", "id", "url", "date", "title", "text_source", "text", "ocr_text", cited.alias("citation"), F.lit(None).cast("array<int>").alias("pages")).withColumn("docket", T.normalize_docket("_d"))
    step1 = granted.select(*ATTACHED).unionByName(shared.select(*ATTACHED)).unionByName(whole.select(*ATTACHED))

    # cases that an opinion's first pages say were decided with its own; read once, so it doesn't go on from those
    held = step1.where(~F.col("collection").isin(GRANTED, TRANSCRIPTS)).withColumn("_case", F.concat_ws("|", "term", "docket"))
    opening = T.first_pages(F.coalesce(F.nullif("text", F.lit("")), "ocr_text"))
    others = held.select("term", "_case", "id", "pages", F.explode(T.decided_with(opening)).alias("_other")).withColumn("_to", F.concat_ws("|", "term", "_other"))
    extra = consolidated(held, others, "_case", "_to", ["id", "pages"])
    body = held.drop("_case", "docket").dropDuplicates(["term", "id", "pages"])
    extra = extra.select(F.split_part("_case", F.lit("|"), F.lit(1)).cast("int").alias("term"), F.split_part("_case", F.lit("|"), F.lit(2)).alias("docket"), F.col("id").alias("_i"), F.col("pages").alias("_p"))
    body = body.withColumnRenamed("term", "_t")
    step2 = extra.join(body, (extra["term"] == body["_t"]) & (extra["_i"] == body["id"]) & extra["_p"].eqNullSafe(body["pages"])).select(*ATTACHED)
    both = step1.unionByName(step2)

    # the printed volumes, for cases with no opinion of their own
    printed = reports_cases(d.where((F.col("collection") == REPORTS) & F.col("term").isNotNull()).select("id", "url", "term", "title", "text_source", "text", "ocr_text"))
    printed = printed.withColumn("seq", F.lit(0)).select("*", F.explode("dockets").alias("docket"), F.lit(REPORTS).alias("collection"))
    printed = printed.where(T.docket_in_term("docket", "term") & ((F.col("term") >= YEAR_DOCKETS) | F.col("docket").endswith("Orig."))).select(*ATTACHED)
    opinions = both.where(~F.col("collection").isin(GRANTED, TRANSCRIPTS))
    step3 = fallback(printed, opinions, ["term", "docket"], ["id", "pages"], F.col("collection").isin(*STRONG)).dropDuplicates(["term", "docket", "id", "pages"])
    return both.unionByName(step3)


def assemble(attached: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """One row for each (term, docket): sources, title, and how many documents of each kind; pages adds docket pages' names.

    A title comes from the docket page, else the commonest of the listings (the first of equals), else the commonest of
    the capital-letter lists.
    """
    key = ["term", "docket"]
    order = F.struct(F.col("collection"), F.col("id"), F.col("seq"))
    rows = attached.withColumn("_order", order)
    low = F.col("collection").isin(GRANTED, REPORTS)
    count = lambda test: F.count_if(test)
    cases = rows.groupBy(*key).agg(
        F.sort_array(F.collect_set("collection")).alias("sources"),
        count(~F.col("collection").isin(GRANTED, TRANSCRIPTS)).alias("opinions"),
        count(F.col("collection") == TRANSCRIPTS).alias("transcripts"),
        F.array_sort(F.collect_list(F.struct("collection", "id", "date", "title"))).alias("source_rows"),
    )
    for name, test in (("_title", ~low), ("_listed", low)):
        best = first_most_common(rows.where(test).select(*key, F.col("title").alias(name), "_order"), key, name, "_order").drop("n")
        cases = cases.join(best, key, "left")
    if pages is None:
        return cases.withColumn("case_name", F.coalesce("_title", "_listed")).drop("_title", "_listed")
    cases = cases.join(pages.select(*key, F.col("case_name").alias("_page_name")), key, "left")
    return cases.withColumn("case_name", F.coalesce("_page_name", "_title", "_listed")).drop("_title", "_listed", "_page_name")
