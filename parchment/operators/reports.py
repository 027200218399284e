"""Cases printed in a volume's text: captions, page spans, titles, dates and citations, as columns over pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parchment.functions import text as T
from parchment.operators.segments import page_spans

# ---- fixed values
_MONTH = "(?:" + "|".join(T.MONTHS) + ")"
NUMBER_LINE = r"^\*?Nos?\.\s"
CAPTION = r"^\*?Nos?\.\s*.{1,400}?\.\s*(?:Argued|Reargued|Submitted|Decided)\b"
HEADING = r"^(?:Syllabus|Per Curiam|Opinion in Chambers|IN CHAMBERS|(?:Supplemental |Amended |Final )?Decree|AT|(?:.* )?OCTOBER TERM,\s*[0-9]{4}(?: [0-9]+)?|.{0,60}\b[0-9]+\s*[Uu]\.\s*[Ss]\.)\z"
COURT_BELOW = r"(?i)^(?:certiorari|appeals? from|on ?(?:writ|petition|application|motion|bill|exceptions|report|certificate|remand|rehearing|appeal)|original|certificate|motion|application|petition)(?:\b|(?=for|of|to|from))"
DATED = rf"(?:Decided|entered)\s+({_MONTH}\s+[0-9]{{1,2}},\s*[0-9]{{4}})"
DATE_CHAIN = rf"(?:Decided|entered)\s+{_MONTH}\s+[0-9]{{1,2}},\s*[0-9]{{4}}(?:\s*[—–-][^—–]{{0,80}}?(?:Decided|entered)\s+{_MONTH}\s+[0-9]{{1,2}},\s*[0-9]{{4}})*"
TITLE_CHARS = (3, 300)


def _joined(lines: Column, at: Column, n: int) -> Column:
    return T.squash(F.array_join(F.slice(lines, at + 1, n), " "))


def caption_at(lines: Column) -> Column:
    """Index from 0 of the first line of a page's first caption; null without one."""
    spots = F.sequence(F.lit(0), F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.try_element_at(F.filter(spots, lambda i: F.coalesce(F.get(lines, i).rlike(NUMBER_LINE), F.lit(False)) & _joined(lines, i, 3).rlike(CAPTION)), F.lit(1))


def caption_title(lines: Column, at: Column) -> Column:
    """The case name between the nearest heading above a caption and the line that names the court below."""
    before = F.when(at > 0, F.sequence(F.lit(0), at - 1)).otherwise(F.array().cast("array<int>"))
    heading = F.array_max(F.filter(before, lambda i: F.get(lines, i).rlike(HEADING)))
    court = F.coalesce(F.array_min(F.filter(before, lambda i: (i > heading) & F.get(lines, i).rlike(COURT_BELOW))), at)
    name = T.squash(F.array_join(F.slice(lines, heading + 2, F.greatest(court - heading - 1, F.lit(0))), " "))
    name = F.regexp_replace(F.regexp_replace(name, r"\s+(?:[0-9]+\s*U\.\s*S\.|[0-9]{1,4})\z", ""), r"[*†‡ ]+\z", "")
    return F.when(heading.isNotNull() & F.length(name).between(*TITLE_CHARS), name)


def caption_date(text: Column) -> Column:
    """The last date of the first chain of dates that dashes join."""
    chain = F.regexp_extract(text, DATE_CHAIN, 0)
    last = F.try_element_at(F.regexp_extract_all(chain, F.lit(DATED), F.lit(1)), F.lit(-1))
    return T.court_date(F.regexp_replace(F.regexp_replace(last, r"\s+", " "), r",\s*", ", "))


def reports_cases(volumes: DataFrame) -> DataFrame:
    """volumes (id, url, term, title, text_source, text, ocr_text) -> one row a printed case, with its dockets and pages.

    A volume is split into pages first, so a long text is many rows of one partition and its windows see pages, not
    text: the slices are joined from pages at the end.
    """
    source = F.coalesce(F.nullif("text", F.lit("")), "ocr_text")
    v = volumes.withColumn("_pages", T.split_pages(source)).where("_pages is not null")
    keep = ["id", "url", "term", "text_source", "volume"]
    same = lambda c: F.when(F.col(c).isNotNull() & (F.col(c) != "") & (F.size(T.split_pages(c)) == F.size("_pages")), T.split_pages(c))
    v = v.withColumn("volume", T.volume_number("title", "id")).withColumn("_text", same("text")).withColumn("_ocr", same("ocr_text"))
    pages = v.select(*keep, F.posexplode("_pages").alias("_p", "_page"), "_text", "_ocr").select(
        *keep, (F.col("_p") + 1).alias("page"), "_page", F.get("_text", F.col("_p")).alias("_t"), F.get("_ocr", F.col("_p")).alias("_o"),
    ).withColumn("_stop", T.ends_opinion("_page")).withColumn("_lines", T.head_lines("_page")).withColumn("_at", F.when(~F.col("_stop"), caption_at(F.col("_lines"))))
    w = Window.partitionBy("id").orderBy("page")
    pages = pages.withColumn("_printed", T.printed_page("_page")).withColumn("_next", F.when(~F.lead("_stop").over(w), F.lead("_printed").over(w)))
    for k in (1, 2, 3):
        pages = pages.withColumn(f"_cite{k}", F.lead(T.cite_as("_page"), k).over(w))
    spans = page_spans(pages.withColumn("_start", F.col("_at").isNotNull()), "id", "page", "_start", "_stop").withColumnRenamed("id", "_id")
    heads = pages.where("_at is not null").join(spans, (F.col("id") == F.col("_id")) & (F.col("page") == F.col("first"))).drop("_id")
    number = F.when(F.col("_printed").isNull(), F.col("_next") - 1).when(F.col("_next").isNull() | (F.col("_next") == F.col("_printed") + 1), F.col("_printed"))
    cited = F.coalesce(*(F.when(F.col("first") + k <= F.col("last"), F.col(f"_cite{k}")) for k in (1, 2, 3)))
    heads = heads.select(
        *keep, "first", "last", caption_title(F.col("_lines"), F.col("_at")).alias("title"), caption_date(_joined(F.col("_lines"), F.col("_at"), 10)).alias("date"),
        T.named_dockets(F.regexp_extract(_joined(F.col("_lines"), F.col("_at"), 3), CAPTION, 0)).alias("_named"),
        F.coalesce(cited, F.when(F.col("volume").isNotNull() & (number > 0), F.concat(F.col("volume").cast("string"), F.lit(" U.S. "), number.cast("string")))).alias("citation"),
    )
    body = pages.select(F.col("id").alias("_id"), "page", "_page", "_t", "_o").join(heads.select(F.col("id").alias("_hid"), "first", "last"), (F.col("_id") == F.col("_hid")) & F.col("page").between(F.col("first"), F.col("last")))
    ordered = lambda c, most=None: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull() & (F.lit(True) if most is None else F.col("page") < F.col("first") + most), F.struct("page", F.concat(F.col(c), F.lit("\f")).alias("x"))))), lambda s: s["x"]), "")
    texts = body.groupBy("_id", "first").agg(F.when(F.count("_t") > 0, ordered("_t")).alias("text"), F.when(F.count("_o") > 0, ordered("_o")).alias("ocr_text"), ordered("_page", 2).alias("_opening"))
    out = heads.join(texts.withColumnRenamed("first", "_first"), (F.col("id") == F.col("_id")) & (F.col("first") == F.col("_first")))
    dockets = F.array_distinct(F.concat("_named", T.decided_with("_opening")))
    return out.select("id", "url", "term", "date", "title", "text_source", "text", "ocr_text", "citation", F.array(F.col("first").cast("int"), F.col("last").cast("int")).alias("pages"), dockets.alias("dockets")).where(F.size("dockets") > 0)
