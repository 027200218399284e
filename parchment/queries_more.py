"""More queries over the driver tables: scalar functions, predicates, merges and the printed-page operators.

Operators whose inputs no driver table resembles run over constants, and their SQL states what must come out.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.functions import text as T
from parchment.operators import cases, grouping, verify
from parchment.operators.reports import reports_cases as printed_cases
from parchment.plans import casebuild, sync
from parchment.queries import TODAY, query, table
from parchment.sources import catalog, extract


def _sql(v) -> str:
    if isinstance(v, list):
        return "[" + ", ".join(map(_sql, v)) + "]"
    return "null" if v is None else str(v) if isinstance(v, (int, bool)) else "'" + v.replace("'", "''") + "'"


def values(columns: str, *rows: tuple) -> str:
    """SQL of a constant table."""
    return f"select * from (values {', '.join('(' + ', '.join(map(_sql, r)) + ')' for r in rows)}) t({columns})"


# ---- sources


@query("""
with c(collection, path, lo, hi) as (values ('opinions-of-the-court', '/opinions/slipopinion/{yy}', 2017, 2026), ('opinions-relating-to-orders', '/opinions/relatingtoorders/{yy}', 2005, 2026),
 ('online-sources-cited-in-opinions', '/opinions/cited_urls/{yy}', 2005, 2025), ('argument-transcripts', '/oral_arguments/archived_transcripts/{yyyy}', 1968, 1999), ('argument-transcripts', '/oral_arguments/argument_transcript/{yyyy}', 2000, 2026),
 ('orders-of-the-court', '/orders/ordersofthecourt/{yy}', 2003, 2026), ('orders-by-circuit', '/orders/ordersbycircuit/{yy}', 2009, 2026), ('argument-audio', '/oral_arguments/argument_audio/{yyyy}', 2010, 2026)),
t as (select collection, path, unnest(range(lo, hi + 1)) term from c)
select collection, term::int term, 'https://www.supremecourt.gov' || replace(replace(path, '{yyyy}', term::varchar), '{yy}', lpad((term % 100)::varchar, 2, '0')) url from t""")
def term_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.listing_pages(spark, date.fromisoformat(TODAY)).where("term is not null").select("collection", "term", "url")


@query("""
with p as (select p_partkey k, 'a/b' || p_partkey || case p_partkey % 6 when 0 then '.PDF' when 1 then '.mp3' when 2 then '.mp4' when 3 then '.aspx' when 4 then '' else '.jpg' end id from part)
select k, case k % 6 when 0 then 'pdf' when 1 then 'audio' when 2 then 'video' else 'html' end kind, k % 6 in (0, 3, 4) is_doc from p""")
def media_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    end = F.element_at(F.array(*map(F.lit, (".PDF", ".mp3", ".mp4", ".aspx", "", ".jpg"))), (k % 6 + 1).cast("int"))
    uid = F.concat(F.lit("a/b"), k, end)
    return table(spark, sf_dir, "part").select(k.alias("k"), T.media_kind(uid).alias("kind"), T.is_document(uid).alias("is_doc"))


@query("select page_id, url || case when contains(url, '?') then '&' else '?' end || 'reread=1' again from pages")
def reread_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.reread_url("url").alias("again"))


@query(r"select doc_id, sha1(encode('blob ' || strlen(text)) || '\x00'::blob || encode(text)) blob_sha1 from documents")
def git_blob_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.git_blob_sha1("text").alias("blob_sha1"))


# ---- dates and years


@query("select o_orderkey k, strftime(o_orderdate, '%Y-%m-%d') last_date, strftime(o_orderdate, '%Y-%m-%d') entry_date, cast(null as varchar) no_date from orders")
def written_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, long = table(spark, sf_dir, "orders"), F.date_format("o_orderdate", "MMMM d, yyyy")
    text = F.concat(F.lit("Argued January 2, 1990—Decided "), long, F.lit(" (slip op.)"))
    return o.select(F.col("o_orderkey").alias("k"), T.long_date(text).alias("last_date"), T.court_date(F.date_format("o_orderdate", "MMM dd yyyy")).alias("entry_date"), T.long_date(F.lit("February 30, 2020")).alias("no_date"))


@query("""
with t as (select o_orderkey k, 'n' || o_orderkey * 7 || ' of ' || year(o_orderdate) || 'x' s from orders)
select k, list_filter(string_split_regex(s, '[^0-9]+'), lambda x: regexp_full_match(x, '(18|19|20)[0-9][0-9]'))[1]::int year_found from t""")
def years_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(k.alias("k"), T.parse_year(F.concat(F.lit("n"), k * 7, F.lit(" of "), F.year("o_orderdate"), F.lit("x"))).alias("year_found"))


# ---- dockets and printed pages


@query("""
with t as (select o_orderkey k, lpad((o_orderkey * 37 % 100)::varchar, 2, '0') yy from orders), d as (select k, yy, case when k % 10 = 0 then (k % 200 + 1) || ', Orig.' else yy || '-' || k end docket from t)
select k, case when k % 10 = 0 then 'n/22O' || (k % 200 + 1) || '.html' when yy::int between 17 and 49 then 'n/' || docket || '.html|o/' || docket || '.htm' else 'o/' || docket || '.htm|n/' || docket || '.html' end urls from d""")
def docket_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    docket = F.when(k % 10 == 0, F.concat(k % 200 + 1, F.lit(", Orig."))).otherwise(F.concat(F.lpad((k * 37 % 100).cast("string"), 2, "0"), F.lit("-"), k))
    return table(spark, sf_dir, "orders").select(k.alias("k"), F.array_join(F.transform(T.docket_urls(docket, "n/", "o/"), lambda u: u["url"]), "|").alias("urls"))


@query("select o_orderkey k, (o_orderkey % 9999 + 1)::int page, (o_orderkey % 600)::int volume, (o_orderkey % 600) || ' U.S. ' || (o_orderkey % 9999 + 1) citation from orders")
def printed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("o_orderkey"), (F.col("o_orderkey") % 9999 + 1).cast("string")
    head = F.when(k % 3 == 0, F.concat(F.lit("FTC v. GROLIER INC. "), n)).when(k % 3 == 1, F.concat(F.lit("OCTOBER TERM, 2013 "), n)).otherwise(F.concat(n, F.lit(" OCTOBER TERM, 1982")))
    return table(spark, sf_dir, "orders").select(
        k.alias("k"), T.printed_page(F.concat(head, F.lit("\nbody"))).alias("page"), T.volume_number(F.concat(F.lit("Volume "), k % 600), F.lit("x.pdf")).alias("volume"),
        T.cite_as(F.concat(F.lit("A v. B\nCite as: "), k % 600, F.lit(" U. S. "), n, F.lit(" (2020)"))).alias("citation"),
    )


TOGETHER = [
    ("*Together with No. 31–14, Lake Board v. Moor, et al., on certiorari to the same court", "31-14"), ("2 Together with No. 31-15, on appeal", ""), ("Together with No. 30–9, Hill\f", "30-9"),
    ("Together with No. 3-4 that never stops", ""), ("Together with Nos. 30A88 (30–12) and 31----16, also on appeal from y", "30A88|31-16"), ("", ""),
]


@query(values("footnote, dockets", *TOGETHER))
def decided_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.createDataFrame([(a,) for a, _ in TOGETHER], "footnote string")
    return df.select("footnote", F.array_join(T.decided_with("footnote"), "|").alias("dockets"))


GRANTED = "17, Orig. LAKELAND V. MOORLAND\nOrder: 3/4/31 – Set\n31-14# CSX HILL WORKS V. BAY LINE\nOF HARBOR, INC.\nCourt: CA-XX, 2d\n19, Orig. DALE V. FEN\n"


@query(values("docket, title", ("17, Orig.", "LAKELAND V. MOORLAND"), ("31-14", "HILL WORKS V. BAY LINE OF HARBOR, INC."), ("19, Orig.", "DALE V. FEN")))
def granted_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(GRANTED,)], "t string").select(F.explode(T.granted_titles("t")).alias("g")).select("g.docket", "g.title")


VOLUME = [
    "OCTOBER TERM, 2005 1\nSyllabus\nAAA v. BBB\ncertiorari to the court\nNo. 04–12. Argued October 3, 2005—Decided January 5, 2006\ntext", "2 AAA v. BBB\nCite as: 546 U. S. 1 (2006)\nbody",
    "OCTOBER TERM, 2005 3\nPer Curiam\nCCC v. DDD\non petition for writ of certiorari\nNo. 04–99. Decided May 5, 2006\n*Together with No. 04–7, EEE v. FFF, on certiorari to x\nt", "ORDERS FOR OCTOBER",
]


@query(values("title, decided, citation, first, last, dockets, n", ("AAA v. BBB", "2006-01-05", "546 U.S. 1", 1, 2, "04-12", len(VOLUME[0]) + len(VOLUME[1]) + 2), ("CCC v. DDD", "2006-05-05", "546 U.S. 3", 3, 3, "04-99|04-7", len(VOLUME[2]) + 1)))
def reports_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = spark.createDataFrame([("x/546us1.pdf", "u", 2005, "Volume 546", "born_digital", "".join(p + "\f" for p in VOLUME), None)], "id string, url string, term int, title string, text_source string, text string, ocr_text string")
    return printed_cases(v).select("title", F.col("date").alias("decided"), "citation", F.col("pages")[0].alias("first"), F.col("pages")[1].alias("last"), F.array_join("dockets", "|").alias("dockets"), F.length("text").alias("n"))


PRINTED = ["589\n1 of 2", "OCTOBER TERM, 2019 132\nSyllabus\nONE v. TWO", "OCTOBER TERM, 2019 136\nPer Curiam\nTHREE v. FOUR", "137 THREE v. FOUR\ndissenting", "Reporter’s Note\nnumbered 901."]


@query(
    values(
        "term, docket, collection, title, first, last", (2019, "18-1", "opinions-of-the-court", "One v. Two", 2, 2), (2019, "18-2", "opinions-of-the-court", "Three v. Four", 3, 4), (2019, "19-1", "opinions-of-the-court", "E v. F", None, None),
        (2019, "19-2", "opinions-of-the-court", "E v. F", None, None), (2019, "19-3", "opinions-of-the-court", "E v. F", None, None), (2019, "19-1", "argument-transcripts", "E v. F", None, None),
        (2019, "19-77", "granted-noted-cases-list", "LATER V. CASE", None, None), (2005, "04-12", "us-reports", "AAA v. BBB", 1, 2), (2005, "04-99", "us-reports", "CCC v. DDD", 3, 3), (2005, "04-7", "us-reports", "CCC v. DDD", 3, 3),
    )
)
def case_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = lambda page, docket, name: {"page": page, "link_text": name, "row": {"Docket": docket, "Name": name}}
    join = lambda pages: "".join(p + "\f" for p in pages)
    rows = [
        ("opinions-of-the-court", "pp.pdf", "OT2019", 2019, "18-1", "One v. Two", [entry(2, "18-1", "One v. Two"), entry(3, "18-2", "Three v. Four")], join(PRINTED)),
        ("opinions-of-the-court", "s.pdf", "OT2019", 2019, "19-1, 19-2", "E v. F", [], "slip *Together with No. 19–3, G v. H, on certiorari to x\f"), ("argument-transcripts", "t.pdf", "OT2019", 2019, "19-1", "E v. F", [], "talk\f"),
        ("us-reports", "x/546us1.pdf", "volumes-540-549", 2005, None, "Volume 546", [], join(VOLUME)), ("granted-noted-cases-list", "g.pdf", "all", 2019, None, "October Term 2019", [], "19-77 LATER V. CASE\n"),
    ]
    kind = "collection string, id string, url string, partition string, term int, date string, docket string, title string, entries string, text_source string, text string, ocr_text string"
    docs = spark.createDataFrame([(c, i, "u", p, t, None, d, ti, json.dumps(e), "born_digital", x, None) for c, i, p, t, d, ti, e, x in rows], kind)
    got = cases.attributed(docs, F.lit(TODAY).cast("date"))
    return got.select("term", "docket", "collection", "title", F.col("pages")[0].alias("first"), F.col("pages")[1].alias("last"))


@query("""
with p as (select l_orderkey f, l_linenumber p, l_quantity % 2 = 0 t, l_discount >= 0.05 i from lineitem)
select f as file, case when count(*) filter (where t) = 0 then 'no_text' when count(*) filter (where t and i) = 0 then 'born_digital' when count(*) filter (where t and i) = count(*) filter (where t) then 'scanned' else 'mixed' end text_source,
  (count(*) filter (where i))::int image_pages, (count(*) filter (where t and i))::int ocr_pages from p group by 1""")
def page_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.struct("l_linenumber", F.when(F.col("l_quantity") % 2 == 0, "text").otherwise(" ").alias("t"), (F.col("l_discount") * 10).alias("c"))
    files = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("file")).agg(F.array_sort(F.collect_list(page)).alias("p"))
    return files.select("file", extract.classified(F.col("p.t"), F.col("p.c")).alias("x")).select("file", "x.*")


# ---- plans


@query("""
with u as (select o_orderkey id, 'OT' || year(o_orderdate) p from orders), h as (select o_orderkey id, 'OT' || (year(o_orderdate) - 1) p from orders where o_orderstatus = 'P')
select coalesce(h.p, u.p) as "partition", count(*) n from u left join h using (id) group by 1""")
def sticky_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("y"), "o_orderstatus")
    units = o.select("id", F.concat(F.lit("OT"), "y").alias("partition"))
    homes = o.where("o_orderstatus = 'P'").select("id", F.concat(F.lit("OT"), F.col("y") - 1).alias("partition"))
    return sync.sticky(units, homes).groupBy("partition").agg(F.count("*").alias("n"))


@query("select p_partkey id from part where p_partkey not in (select l_partkey from lineitem where l_returnflag = 'R')")
def forgotten_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return sync.forgotten(failures, table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("id")).distinct(), held=False)


@query("""
with f as (select user_id id, count(*) attempts from events where event_type = 'error' group by 1), n as (select distinct user_id id from events where event_type = 'click')
select coalesce(f.id, n.id) id, coalesce(f.attempts, 0) + (n.id is not null)::int attempts, n.id is not null failed_now from f full outer join n using (id)""")
def failure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, old = table(spark, sf_dir, "events"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    failures = e.where("event_type = 'error'").groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("attempts")).withColumn("error", F.lit("x")).withColumn("at", old)
    failed = e.where("event_type = 'click'").select(F.col("user_id").alias("id"), F.lit("y").alias("error")).distinct()
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return sync.after_failure(failures, failed, now).select("id", "attempts", (F.col("at") == now).alias("failed_now"))


@query("""
with t as (select o_orderkey k, case when o_orderkey % 5 = 0 then null else year(o_orderdate) end term, o_orderkey % 7 <> 0 listed from orders)
select coalesce(term, 0)::int term, count(*) n, count(*) filter (where listed and (term is null or term >= 1999)) due from t group by 1""")
def revalidation_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(F.when(k % 5 != 0, F.year("o_orderdate")).alias("term"), (k % 7 != 0).alias("listed"))
    due = F.col("listed") & sync.recent(F.col("term"), 2000)
    return rows.groupBy(F.coalesce("term", F.lit(0)).alias("term")).agg(F.count("*").alias("n"), F.count_if(due).alias("due"))


@query("""
with t as (select doc_id, text, case when doc_id % 3 = 0 then null when doc_id % 3 = 1 then text else text || '!' end stored, doc_id % 2 = 0 html from documents)
select doc_id, case when html then stored is not null and stored = text else stored is not null and sha256(stored) = sha256(text) end same from t""")
def same_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("doc_id"), F.col("text")
    stored = F.when(k % 3 == 1, t).when(k % 3 == 2, F.concat(t, F.lit("!")))
    kind = F.when(k % 2 == 0, "text/html").otherwise("application/pdf")
    return table(spark, sf_dir, "documents").select("doc_id", sync.same_content(kind, stored, t, F.sha2(stored, 256), F.sha2(t, 256)).alias("same"))


@query("select user_id, event_id from (select *, row_number() over (partition by user_id order by event_id desc) r from events) where r <= 20")
def last_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.newest(table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id"], "event_id", 20)


@query("""
with p as (select c_nationkey k, min(c_custkey) % 30 + 1980 lo, min(c_custkey) % 30 + 1980 + c_nationkey % 4 hi from customer group by 1) select distinct unnest(range(lo, hi + 1)) term from p""")
def terms_with_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg((F.min("c_custkey") % 30 + 1980).alias("first_term"))
    return grouping.term_span(p.withColumn("last_term", F.col("first_term") + F.col("c_nationkey") % 4))


@query("""
with r as (select lang p, count(*) n, count(*) filter (where doc_id % 9 <> 0) l from documents group by 1),
m as (select lang p, count(*) + (lang = 'de')::int n, count(*) filter (where doc_id % 9 <> 0) - (lang = 'fr')::int l from documents where lang <> 'es' group by 1 union all select 'xx', 3, 3)
select coalesce(r.p, m.p) scope, unnest(list_filter([case when m.p is null then 'not in the manifest' end, case when r.p is null and m.n > 0 then 'in the manifest but not stored' end,
  case when r.n <> m.n then r.n || ' rows, the manifest says ' || m.n end, case when r.l <> m.l then r.l || ' listed rows, the manifest says ' || m.l end], lambda x: x is not null)) problem from r full outer join m on r.p = m.p""")
def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("_stored_in"), (F.col("doc_id") % 9 != 0).alias("listed"))
    m = d.where("_stored_in <> 'es'").groupBy(F.col("_stored_in").alias("partition")).agg((F.count("*") + (F.first("_stored_in") == "de").cast("int")).alias("rows"), (F.count_if("listed") - (F.first("_stored_in") == "fr").cast("int")).alias("listed"))
    extra = spark.createDataFrame([("xx", 3, 3)], "partition string, rows long, listed long")
    return verify.manifest_problems(d, m.unionByName(extra).withColumn("ids_sha256", F.lit(None).cast("string"))).select("scope", "problem")


@query("""select c_custkey k, '{"acct": ' || case when c_acctbal < 0 then 'true' else 'false' end || ', "name": "' || c_name || '", "seg": ' || case when c_custkey % 5 = 0 then 'null' else '"' || c_mktsegment || '"' end || '}' as json from customer""")
def canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    value = F.struct(F.when(k % 5 != 0, F.col("c_mktsegment")).alias("seg"), F.col("c_name").alias("name"), (F.col("c_acctbal") < 0).alias("acct"))
    return table(spark, sf_dir, "customer").select(k.alias("k"), casebuild.as_json(value).alias("json"))


@query("""
with n as (select year(o_orderdate) term, count(*) s from orders group by 1)
select term::int term, case when term % 4 = 0 then 'new' when term % 4 = 1 then 'builder' when term % 4 = 2 then 'sources' else 'dockets due' end reason from n""")
def rebuild_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("term"), F.col("o_orderpriority").alias("collection"), F.col("o_orderkey").cast("string").alias("sha256"))
    now = casebuild.term_signatures(o, spark.createDataFrame([], "term int, id string, text string, ocr_text string"))
    t = F.col("term") % 4
    built = now.where(t != 0).select("term", F.when(t == 2, "old").otherwise(F.col("signature")).alias("signature"), F.when(t == 1, casebuild.BUILDER - 1).otherwise(casebuild.BUILDER).alias("builder"), F.lit(True).alias("complete"))
    return casebuild.rebuild_reasons(now, built, now.select("term"))


@query()
def folded_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two texts compared without white space, after NFKD, and as multisets; SQL has no NFKD."""

    @F.pandas_udf("equal boolean, equal_nfkd boolean, delta long")
    def run(a, b):
        import pandas as pd

        return pd.DataFrame([extract.compare(x, y) for x, y in zip(a, b, strict=True)], columns=["equal", "equal_nfkd", "delta"])

    other = F.when(F.col("item_id") % 2 == 0, F.translate("text", "\n", " ")).otherwise(F.concat("text", F.lit("ﬁ")))
    return table(spark, sf_dir, "benchmark").select("item_id", run("text", other).alias("c")).select("item_id", "c.*")
