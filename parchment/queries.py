"""Queries over the driver tables, one for each group of operators, and the SQL that DuckDB checks them with.

The engine's own inputs are listings and documents; here each operator runs over the closest table, whole.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parchment import schema
from parchment.functions import text as T
from parchment.operators import attribution, grouping, rendering, segments, verify
from parchment.plans import sync
from parchment.sources import catalog
from parchment.streaming import sync_stream

TODAY = "2026-09-27"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def digest_sql(line: str) -> str:
    """grouping.line_digest() as SQL."""
    sums = " || ':' || ".join(f"sum(('0x' || substr(sha256({line}), {1 + 15 * i}, 15))::bigint)" for i in range(4))
    return f"sha256(count(*) || ':' || {sums})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _today() -> Column:
    return F.lit(TODAY).cast("date")


# ---- sync


@query("""
with o as (select o_orderkey k, o_orderstatus st, o_orderpriority pr, o_totalprice < 50000 cheap, extract(year from o_orderdate) - case when extract(month from o_orderdate) < 10 then 1 else 0 end term from orders),
u as (select k, st, 'OT' || term p, cheap from o where st <> 'P'),
s as (select k, case when pr = '2-HIGH' then 'X' else st end st, 'OT' || (term - case when pr = '3-MEDIUM' then 1 else 0 end) p, pr <> '5-LOW' listed from o where pr <> '1-URGENT'),
j as (select coalesce(s.p, u.p) part, u.k uk, s.k sk, coalesce(u.k, s.k) k, s.listed, u.st is distinct from s.st ch, cheap from u full outer join s on u.k = s.k)
select part as "partition", case when uk is null and listed then 'delisted' when sk is null and cheap then 'waiting' when sk is null then 'new' when uk is null then 'unchanged' when not listed then 'relisted' when ch then 'changed' else 'unchanged' end as action,
       count(*) n, min(k) min_id, max(k) max_id
from j group by 1, 2""")
def sync_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: new, waiting, changed, delisted and relisted files, in the partition that holds them."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", T.october_term(F.col("o_orderdate")).alias("term"))
    k, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    units = o.where(status != "P").select(k.alias("id"), F.concat(F.lit("OT"), "term").alias("partition"), status.alias("title"))
    held = F.col("term") - F.when(priority == "3-MEDIUM", 1).otherwise(0)
    stored = o.where(priority != "1-URGENT").select(k.alias("id"), F.concat(F.lit("OT"), held).alias("partition"), F.when(priority == "2-HIGH", "X").otherwise(status).alias("title"), (priority != "5-LOW").alias("listed"), "term")
    failures = o.where("o_totalprice < 50000").select(k.alias("id"), F.lit(3).alias("attempts"), F.lit(f"{TODAY} 00:00:00").cast("timestamp_ntz").alias("at"))
    plan = sync.sync_plan(units, stored, failures, sync.Options(now=f"{TODAY} 00:00:00", current_term=2025))
    return plan.groupBy("partition", "action").agg(F.count("*").alias("n"), F.min("id").alias("min_id"), F.max("id").alias("max_id"))


@query("""
select p_id as id, min(part) as "partition", count(*) n, string_agg(line, ',' order by seq) lines from (
  select l_partkey p_id, strftime(l_shipdate, '%Y-%m') part, l_orderkey * 10 + l_linenumber seq, (l_orderkey || ':' || l_linenumber) line from lineitem) t group by 1""")
def unit_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("id"), F.date_format("l_shipdate", "yyyy-MM").alias("partition"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.concat_ws(":", "l_orderkey", "l_linenumber").alias("entry"), F.lit("").alias("url"),
    )
    return grouping.group_units(rows).select("id", "partition", F.size("entries").cast("long").alias("n"), F.array_join("entries", ",").alias("lines"))


@query("select extract(year from o_orderdate) - case when extract(month from o_orderdate) < 10 then 1 else 0 end term, count(*) n from orders group by 1")
def october_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(T.october_term("o_orderdate").cast("long").alias("term")).agg(F.count("*").alias("n"))


@query("""
with t as (select o_orderkey k, o_orderdate d, (o_orderkey % 100)::int yy from orders)
select k, (case when yy <= 27 then 2000 else 1900 end + yy) || strftime(d, '-%m-') || lpad(least(day(d), 28)::varchar, 2, '0') short_date, strftime(d, '%Y-%m-%d') full_date, cast(null as varchar) bad_date from t""")
def iso_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    full = F.date_format("o_orderdate", "MM-dd-yyyy")
    short = F.concat_ws("/", F.month("o_orderdate"), F.least(F.dayofmonth("o_orderdate"), F.lit(28)), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"))  # every two-digit year
    return o.select(F.col("o_orderkey").alias("k"), T.iso_date(short, _today()).alias("short_date"), T.iso_date(full, _today()).alias("full_date"), T.iso_date(F.concat(F.lit("13/"), full), _today()).alias("bad_date"))


@query("""
with t as (select o_orderpriority page, extract(year from o_orderdate) y, extract(month from o_orderdate) m from orders),
e as (select page, y - case when m < 10 then 1 else 0 end term, 1995 + cast(left(page, 1) as int) own from t)
select page, cast(own as int) own, count(*) dated, count(*) filter (where term = own) in_term, array_to_string(list_sort(list(distinct term) filter (where term <> own)), ',') others
from e group by 1, 2 having count(*) filter (where term = own) * 2 < count(*)""")
def term_majority_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("page"), T.october_term("o_orderdate").alias("term"), (F.substring("o_orderpriority", 1, 1).cast("int") + 1995).alias("own"))
    return sync.majority_check(o, "page", "term", "own").withColumn("others", F.array_join("others", ","))


@query("""
with d as (select event_type || '/' || cast(ts as date) url, event_type, cast(ts as date) as day, count(*) n from events where event_type <> 'error' or extract(dow from ts) not in (0, 6) group by all),
pages as (select event_type, unnest(range(date '2024-01-01', date '2024-01-31', interval 1 day)) as day from (select distinct event_type from events)),
now_ as (select p.event_type, p.day, coalesce(d.n, 0) n from pages p left join d on d.event_type = p.event_type and d.day = cast(p.day as date)),
x as (select a.event_type, cast(a.day as date) as day, a.n, b.n before from now_ a left join now_ b on a.event_type = b.event_type and b.day = a.day - interval 1 day)
select event_type || '/' || day as url, before, case when extract(day from day) % 2 = 0 then 'held' else 'fatal' end verdict from x where n = 0 and coalesce(before, 0) > 0""")
def held_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    got = e.where((F.col("event_type") != "error") | ~F.dayofweek("ts").isin(1, 7)).groupBy("event_type", "day").agg(F.count("*").alias("n"))
    days = F.explode(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-30").cast("date")))
    pages = e.select("event_type").distinct().select("event_type", days.alias("day")).join(got, ["event_type", "day"], "left").select("event_type", "day", F.coalesce("n", F.lit(0)).alias("entries"))
    now = pages.select(F.concat_ws("/", "event_type", "day").alias("url"), "entries", (F.dayofmonth("day") % 2 == 0).alias("explained"))
    last = pages.select(F.concat_ws("/", "event_type", F.date_add("day", 1)).alias("url"), "entries")
    return sync.held_pages(now, last)


@query("""
with d as (select x.lang, x.text, x.n_chars, l.quality, l.toxic, x.doc_id from documents x left join labels l using (doc_id))
select lang as "partition", count(*) as "rows", count(*) filter (where doc_id % 9 <> 0) listed, count(*) filter (where doc_id % 9 = 0) delisted, sum(n_chars)::bigint as bytes, count(quality) checked, count(*) filter (where quality = 1) equal,
       min(case when toxic is not null then doc_id % 40 + 1980 end) first_term, max(case when toxic is not null then doc_id % 40 + 1980 end) last_term, count(*) filter (where toxic is null) undated,
       'born:' || count(*) filter (where doc_id % 3 = 0) || ',none:' || count(*) filter (where doc_id % 3 = 1) || ',scanned:' || count(*) filter (where doc_id % 3 = 2) text_sources
from d group by lang""")
def partition_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    k = F.col("doc_id")
    rows = d.select(
        F.col("lang").alias("partition"), (k % 9 != 0).alias("listed"), F.col("n_chars").alias("file_size"), F.lit(1).alias("pages"), (F.col("quality") == 1).alias("xcheck_equal"), F.lit(None).cast("boolean").alias("xcheck_equal_nfkd"),
        F.lit(None).cast("long").alias("xcheck_delta"), F.when(F.col("toxic").isNotNull(), k % 40 + 1980).alias("term"), "text", F.when(k % 3 == 0, "born").when(k % 3 == 2, "scanned").alias("text_source"),
    )
    sources = F.array_join(F.transform(F.map_entries("text_sources"), lambda e: F.concat_ws(":", e["key"], e["value"])), ",")
    return grouping.summarize(rows).select("partition", "rows", "listed", "delisted", "bytes", "checked", "equal", "first_term", "last_term", "undated", sources.alias("text_sources"))


@query("""
select lang, sum(len(regexp_extract_all(text, '[\\x{E000}-\\x{F8FF}]')))::bigint private_use, count(*) filter (where regexp_matches(text, '[à-ÿ]')) accent_rows, sum(len(regexp_extract_all(text, '[à-ÿ]')))::bigint accents, count(*) filter (where contains(text, '�')) replacement_rows
from documents group by lang""")
def codepoint_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    accents = F.regexp_count("text", F.lit("[à-ÿ]"))
    return table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.sum(F.regexp_count("text", F.lit(T.PRIVATE_USE))).alias("private_use"), F.count_if(accents > 0).alias("accent_rows"), F.sum(accents).alias("accents"), F.count_if(F.contains("text", F.lit("�"))).alias("replacement_rows"),
    )


@query(f"""
with u as (select source, cast(doc_id as varchar) id, sha256(text) f from documents)
select source, {digest_sql("id || chr(9) || f")} fingerprint from u group by 1""")
def unit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("id"), F.sha2("text", 256).alias("fingerprint"))
    return grouping.partition_fingerprints(units, "source")


@query("select sha256(text) digest, count(*) n from documents group by 1 having count(*) > 1")
def duplicate_text_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.duplicates(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("digest")), "digest")


@query("""
with live as (select distinct l_suppkey + 3 id from lineitem), st as (select s_suppkey id from supplier), f as (select s_suppkey + 2 id from supplier where s_acctbal >= 0),
a as (select id from live union select id from st union select id from f),
k as (select id, case when id in (from live) and id not in (from st) and id not in (from f) then 'missing' when id in (from live) and id not in (from st) then 'missing_but_failed' when id in (from st) and id not in (from live) then 'extra' end kind from a)
select kind, count(*) n, min(id) first_id from k where kind is not null group by kind""")
def live_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") + 3).alias("id"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), "s_acctbal")
    return sync.live_diff(live, s, s.where("s_acctbal >= 0").select((F.col("id") + 2).alias("id"))).groupBy("kind").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query(r"""
select 'd' || doc_id id, md5(trim(regexp_replace(text, '[ \t\n\f\r]+', ' ', 'g'), ' ')) digest from documents
union all select 'c' || conv_id || '-' || turn, md5(trim(regexp_replace(text, '[ \t\n\f\r]+', ' ', 'g'), ' ')) from conversations""")
def squash_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), "text")
    c = table(spark, sf_dir, "conversations").select(F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), "text")
    return d.union(c).select("id", F.md5(T.squash("text")).alias("digest"))


@query(r"""
with b as (select item_id, regexp_replace(text, '\s+', '', 'g') t from benchmark),
d as (select item_id, t, reverse(t) r, substr(t, 1, length(t) // 2) || '!' h from b)
select item_id, t = r equal, cast((select coalesce(sum(abs(x.n - coalesce(y.n, 0))), 0) from (select c, count(*) n from (select unnest(string_split(t, '')) c) group by c) x left join (select c, count(*) n from (select unnest(string_split(h, '')) c) group by c) y using (c))
  + (select count(*) from (select unnest(string_split(h, '')) c) where c not in (select unnest(string_split(t, '')))) as bigint) delta from d""")
def nonspace_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality without white space, and the difference of two texts as multisets of characters."""
    t = table(spark, sf_dir, "benchmark").select("item_id", T.nonspace("text").alias("t"))
    half = F.concat(F.expr("substr(t, 1, length(t) div 2)"), F.lit("!"))
    chars = t.select("item_id", F.explode(F.split("t", "")).alias("c"), F.lit(1).alias("n")).union(t.select("item_id", F.explode(F.split(half, "")).alias("c"), F.lit(-1).alias("n")))
    delta = chars.where("c <> ''").groupBy("item_id", "c").agg(F.sum("n").alias("n")).groupBy("item_id").agg(F.sum(F.abs("n")).alias("delta"))
    return t.select("item_id", (F.col("t") == F.reverse("t")).alias("equal")).join(delta, "item_id")


@query(r"""
with w as (select doc_id, unnest(string_split_regex(text, '[^A-Za-z0-9-]+')) tok, generate_subscripts(string_split_regex(text, '[^A-Za-z0-9-]+'), 1) i from documents),
m as (select doc_id, case when regexp_full_match(tok, '[0-9]{2}O[0-9]+') then ltrim(regexp_extract(tok, 'O([0-9]+)', 1), '0') || ', Orig.' else tok end v, i from w where regexp_full_match(tok, '[0-9]{2,4}-[0-9]+|[0-9]{2}A[0-9]+|[0-9]{2}O[0-9]+')),
f as (select doc_id, v, min(i) i from m group by all)
select d.doc_id, count(f.v) n, coalesce(string_agg(f.v, '|' order by f.i), '') dockets from documents d left join f using (doc_id) group by d.doc_id""")
def docket_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", T.docket_candidates("text").alias("found"))
    return d.select("doc_id", F.size("found").cast("long").alias("n"), F.array_join("found", "|").alias("dockets"))


SPELLINGS = [
    ("17, Orig.", "17, Orig."), ("17-Orig", "17, Orig."), ("18Orig", "18, Orig."), ("19 Orig.", "19, Orig."), ("22O17", "17, Orig."), ("19original", "19, Orig."), ("17_orig", "17, Orig."),
    ("No. 31-1406", "31-1406"), ("31-9", "31-9"), ("31A2", "31A2"), ("30A88", "30A88"), (" 30-12 ", "30-12"), ("003, Orig.", "3, Orig."), ("", ""),
]


@query("select * from (values " + ", ".join(f"('{a}', '{b}', '{'22O' + b.split(',')[0] if 'Orig' in b else b}')" for a, b in SPELLINGS) + ") t(spelling, docket, slug)")
def normalize_docket(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.createDataFrame([(a,) for a, _ in SPELLINGS], "spelling string")
    return d.select("spelling", T.normalize_docket("spelling").alias("docket"), T.docket_slug("spelling").alias("slug"))


@query("""
with t as (select o_orderkey k, lpad(cast(o_orderkey * 37 % 100 as varchar), 2, '0') yy, extract(year from o_orderdate) term from orders),
y as (select k, yy, term, greatest(1800 + yy::int, case when 1900 + yy::int <= term + 1 then 1900 + yy::int else 0 end, case when 2000 + yy::int <= term + 1 then 2000 + yy::int else 0 end) y from t)
select k, yy || '-' || (k % 1000) docket, y >= term - 10 in_term from y""")
def docket_year_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.year("o_orderdate").alias("term"), F.concat(F.lpad((F.col("o_orderkey") * 37 % 100).cast("string"), 2, "0"), F.lit("-"), F.col("o_orderkey") % 1000).alias("docket"))
    return o.select("k", "docket", T.docket_in_term("docket", "term").alias("in_term"))


# ---- pages


@query("""
with p as (select conv_id f, turn p, role = 'user' s, length(text) % 5 = 0 stop from conversations),
n as (select *, sum(s::int) over (partition by f order by p) k from p)
select f as file, k::bigint as span, min(p) as first, coalesce(min(p) filter (where stop and not s) - 1, max(p)) as last from n where k > 0 group by f, k""")
def page_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file"), F.col("turn").alias("page"), (F.col("role") == "user").alias("start"), (F.length("text") % 5 == 0).alias("stop"))
    spans = segments.page_spans(c, "file", "page", "start", "stop")
    return spans.withColumn("span", F.row_number().over(Window.partitionBy("file").orderBy("first")).cast("long"))


@query("""
select a.conv_id as file, a.turn as page, min(b.turn) as next_start from conversations a left join conversations b on a.conv_id = b.conv_id and b.role = 'user' and b.turn > a.turn group by 1, 2""")
def next_start_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file"), F.col("turn").alias("page"), "role")
    return segments.next_start(c.select("file", "page"), c.where("role = 'user'").select("file", "page"), "file", "page").distinct()


@query(r"""
with s as (select doc_id, string_split(replace(text, chr(10), chr(12)) || case when doc_id % 2 = 0 then chr(12) else '' end, chr(12)) p from documents),
q as (select doc_id, case when p[len(p)] = '' then p[:len(p) - 1] else p end p from s)
select doc_id, len(p) pages, md5(case when len(p) > 0 then p[1] || chr(12) else '' end || case when len(p) > 1 then p[2] || chr(12) else '' end) first_two from q""")
def split_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.concat(F.translate("text", "\n", "\f"), F.when(F.col("doc_id") % 2 == 0, "\f").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(T.split_pages(t)).cast("long").alias("pages"), F.md5(T.first_pages(t)).alias("first_two"))


# ---- cases


@query("""
with h as (select distinct l_partkey c, l_orderkey d from lineitem), n as (select l_partkey c, l_partkey % 50 + 1 o, l_orderkey d from lineitem),
w as (select distinct o c, d from n where o <> c)
select w.c as "case", w.d as doc from w where not exists (select 1 from h where h.c = w.c and h.d = w.d)""")
def consolidated_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("case"), F.col("l_orderkey").alias("doc"))
    named = held.withColumn("other", F.col("case") % 50 + 1)
    return attribution.consolidated(held, named, "case", "other", ["doc"])


@query("""
with w as (select c_custkey k, c_nationkey::bigint d from customer), h as (select o_custkey k, o_orderkey % 25 d, o_orderstatus s from orders)
select k, d from w where k not in (select k from h where s = 'F' and k is not null) and not exists (select 1 from h where h.k = w.k and h.d = w.d)""")
def fallback_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("long").alias("d"))
    held = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 25).alias("d"), F.col("o_orderstatus").alias("s"))
    return attribution.fallback(wanted, held, ["k"], ["d"], F.col("s") == "F")


@query("""
with c as (select user_id, event_type, count(*) n, min(event_id) f from events group by 1, 2)
select user_id, event_type, n from (select *, row_number() over (partition by user_id order by n desc, f) r from c) where r = 1""")
def top_title_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.first_most_common(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("""
with o as (select o_custkey k, string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey) orders, count(*) n from orders group by 1),
l as (select o_custkey k, string_agg(distinct l_returnflag, '' order by l_returnflag) flags from lineitem join orders on l_orderkey = o_orderkey group by 1)
select c_custkey k, c_name as name, coalesce(o.orders, '') orders, coalesce(o.n, 0) n, coalesce(l.flags, '') sources from customer left join o on c_custkey = o.k left join l on c_custkey = l.k""")
def assemble_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with their ordered documents and sources; the fact table is aggregated before it meets the cases."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("k"))
    cases = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    flags = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag").distinct().join(o, "o_orderkey").groupBy("k").agg(F.array_join(F.sort_array(F.collect_set("l_returnflag")), "").alias("sources"))
    parts = o.select("k", F.col("o_orderkey").alias("seq"), F.col("o_orderkey").cast("string").alias("doc"))
    out = attribution.assemble(cases, parts, "k", "seq", "doc", "docs").join(flags, "k", "left")
    return out.select("k", "name", F.array_join("docs", ",").alias("orders"), F.size("docs").cast("long").alias("n"), F.coalesce("sources", F.lit("")).alias("sources"))


# ---- schedules


@query("""
with s as (select user_id, max(ts) t, count(*) n from events group by 1),
a as (select user_id, date_diff('second', t, timestamp '2024-02-05 00:00:00') / 3600.0 h, n % 2 = 0 found, n % 3 = 0 untried, 2000 + user_id % 27 term from s)
select user_id, (not found and untried) or h >= case when term >= 2025 then 6 when found then 168 else 720 end due from a""")
def docket_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("t"), F.count("*").alias("n"))
    age = F.timestamp_diff("SECOND", F.col("t"), F.lit("2024-02-05 00:00:00").cast("timestamp_ntz")) / 3600
    return s.select("user_id", sync.docket_due(age, F.col("n") % 2 == 0, F.col("n") % 3 == 0, F.lit(2000) + F.col("user_id") % 27, 2026).alias("due"))


@query("""
with t as (select extract(year from o_orderdate) term, count(*) filter (where o_orderstatus = 'P') = 0 or extract(year from o_orderdate) % 2 = 0 complete from orders group by 1)
select term, complete, row_number() over (order by case when term >= 2000 then 0 when not complete then 1 else 2 end, term desc) place from t""")
def term_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").cast("long").alias("term")).agg((F.count_if(F.col("o_orderstatus") == "P") == 0).alias("c"))
    t = t.select("term", (F.col("c") | (F.col("term") % 2 == 0)).alias("complete"))
    return sync.term_order(t, "term", F.col("complete"), 2001).withColumn("place", F.col("place").cast("long"))


@query("""
with t as (select strftime(o_orderdate, '%Y-%m') key, sum(o_orderkey) % 3 = 0 stale from orders group by 1)
select key, stale, row_number() over (order by case when stale then 0 else 1 end, key desc) place from t""")
def partition_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("key")).agg((F.sum("o_orderkey") % 3 == 0).alias("stale"))
    return sync.partition_order(t, "key", F.col("stale")).withColumn("place", F.col("place").cast("long"))


@query("""
with f as (select user_id, event_type, count(*) attempts, max(ts) t from events where event_type = 'error' group by all)
select distinct user_id as "partition" from f where attempts >= 3 and t + interval 24 hours <= timestamp '2024-01-29 12:00:00'""")
def retry_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "events").where("event_type = 'error'").groupBy(F.col("user_id").alias("partition")).agg(F.count("*").alias("attempts"), F.max("ts").alias("at"))
    return sync.retry_due(f, F.lit("2024-01-29 12:00:00").cast("timestamp_ntz"))


@query("""
with t as (select o_orderkey k, case when o_orderkey % 4 = 0 then null else o_orderstatus end e0, case when o_orderkey % 5 = 0 then null when o_orderkey % 7 = 0 then 'X' else o_orderstatus end e1,
  case when o_orderkey % 3 = 0 then null else o_orderpriority end m0, case when o_orderkey % 2 = 0 then null else o_orderpriority end m1 from orders)
select k, (e1 is null and m1 is null) or (e1 is not null and e0 is distinct from e1) or (m1 is not null and m0 is distinct from m1) changed from t""")
def validators_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s, p = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    pairs = [(F.when(k % 4 != 0, s), F.when(k % 5 == 0, F.lit(None).cast("string")).when(k % 7 == 0, "X").otherwise(s)), (F.when(k % 3 != 0, p), F.when(k % 2 != 0, p))]
    return table(spark, sf_dir, "orders").select(k.alias("k"), sync.changed_on_server(pairs).alias("changed"))


# ---- reports


@query("""
select extract(year from o_orderdate) term, grouping(extract(year from o_orderdate)) = 1 is_total, count(*) n, count(*) filter (where o_orderstatus = 'F') found, min(o_orderkey) first_key from orders group by rollup (extract(year from o_orderdate))""")
def coverage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("term", F.year("o_orderdate").cast("long"))
    return grouping.with_total(o, "term", F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("found"), F.min("o_orderkey").alias("first_key"))


@query("""
select r_name as category, n_name as collection, count(c_custkey) as "rows", count(*) filter (where c_acctbal < 0) missing, count(c_custkey) > 0 and count(*) filter (where c_acctbal < 0) = 0 whole
from region join nation on n_regionkey = r_regionkey left join customer on c_nationkey = n_nationkey group by 1, 2""")
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("rows"), F.count_if(F.col("c_acctbal") < 0).alias("missing"))
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(c, "n_nationkey", "left")
    rows, missing = F.coalesce("rows", F.lit(0)), F.coalesce("missing", F.lit(0))
    return n.select(F.col("r_name").alias("category"), F.col("n_name").alias("collection"), rows.alias("rows"), missing.alias("missing"), ((rows > 0) & (missing == 0)).alias("whole"))


@query("""
select source, count(*) n, case when sum(n_chars) < 1000 then 'n<1K' when sum(n_chars) < 10000 then '1K<n<10K' when sum(n_chars) < 100000 then '10K<n<100K' when sum(n_chars) < 1000000 then '100K<n<1M' else '1M<n<10M' end size from documents group by 1""")
def size_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("s")).select("source", "n", T.size_category("s").alias("size"))


@query("select p_partkey, p_name from part order by sha256(p_partkey || 'seed-7'), p_partkey limit 25")
def sample_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.seeded_sample(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", 25, "seed-7")


@query("select event_id, user_id, event_type from events where event_type = 'error' order by value desc, event_id limit 25")
def top_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'error'").orderBy(F.desc("value"), "event_id").limit(25).select("event_id", "user_id", "event_type")


@query(f"""
with t as (select strftime(o_orderdate, '%Y') term, o_orderpriority collection, o_orderkey || ':' || o_orderstatus line from orders)
select term, collection, count(*) n, {digest_sql("line")} signature from t group by 1, 2""")
def source_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy").alias("term"), F.col("o_orderpriority").alias("collection"), F.concat(F.col("o_orderkey"), F.lit(":"), F.col("o_orderstatus")).alias("line"))
    return o.groupBy("term", "collection").agg(F.count("*").alias("n"), grouping.line_digest(F.col("line")).alias("signature"))


@query("""
select p_partkey k, case p_partkey % 4 when 0 then 'pdf' when 1 then 'mp3' when 2 then 'mp4' end kind from part""")
def media_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    name = F.col("p_name").cast("binary")
    made = F.when(k % 4 == 0, F.concat(F.lit(b"\n%PDF-1.7 "), name)).when(k % 8 == 1, F.concat(F.lit(b"ID3\x04"), name)).when(k % 8 == 5, F.concat(F.lit(b"\xff\xfb\x90"), name)).when(k % 4 == 2, F.concat(F.lit(b"\x00\x00\x00\x20ftypisom"), name)).otherwise(F.concat(F.lit(b"<html>"), name))
    return table(spark, sf_dir, "part").select(k.alias("k"), T.sniff_media(made).alias("kind"))


@query("""
with d as (select doc_id, source, lang from documents),
e as (select source, doc_id, case when doc_id % 10 = 0 then 's' || doc_id end s, case when doc_id % 4 = 0 then 'g' || doc_id end g from d),
a as (select *, max(case when s is not null then doc_id end) over w sa, max(case when g is not null then doc_id end) over w ga from e window w as (partition by source order by doc_id))
select source, doc_id, case when sa is not null then 's' || sa end section, case when ga is not null and (sa is null or ga >= sa) then 'g' || ga end as "group" from a""")
def running_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.when(k % 10 == 0, F.concat(F.lit("s"), k)).alias("section"), F.when(k % 4 == 0, F.concat(F.lit("g"), k)).alias("group"))
    out = segments.running_headings(rows, ["source"], "doc_id", ["section", "group"])
    return out.select("source", "doc_id", F.col("running_section").alias("section"), F.col("running_group").alias("group"))


# ---- pages of HTML and stored snapshots


@query()
def html_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "pages").select("page_id", rendering.html_text("html").alias("t"))
    return text.select("page_id", F.size(F.split("t", "\n")).cast("long").alias("lines"), F.md5("t").alias("digest"))


@query("select page_id, len(regexp_extract_all(html, '<a [^>]*href=\"[^#\"][^\"]*\"'))::bigint n_links from pages")
def link_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    n = rendering.links(p, "page_id", "url", "html").groupBy("page_id").agg(F.count("*").alias("n_links"))
    return p.select("page_id").join(n, "page_id", "left").select("page_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


@query(r"select page_id, lower(ltrim(regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', ''), '/')) id, regexp_replace(url, '#.*$', '') url from pages")
def resolve_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", rendering.resolved("url").alias("r")).select("page_id", "r.id", "r.url")


@query("""
with d as (select doc_id, lang, source, doc_id % 10 r from documents)
select lang as scope, cast(doc_id as varchar) as key, case when r = 3 then 'no file_sha256' else 'is html with text null and ocr_text null' end problem from d where r in (3, 7)""")
def verify_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted defects, each found as its own problem."""
    d, r = table(spark, sf_dir, "documents"), F.col("doc_id") % 10
    rows = d.select(
        F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("partition"), F.col("lang").alias("_stored_in"), F.lit(True).alias("listed"), F.lit("html").alias("text_source"), F.when(r != 7, F.col("text")).alias("text"),
        F.lit(None).cast("string").alias("ocr_text"), F.when(r != 3, F.sha2("text", 256)).alias("file_sha256"),
    )
    return verify.row_problems(rows)


@query()
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = schema.conform(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), schema.DOCUMENTS)
    found = [("conformed", x) for x in schema.differences(d.schema, schema.DOCUMENTS)] + [("documents", x) for x in schema.differences(table(spark, sf_dir, "documents").schema, schema.DOCUMENTS)]
    return spark.createDataFrame(found, "tbl string, problem string")


@query("select user_id, max(event_id) event_id, arg_max(event_type, event_id) event_type, arg_max(value, event_id) as \"value\" from events group by 1")
def stream_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that a stream of changes ends in: the same as merging them at once."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    first = sync_stream.merge(e.limit(0), e.where("event_id % 2 = 0"), "user_id", "event_id")
    return sync_stream.merge(first, e.where("event_id % 2 = 1"), "user_id", "event_id")


@query()
def catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.listing_pages(spark, date.fromisoformat(TODAY)).groupBy("collection").agg(F.count("*").alias("pages"), F.min("term").alias("first_term"), F.max("term").alias("last_term"))
