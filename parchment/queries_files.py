"""Queries over files: content-defined cuts, footers, pruned scans, and the as-of join that places rows between cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.plans import files, recount
from parchment.plans.asof import asof
from parchment.queries import digest_sql, query, table
from parchment.sources import footers

#: Wanted bytes of a file in the query, far below what a store uses.
SMALL_FILE = 65_536


@query(f"""
with d as (select coalesce(lang, '') p, doc_id::varchar k, coalesce(text, '') t, strlen(coalesce(text, '')) + 64 w, doc_id = max(doc_id) over () last from documents),
v as (select 1 version, p, k, t, w from d union all select 2, p, k, t || case when last then ' and more' else '' end, w from d),
r as (select *, ('0x' || substr(md5(k), 1, 8))::bigint::double / 4294967296::double < least(1::double, w::double / {SMALL_FILE}::double) begins from v),
s as (select *, coalesce(max(case when begins then k end) over (partition by version, p order by k rows unbounded preceding), '') st, sha256(k || '|' || t) line from r),
f as (select version, p, st, count(*) n, sum(w)::bigint b, {digest_sql("line")} g from s group by all)
select f.version, f.p "partition", f.st "start", f.n "rows", f.b bytes, f.g digest, f.version = 1 or e.g is null written from f left join f e on e.version = 1 and f.version = 2 and e.p = f.p and e.st = f.st and e.g = f.g""")
def file_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of documents by language, and those of a version in which one text has changed: what a commit writes of each."""
    d, text = table(spark, sf_dir, "documents"), F.coalesce("text", F.lit(""))
    keys = d.select(F.coalesce("lang", F.lit("")).alias("partition"), F.col("doc_id").cast("string").alias("key"), text.alias("t"), (F.octet_length(text) + files.ROW_BYTES).cast("long").alias("weight"))
    last = d.agg(F.max("doc_id").cast("string").alias("last"))
    edited = keys.join(F.broadcast(last), keys["key"] == last["last"], "left").withColumn("t", F.when(F.col("last").isNotNull(), F.concat("t", F.lit(" and more"))).otherwise(F.col("t"))).drop("last")
    of = lambda rows: files.file_digests(files.placed_in_files(rows.select("partition", "key", "weight", F.sha2(F.concat_ws("|", "key", "t"), 256).alias("line")), SMALL_FILE))
    first = of(keys)
    second = files.file_changes(of(edited), first.withColumn("path", F.lit("held")))
    out = first.select(F.lit(1).alias("version"), "*", F.lit(True).alias("written"))
    return out.unionByName(second.select(F.lit(2).alias("version"), "partition", "start", "rows", "bytes", "digest", F.col("path").isNull().alias("written")))


@query("""
with r as (select user_id, ts, max(event_id) event_id, max_by(value, event_id) v from events where event_id % 3 = 0 group by all)
select l.event_id, l.user_id, r.event_id carried_from, r.v carried from (select * from events where event_id % 3 <> 0) l asof left join r on l.user_id = r.user_id and l.ts >= r.ts""")
def carried_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the latest of its user's every third events: what a run takes over from the one before."""
    e = table(spark, sf_dir, "events")
    told = e.where("event_id % 3 = 0").select("user_id", "ts", "event_id", "value")
    return asof(e.where("event_id % 3 <> 0").select("event_id", "user_id", "ts"), told, ["user_id"], "ts", slices=4).select("event_id", "user_id", F.col("match.event_id").alias("carried_from"), F.col("match.value").alias("carried"))


_NUMBERS = {"lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"), "orders": ("o_orderkey", "o_custkey", "o_totalprice"), "documents": ("doc_id", "n_chars"), "customer": ("c_custkey", "c_acctbal")}


@query(" union all ".join(f"select '{t}' \"table\", '{c}' \"column\", count(*) \"rows\", count(*) - count({c}) nulls, min({c})::double least, max({c})::double most from {t}" for t, cs in _NUMBERS.items() for c in cs))
def footer_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls and bounds of numeric columns from footers alone; the SQL reads the data."""
    out = None
    for name, columns in _NUMBERS.items():
        found = footers.column_statistics(footers.footers(spark, f"{sf_dir}/{name}.parquet").where(F.col("column").isin(*columns)))
        rows = found.select(F.lit(name).alias("table"), "column", "rows", "nulls", "least", "most")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("select o_orderkey, o_custkey, o_totalprice from orders where o_custkey in (select c_custkey from customer where c_custkey % 97 = 5 and c_acctbal > 0)")
def pruned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of wanted customers, from the files whose footers say that they can hold one."""
    zone_map = footers.zones(footers.footers(spark, f"{sf_dir}/orders.parquet"), "o_custkey")
    wanted = table(spark, sf_dir, "customer").where("c_custkey % 97 = 5 and c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    found = footers.pruned_scan(spark, zone_map, wanted, "o_custkey", 4096.0)
    found = found if found is not None else table(spark, sf_dir, "orders").limit(0)
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
with d as (select coalesce(lang, '') p, coalesce(source, '') s, doc_id, n_chars from documents),
a as (select p, s, count(*) docs, sum(n_chars) chars, max(doc_id) newest from d group by all),
b as (select p, s, count(*) docs, sum(n_chars) chars, max(doc_id) newest from d where not (s = 'src3' and doc_id % 3 = 1) group by all),
j as (select coalesce(a.p, b.p) p, coalesce(a.s, b.s) s, a.docs ad, b.docs bd, a.chars ac, b.chars bc, a.newest an, b.newest bn from a full join b on a.p = b.p and a.s = b.s),
u as (select p || '/' || s "partition", 'docs' "key", ad::varchar before, bd::varchar now from j union all select p || '/' || s, 'chars', ac::varchar, bc::varchar from j union all select p || '/' || s, 'newest', an::varchar, bn::varchar from j)
select * from u where before is distinct from now""")
def recount_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a recount reports after some documents of one source went: partitions whose files didn't change aren't counted again."""
    d = table(spark, sf_dir, "documents").select(F.concat_ws("/", F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))).alias("partition"), "doc_id", "n_chars", F.coalesce("source", F.lit("")).alias("source"))
    later = d.where("not (source = 'src3' and doc_id % 3 = 1)")
    count = lambda rows: rows.groupBy("partition").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"), F.max("doc_id").alias("newest"))
    of = lambda rows: files.file_digests(files.placed_in_files(rows.select("partition", F.col("doc_id").cast("string").alias("key"), F.col("n_chars").alias("weight"), F.sha2(F.col("doc_id").cast("string"), 256).alias("line")), SMALL_FILE))
    changed = recount.changed_partitions(of(d), of(later))
    before = count(d)
    return recount.changed_keys(before, recount.recounted(before, changed, count(later.join(changed, "partition", "left_semi"))))


@query("""
with s as (select c_custkey, case when c_custkey % 4 = 0 then null else 't' end listed_at, case when c_custkey % 5 = 0 then 'Blocked' when c_custkey % 5 = 1 then 'budget' end stopped, c_custkey % 3 - 1 given_up, c_custkey % 7 - 3 missing, c_nationkey % 2 incomplete from customer)
select c_custkey collection, case when listed_at is null then 'never listed' when stopped = 'Blocked' then 'stopped' when given_up > 0 then 'failing' when missing > 0 then 'behind' when incomplete > 0 then 'incomplete' else 'whole' end health from s""")
def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        k.alias("collection"), F.when(k % 4 != 0, "t").alias("listed_at"), F.when(k % 5 == 0, "Blocked").when(k % 5 == 1, "budget").alias("stopped"),
        (k % 3 - 1).alias("given_up"), (k % 7 - 3).alias("missing"), (F.col("c_nationkey") % 2).alias("incomplete"),
    )
    return recount.source_health(rows).select("collection", "health")
