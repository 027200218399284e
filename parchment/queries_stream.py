"""Queries that run a stream to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.queries import query, table
from parchment.session import shared_folder
from parchment.streaming import file_states
from parchment.streaming.file_states import ENDED, EVENTS, FAILED, LISTED, STORED

#: Days of events that the stream sees before it is started again.
RESTART_AFTER = 15
#: Events for one bucket; a task holds a bucket's events of a batch and its files.
BUCKET_EVENTS = 50_000


@query("""
with e as (select user_id, event_id, date_trunc('second', ts) t, day(ts) run, case event_type when 'error' then 'failed' when 'purchase' then 'stored' else 'listed' end kind, event_type from events),
links as (select user_id, run, arg_min(event_type, event_id) line from e where kind = 'listed' group by all),
r as (select run, max(t) t from e group by run),
i as (select user_id, min(run) filter (kind = 'stored') first_stored from e group by user_id),
g as (select i.user_id, r.run, r.t, l.line is not null live, l.line, coalesce(i.first_stored < r.run, false) known, i.first_stored from i cross join r left join links l on l.user_id = i.user_id and l.run = r.run),
o as (select *, min(case when kind = 'stored' then run end) over (partition by user_id order by run, event_id rows between 1 following and unbounded following) next_stored from e where kind <> 'listed'),
f as (select o.user_id, o.run, o.event_id, o.t, least(coalesce(o.next_stored, 99), coalesce((select min(g.run) from g where g.user_id = o.user_id and not g.live and g.run > o.run), 99)) counts_to from o where kind = 'failed'),
w as (select g.user_id, g.run, count(*) n, max(f.t) last from g join f on f.user_id = g.user_id and f.run < g.run and g.run <= f.counts_to group by all),
p as (select g.*, coalesce(w.n >= 3 and w.last + interval 24 hours > g.t, false) waits, coalesce(lag(live) over s, false) was,
 last_value(case when live and g.run >= first_stored then line end ignore nulls) over (partition by g.user_id order by g.run rows between unbounded preceding and 1 preceding) kept
 from g left join w on w.user_id = g.user_id and w.run = g.run window s as (partition by g.user_id order by g.run)),
a as (select user_id, count(*) filter (live and not known and not waits) fetches, count(*) filter (live and not known and waits) skips, count(*) filter (known and not live and was) delists,
 count(*) filter (known and live and not was) relists, count(*) filter (known and live and line is distinct from kept) updates, arg_max(live, run) last from p group by user_id),
n as (select user_id, count(*) attempts from f where counts_to = 99 group by user_id)
select 'f' || a.user_id id, fetches, skips, delists, relists, updates, first_stored is not null known, first_stored is not null and a.last listed, coalesce(n.attempts, 0)::int attempts
from a join i on i.user_id = a.user_id left join n on n.user_id = a.user_id where a.user_id in (select user_id from links)""")
def listing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream of listings, a day each, did with every file and what it knows in the end; it is started again half-way."""
    e, day = table(spark, sf_dir, "events"), F.dayofmonth("ts").cast("long")
    at = F.date_trunc("second", F.col("ts")).cast("timestamp")
    kind = F.when(F.col("event_type") == "error", FAILED).when(F.col("event_type") == "purchase", STORED).otherwise(LISTED)
    told = e.select(kind.alias("kind"), day.alias("run"), F.col("event_id").alias("seq"), at.alias("at"), F.concat(F.lit("f"), "user_id").alias("id"), F.col("event_type").alias("partition"), F.col("event_type").alias("line"))
    ends = told.groupBy("run").agg(F.max("at").alias("at")).select(F.lit(ENDED).alias("kind"), "run", F.lit(None).cast("long").alias("seq"), "at", *(F.lit(None).cast("string").alias(c) for c in ("id", "partition", "line")))
    both, root = told.unionByName(ends), shared_folder(spark, "listing-stream")
    buckets = max(16, -(-e.count() // BUCKET_EVENTS))
    for part in (both.where(F.col("run") <= RESTART_AFTER), both.where(F.col("run") > RESTART_AFTER)):
        part.write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema(EVENTS).parquet(f"{root}/events")
        file_states.run(stream, f"{root}/actions", f"{root}/checkpoint", buckets=buckets).awaitTermination()
    done = spark.read.schema(file_states.ACTIONS).parquet(f"{root}/actions").where("action <> 'retry'")
    counts = done.groupBy("id").agg(*(F.count_if(F.col("action") == a).alias(n) for a, n in (("fetch", "fetches"), ("skip", "skips"), ("delist", "delists"), ("relist", "relists"), ("update", "updates"))))
    now = file_states.states(spark, f"{root}/checkpoint").select("id", "known", "listed", "attempts")
    filled = (F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in (("known", False), ("listed", False), ("attempts", 0)))
    return counts.join(now, "id", "left").select(*counts.columns, *filled)
