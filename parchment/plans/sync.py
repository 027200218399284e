"""The sync plan: what a listing and the stored snapshot say about every file, as one full outer join.

Nothing here acts; the plan is a DataFrame of boolean columns, because one row can be relisted, updated and
asked about at once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values
MAX_ATTEMPTS = 3
RETRY_HOURS = 24
LEASE_MINUTES = 45
RECHECK_CURRENT_HOURS, RECHECK_FOUND_HOURS, RECHECK_MISSING_HOURS = 6, 24 * 7, 24 * 30
ERROR_CHARS = 300
LISTING_COLUMNS = ("url", "term", "date", "docket", "title", "entries")


@dataclass(frozen=True)
class Options:
    """What a run was asked to do."""

    now: str
    current_term: int
    mutable: bool = False
    refetch: bool = False
    revalidate_all: bool = False
    held: bool = False


def recent(term: Column, current: int) -> Column:
    return term.isNull() | (term >= current - 1)


def backing_off(attempts: Column, at: Column, now: Column) -> Column:
    """Whether a failure is left alone for now."""
    return F.coalesce((attempts >= MAX_ATTEMPTS) & (at + F.expr(f"INTERVAL {RETRY_HOURS} HOURS") > now), F.lit(False))


def retry_due(failures: DataFrame, now: Column, by: str = "partition", attempts: str = "attempts", at: str = "at") -> DataFrame:
    """Partitions with a failure whose wait is over."""
    return failures.where((F.col(attempts) >= MAX_ATTEMPTS) & (F.col(at) + F.expr(f"INTERVAL {RETRY_HOURS} HOURS") <= now)).select(by).distinct()


def partition_due(mutable: bool, revalidate_all: bool, undated: Column, last_term: Column, current: int) -> Column:
    """Whether a stored partition holds a file to ask about, from its statistics alone."""
    if revalidate_all:
        return F.lit(True)
    if not mutable:
        return F.lit(False)
    return (F.coalesce(undated, F.lit(0)) > 0) | F.coalesce(last_term >= current - 1, F.lit(False))


def changed_on_server(pairs: list[tuple[Column, Column]]) -> Column:
    """Whether a sent validator differs from the stored one; none sent counts as changed."""
    sent = [new.isNotNull() for _, new in pairs]
    differs = [new.isNotNull() & ~old.eqNullSafe(new) for old, new in pairs]
    any_of = lambda cs: F.array_contains(F.array(*cs), F.lit(True))
    return ~any_of(sent) | any_of(differs)


def same_content(media_type: Column, stored_text: Column, text: Column, stored_sha: Column, sha: Column) -> Column:
    """Pages are compared by rendered text, files by bytes; nothing stored is never the same."""
    return F.when(media_type == "text/html", stored_text.isNotNull() & stored_text.eqNullSafe(text)).otherwise(stored_sha.isNotNull() & stored_sha.eqNullSafe(sha))


def sticky(units: DataFrame, homes: DataFrame, key: str = "id", partition: str = "partition") -> DataFrame:
    """units in the partition that holds them already, else the proposed one."""
    kept = [c for c in units.columns if c != partition]
    return units.join(homes.select(key, F.col(partition).alias("_home")), key, "left").select(*kept, F.coalesce("_home", partition).alias(partition))


def sync_plan(units: DataFrame, stored: DataFrame, failures: DataFrame, options: Options, columns: tuple[str, ...] = LISTING_COLUMNS, key: str = "id") -> DataFrame:
    """One row for each file that is listed or stored, with what to do about it.

    Only keys and listing columns take part in the join; file bytes and texts stay where they are.
    """
    now = F.lit(options.now).cast("timestamp_ntz")
    have = [c for c in columns if c in units.columns and c in stored.columns]
    u = units.select(key, F.col("partition").alias("_proposed"), F.struct(*have).alias("_new"), F.lit(True).alias("_in_units"))
    s = stored.select(key, F.col("partition").alias("_home"), F.struct(*have).alias("_old"), F.col("listed").alias("_listed"), F.col("term").alias("_term"), F.lit(True).alias("_in_store"))
    f = failures.select(key, F.col("attempts").alias("_attempts"), F.col("at").alias("_at"))
    rows = u.join(s, key, "full_outer").join(f, key, "left")
    live, known = F.coalesce("_in_units", F.lit(False)), F.coalesce("_in_store", F.lit(False))
    was = F.coalesce("_listed", F.lit(False))
    waiting = backing_off(F.col("_attempts"), F.col("_at"), now)
    both = live & known & ~F.lit(options.refetch)
    plan = rows.select(
        key,
        F.coalesce("_home", "_proposed").alias("partition"),
        (live & (F.lit(options.refetch) | (~known & ~waiting))).alias("fetch"),
        (live & ~known & waiting & ~F.lit(options.refetch)).alias("skip"),
        (known & ~live & was & ~F.lit(options.held)).alias("delist"),
        (both & ~was).alias("relist"),
        (both & ~F.col("_new").eqNullSafe(F.col("_old"))).alias("update"),
        (both & (F.lit(options.revalidate_all) | (F.lit(options.mutable) & recent(F.col("_term"), options.current_term)))).alias("revalidate"),
    )
    # for reports only: the first that applies
    name = F.when(F.col("delist"), "delisted").when(F.col("skip"), "waiting").when(F.col("fetch"), "new").when(F.col("relist"), "relisted").when(F.col("update"), "changed").when(F.col("revalidate"), "checked").otherwise("unchanged")
    return plan.withColumn("action", name)


def forgotten(failures: DataFrame, units: DataFrame, held: bool, key: str = "id") -> DataFrame:
    """Failures to drop: of files that are listed no more, unless a page is held."""
    return failures.limit(0) if held else failures.join(units.select(key), key, "left_anti")


def after_failure(failures: DataFrame, failed: DataFrame, now: Column, key: str = "id") -> DataFrame:
    """The failure table after a run: attempts counted on, errors cut to their first characters."""
    old = failures.select(key, F.col("attempts").alias("_n"))
    new = failed.join(old, key, "left").select(*failed.columns[:], (F.coalesce("_n", F.lit(0)) + 1).alias("attempts"), now.alias("at"))
    new = new.withColumn("error", F.substring("error", 1, ERROR_CHARS))
    return failures.join(failed.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def held_pages(now: DataFrame, last: DataFrame, url: str = "url", entries: str = "entries", explained: str = "explained") -> DataFrame:
    """Pages that had entries and have none: held where that is explained, else an error that ends the run."""
    before = last.select(url, F.col(entries).alias("before"))
    return now.join(before, url, "left").where((F.coalesce(F.col(entries), F.lit(0)) == 0) & (F.coalesce("before", F.lit(0)) > 0)).select(url, "before", F.when(F.coalesce(F.col(explained), F.lit(False)), "held").otherwise("fatal").alias("verdict"))


def majority_check(entries: DataFrame, page: str, term: str, own: str) -> DataFrame:
    """Pages fewer than half of whose dated entries are of their own term, with the other terms in order."""
    dated = entries.where(F.col(term).isNotNull())
    got = dated.groupBy(page, own).agg(F.count("*").alias("dated"), F.count_if(F.col(term) == F.col(own)).alias("in_term"), F.sort_array(F.collect_set(F.when(F.col(term) != F.col(own), F.col(term)))).alias("others"))
    return got.where(F.col("in_term") * 2 < F.col("dated"))


def partition_order(partitions: DataFrame, key: str, stale: Column) -> DataFrame:
    """partitions with place: stale ones first, then the newest key.  One row a partition, so one task sorts few rows."""
    from pyspark.sql import Window

    return partitions.withColumn("place", F.row_number().over(Window.orderBy(F.when(stale, 0).otherwise(1), F.desc(key))))


def term_order(terms: DataFrame, term: str, complete: Column, current: int) -> DataFrame:
    """terms with place: the current and last one, then incomplete ones, then the rest, newest first."""
    from pyspark.sql import Window

    rank = F.when(F.col(term) >= current - 1, 0).when(~complete, 1).otherwise(2)
    return terms.withColumn("place", F.row_number().over(Window.orderBy(rank, F.desc(term))))


def docket_due(age_hours: Column, found: Column, untried: Column, term: Column, current: int) -> Column:
    """Whether to ask for a case page again: never asked, a miss with an address not tried, or old enough."""
    limit = F.when(term >= current - 1, RECHECK_CURRENT_HOURS).when(F.coalesce(found, F.lit(False)), RECHECK_FOUND_HOURS).otherwise(RECHECK_MISSING_HOURS)
    return age_hours.isNull() | (~F.coalesce(found, F.lit(False)) & untried) | (age_hours >= limit)


def live_diff(live: DataFrame, stored: DataFrame, failed: DataFrame, key: str = "id") -> DataFrame:
    """(key, kind) of missing, extra and missing_but_failed ids, by one pass over the tagged ids."""
    tag = lambda df, name: df.select(key).distinct().withColumn("t", F.lit(name))
    sets = tag(live, "live").union(tag(stored, "stored")).union(tag(failed, "failed")).groupBy(key).agg(F.collect_set("t").alias("t"))
    has = lambda name: F.array_contains("t", name)
    kind = F.when(has("live") & ~has("stored") & ~has("failed"), "missing").when(has("live") & ~has("stored") & has("failed"), "missing_but_failed").when(has("stored") & ~has("live"), "extra")
    return sets.select(key, kind.alias("kind")).where("kind is not null")
