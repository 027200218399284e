"""Recounts by what changed: a version's summary from the one before, reading changed partitions only, and the keys that differ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_partitions(before: DataFrame, now: DataFrame) -> DataFrame:
    """(partition) with a file (partition, start, digest) that only one version has."""
    key = ["partition", "start", "digest"]
    tagged = before.select(*key, F.lit(1).alias("v")).unionByName(now.select(*key, F.lit(2).alias("v")))
    return tagged.groupBy(*key).agg(F.count_distinct("v").alias("n")).where("n = 1").select("partition").distinct()


def recounted(summary: DataFrame, changed: DataFrame, counted: DataFrame, by: str = "partition") -> DataFrame:
    """The summary now: of partitions that didn't change as it was, of the others as counted from their rows now.

    counted has no row for a partition that is gone, so it leaves the summary.
    """
    names = changed.select(F.col(changed.columns[0]).alias(by)).distinct()
    return summary.join(names, by, "left_anti").unionByName(counted)


def changed_keys(before: DataFrame, now: DataFrame, by: str = "partition") -> DataFrame:
    """(by, key, before, now) of every value of two summaries that differs, null-safe; values as text."""
    columns = [c for c in now.columns if c != by]
    text = lambda c: F.to_json(c) if dict(now.dtypes)[c].startswith(("map", "struct", "array")) else F.col(c).cast("string")
    old = before.select(by, *(text(c).alias(f"_{c}") for c in columns))
    both = now.select(by, *(text(c).alias(c) for c in columns)).join(old, by, "full_outer")
    pairs = F.array(*(F.struct(F.lit(c).alias("key"), F.col(f"_{c}").alias("before"), F.col(c).alias("now")) for c in columns))
    return both.select(by, F.explode(pairs).alias("p")).select(by, "p.*").where(~F.col("before").eqNullSafe(F.col("now")))


#: What a source's health is told by, the first that applies: (test over a collection's status, its name).
HEALTH = (("listed_at is null", "never listed"), ("stopped is not null and stopped <> 'budget'", "stopped"), ("given_up > 0", "failing"), ("missing > 0", "behind"), ("incomplete > 0", "incomplete"))


def source_health(statuses: DataFrame) -> DataFrame:
    """statuses (collection, listed_at, stopped, given_up, missing, incomplete) with health."""
    health = F.lit("whole")
    for test, name in reversed(HEALTH):
        health = F.when(F.expr(test), name).otherwise(health)
    return statuses.withColumn("health", health)
