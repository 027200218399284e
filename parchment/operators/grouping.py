"""Entries to units, fingerprints, roll-ups: the aggregates, all with map-side partials and no unbounded task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parchment.functions.text import PRIVATE_USE


def group_units(entries: DataFrame, key: str = "id", seq: str = "seq", partition: str = "partition", url: str = "url", entry: str = "entry") -> DataFrame:
    """One row for each file: first url, least partition, entries in order of seq.

    A file's entries are the links to it; their number is bounded by the listing, not by the corpus.
    """
    return entries.groupBy(key).agg(
        F.min_by(url, seq).alias(url),
        F.min(partition).alias(partition),
        F.transform(F.array_sort(F.collect_list(F.struct(seq, entry))), lambda x: x[entry]).alias("entries"),
    )


def line_digest(lines: Column) -> Column:
    """Digest of a group's lines as a multiset, whatever their order: the number of lines and the sums of four parts of
    their hashes.  Sums have map-side partials, so a group of any size is one row a task.
    """
    h = F.sha2(lines, 256)
    sums = [F.sum(F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    return F.sha2(F.concat_ws(":", F.count(lines), *(F.coalesce(x, F.lit(0)).cast("string") for x in sums)), 256)


def partition_fingerprints(units: DataFrame, partition: str = "partition", key: str = "id", fingerprint: str = "fingerprint") -> DataFrame:
    """Digest of the lines 'id<tab>fingerprint' of each partition."""
    return units.groupBy(partition).agg(line_digest(F.concat(F.col(key), F.lit("\t"), F.col(fingerprint))).alias("fingerprint"))


def summarize(rows: DataFrame, partition: str = "partition") -> DataFrame:
    """What a partition's rows add up to: counts, sources of text, cross-checks, terms, odd code points.

    One pass over the named columns; file bytes are never read.
    """
    private = F.regexp_count("text", F.lit(PRIVATE_USE))
    odd = F.regexp_count("text", F.lit("�"))
    checked = F.col("xcheck_equal").isNotNull()
    out = rows.groupBy(partition).agg(
        F.count("*").alias("rows"),
        F.count_if("listed").alias("listed"),
        F.count_if(~F.col("listed")).alias("delisted"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"),
        F.count_if(checked).alias("checked"),
        F.count_if(checked & F.col("xcheck_equal")).alias("equal"),
        F.count_if(checked & F.coalesce("xcheck_equal_nfkd", F.lit(False))).alias("equal_nfkd"),
        F.coalesce(F.max(F.when(checked, F.coalesce("xcheck_delta", F.lit(0)))), F.lit(0)).alias("max_delta"),
        F.min("term").alias("first_term"),
        F.max("term").alias("last_term"),
        F.count_if(F.col("term").isNull()).alias("undated"),
        F.count_if(private > 0).alias("private_use_rows"),
        F.coalesce(F.sum(private), F.lit(0)).alias("private_use"),
        F.count_if(odd > 0).alias("replacement_rows"),
        F.coalesce(F.sum(odd), F.lit(0)).alias("replacement"),
    )
    sources = rows.groupBy(partition, F.coalesce("text_source", F.lit("none")).alias("s")).count().groupBy(partition).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("s", "count")))).alias("text_sources"))
    return out.join(sources, partition)


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys of more than one row, with their number."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def first_most_common(rows: DataFrame, by: list[str], value: str, seq: str) -> DataFrame:
    """Each group's most frequent value; of equals the one seen first.

    Counting comes first, so a window sorts distinct values and not rows.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"), F.min(seq).alias("first"))
    best = F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), F.col("first"))).alias("b")
    return counts.groupBy(*by).agg(best).select(*by, f"b.{value}", "b.n")


def with_total(rows: DataFrame, by: str, *aggregates: Column) -> DataFrame:
    """One row for each value of by, and one of all (by null, is_total true)."""
    return rows.rollup(by).agg(F.grouping(by).cast("boolean").alias("is_total"), *aggregates)


def newest(runs: DataFrame, by: list[str], at: str, keep: int) -> DataFrame:
    """The latest so many rows of each group."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(at)))
    return runs.withColumn("_n", rank).where(F.col("_n") <= keep).drop("_n")


def term_span(partitions: DataFrame, first: str = "first_term", last: str = "last_term") -> DataFrame:
    """Every term that some partition's range covers."""
    return partitions.where(F.col(first).isNotNull() & F.col(last).isNotNull()).select(F.explode(F.sequence(first, last)).alias("term")).distinct()


def seeded_sample(rows: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n rows in an order that key and seed decide: equal on every run and partitioning."""
    return rows.orderBy(F.sha2(F.concat(F.col(key).cast("string"), F.lit(seed)), 256), key).limit(n)
