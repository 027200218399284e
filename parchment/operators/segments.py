"""Page spans: gaps and islands over a file's pages, as windows on (file, page)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def page_spans(pages: DataFrame, file: str, page: str, start: str, stop: str) -> DataFrame:
    """(file, first, last) of every span: from a start page to the page before the next start, or before the first stop
    page after it.  start and stop are boolean columns; pages before the first start belong to no span.

    One exchange by file: the span number, its end and its first stop come from the same partitioning.
    """
    w = Window.partitionBy(file).orderBy(page)
    numbered = pages.select(file, page, F.col(start).alias("_start"), F.col(stop).alias("_stop")).withColumn("_span", F.sum(F.col("_start").cast("int")).over(w)).where("_span > 0")
    return (
        numbered.groupBy(file, "_span")
        .agg(F.min(page).alias("first"), F.max(page).alias("_end"), F.min(F.when(F.col("_stop") & ~F.col("_start"), F.col(page))).alias("_cut"))
        .select(file, "first", F.coalesce(F.col("_cut") - 1, F.col("_end")).alias("last"))
    )


def next_start(anchors: DataFrame, starts: DataFrame, file: str, page: str) -> DataFrame:
    """anchors with next_start: the least page of starts of the same file after theirs, by one window over both."""
    kept = anchors.columns
    both = anchors.withColumn("_own", F.lit(True)).unionByName(starts.select(file, page).distinct().withColumn("_own", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(file).orderBy(page).rangeBetween(1, Window.unboundedFollowing)
    return both.withColumn("next_start", F.min(F.when(~F.col("_own"), F.col(page))).over(w)).where("_own").select(*kept, "next_start")


def running_headings(rows: DataFrame, by: list[str], seq: str, levels: list[str]) -> DataFrame:
    """Each level's latest heading at every row; a heading of a level clears the lower ones."""
    w = Window.partitionBy(*by).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    out, since = rows, None
    for level in levels:
        at = F.max(F.when(F.col(level).isNotNull(), F.col(seq))).over(w)
        out = out.withColumn(f"_{level}_at", at if since is None else F.when(F.coalesce(at >= F.col(since), F.col(since).isNull()), at))
        since_new = f"_{level}_since"
        out = out.withColumn(since_new, F.greatest(F.col(f"_{level}_at"), *([F.col(since)] if since else [F.lit(None).cast(rows.schema[seq].dataType)])))
        out = out.withColumn(f"running_{level}", F.when(F.col(f"_{level}_at").isNotNull(), F.last(level, ignorenulls=True).over(w)))
        since = since_new
    return out.drop(*[c for x in levels for c in (f"_{x}_at", f"_{x}_since")])
