"""Checks of stored data as constraint queries: every violation is one row (scope, key, problem)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parchment.operators.grouping import line_digest
from parchment.schema import ALL_SOURCES, OCR_SOURCES, TEXT_SOURCES


def row_problems(rows: DataFrame) -> DataFrame:
    """Violations that single rows show, in one pass over six columns and two null tests; file bytes aren't read."""

    def rule(test: Column, text: Column | str) -> Column:
        return F.when(test, F.lit(text) if isinstance(text, str) else text)

    source, has_text, has_ocr = F.col("text_source"), F.col("text").isNotNull(), F.col("ocr_text").isNotNull()
    wrong = (has_text != F.coalesce(source.isin(*TEXT_SOURCES), F.lit(False))) | (has_ocr != F.coalesce(source.isin(*OCR_SOURCES), F.lit(False)))
    state = lambda c: F.when(c, "set").otherwise("null")
    rules = F.array_compact(
        F.array(
            rule(F.col("id").isNull(), "null id"),
            rule(~F.col("partition").eqNullSafe(F.col("_stored_in")), F.concat(F.lit("row with partition "), F.coalesce("partition", F.lit("null")))),
            rule(~F.coalesce(source.isin(*ALL_SOURCES), F.lit(False)), F.concat(F.lit("text_source "), F.coalesce(source, F.lit("null")))),
            rule(wrong, F.concat(F.lit("is "), F.coalesce(source, F.lit("null")), F.lit(" with text "), state(has_text), F.lit(" and ocr_text "), state(has_ocr))),
            rule(F.col("file_sha256").isNull(), "no file_sha256"),
        )
    )
    return rows.select(F.col("_stored_in").alias("scope"), F.col("id").alias("key"), F.explode(rules).alias("problem"))


def duplicate_ids(rows: DataFrame) -> DataFrame:
    return rows.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("all").alias("scope"), F.col("id").alias("key"), F.concat(F.lit("id in "), "n", F.lit(" rows")).alias("problem"))


def manifest_problems(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Partitions whose counts or ids differ from what the manifest (partition, rows, listed, ids_sha256) says, and those only one side has."""
    digest = line_digest(F.col("id"))
    found = rows.groupBy(F.col("_stored_in").alias("partition")).agg(F.count("*").alias("n"), F.count_if("listed").alias("l"), digest.alias("d"))
    both = manifest.join(found, "partition", "full_outer")
    count = lambda a, b, what: F.when(~F.col(a).eqNullSafe(F.col(b)), F.concat_ws(" ", F.coalesce(F.col(a), F.lit(0)), F.lit(f"{what}, the manifest says"), F.coalesce(F.col(b), F.lit(0))))
    rules = F.array_compact(
        F.array(
            F.when(F.col("rows").isNull(), F.lit("not in the manifest")),
            F.when(F.col("rows").isNotNull() & (F.col("rows") > 0) & F.col("n").isNull(), F.lit("in the manifest but not stored")),
            F.when(F.col("rows").isNotNull() & F.col("n").isNotNull(), count("n", "rows", "rows")),
            F.when(F.col("rows").isNotNull() & F.col("n").isNotNull(), count("l", "listed", "listed rows")),
            F.when(F.col("d").isNotNull() & F.col("ids_sha256").isNotNull() & (F.col("d") != F.col("ids_sha256")), F.lit("the ids differ from the manifest's")),
        )
    )
    return both.select(F.col("partition").alias("scope"), F.lit(None).cast("string").alias("key"), F.explode(rules).alias("problem"))


def deep_problems(rows: DataFrame) -> DataFrame:
    """Rows whose bytes don't have their recorded hash and size; reads the files, so it is asked for."""
    bad = F.when(F.sha2("file", 256) != F.col("file_sha256"), "file_sha256 differs from the bytes").when(F.octet_length("file") != F.col("file_size"), "file_size differs from the bytes")
    return rows.select(F.col("_stored_in").alias("scope"), F.col("id").alias("key"), bad.alias("problem")).where("problem is not null")


def verify(rows: DataFrame, manifest: DataFrame, deep: bool = False) -> DataFrame:
    """Every problem of rows, which carry _stored_in, the partition whose folder they lie in."""
    out = row_problems(rows).unionByName(duplicate_ids(rows)).unionByName(manifest_problems(rows, manifest))
    return out.unionByName(deep_problems(rows)) if deep else out
