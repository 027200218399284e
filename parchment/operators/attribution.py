"""Attaching documents to cases: many-to-many keys, consolidation, and fallbacks in order of trust."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def consolidated(held: DataFrame, named: DataFrame, case: str, other: str, doc: list[str]) -> DataFrame:
    """(case, doc) rows that named adds: a document named beside another case, unless that case holds it already.

    named has the document's own case and the other one; it is read once, so consolidation isn't transitive.
    """
    wanted = named.where(F.col(case) != F.col(other)).select(F.col(other).alias(case), *doc).distinct()
    return wanted.join(held.select(case, *doc).distinct().alias("h"), _same([case, *doc], wanted, "h"), "left_anti")


def _same(columns: list[str], left: DataFrame, right: str) -> Column:
    test = F.lit(True)
    for c in columns:
        test = test & left[c].eqNullSafe(F.col(f"{right}.{c}"))  # unknown pages are equal to unknown pages
    return test


def fallback(wanted: DataFrame, held: DataFrame, case: list[str], doc: list[str], strong: Column) -> DataFrame:
    """wanted rows of cases that hold no strong document and not this document either: two anti joins in turn."""
    strong_cases = held.where(strong).select(*case).distinct()
    rest = wanted.join(strong_cases, case, "left_anti")
    return rest.join(held.select(*case, *doc).distinct().alias("h"), _same([*case, *doc], rest, "h"), "left_anti")


def assemble(cases: DataFrame, parts: DataFrame, key: str, seq: str, value: str, out: str) -> DataFrame:
    """cases with out: the values of their parts in order of seq, empty where there are none."""
    lists = parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(seq, value))), lambda x: x[value]).alias(out))
    return cases.join(lists, key, "left").withColumn(out, F.coalesce(out, F.array().cast(lists.schema[out].dataType)))
