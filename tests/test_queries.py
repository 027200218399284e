"""Every query with SQL against DuckDB, and every query's partitions don't matter."""

import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = __spark_entry__.queries(), __spark_entry__.oracle_sql()
BASE = [n for n in ORACLE if not n.startswith(("op", "pipeline"))]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    return con


def normal(rows):
    return sorted(str([repr(float(x)) if isinstance(x, float) else str(x) for x in r]) for r in rows)


@pytest.mark.parametrize("name", BASE)
def test_against_sql(spark, duck, name):
    df, want = QUERIES[name](spark, SF), duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert normal(map(tuple, df.collect())) == normal(tuple(r[i] for i in at) for r in want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["sync_plan", "unit_fingerprint", "page_spans", "top_title_first_seen", "assemble_cases", "fallback_anti", "source_signature"])
def test_partitioning_does_not_matter(spark, name):
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append(normal(map(tuple, QUERIES[name](spark, SF).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]
