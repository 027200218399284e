"""The stages against brute force, one after another, and the registered queries."""

from __future__ import annotations

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from parchment.llm import entries, secrets
from tests.llm.test_operators import HARD, SF, brute_classes, brute_masked, check_packing


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(50_000 + i if d is not None else None, t, None, "s", 1) for i, (d, t, _) in enumerate(HARD)], docs.schema)
    # rows that repeat an id and a text, and an id with two texts
    twice = docs.where("doc_id < 5").unionByName(docs.where("doc_id = 6").withColumn("text", F.lit("Another text under the same id, of a few words.")))
    docs = docs.unionByName(odd).unionByName(twice).unionByName(odd.where("doc_id is null"))
    rows = lambda: sorted(map(tuple, docs.collect()), key=str)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    before, kept = rows(), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = rows()
    unlabelled = lambda x: [(r[0], r[1], r[3], r[4]) for r in x]
    assert unlabelled(kept["language_id"]) == sorted(unlabelled(r for r in before if any(c.isalpha() for c in r[1] or "")), key=str)
    # one row a class: its least id and, of that id's texts, the least digest
    numbered = {k: i for i, k in enumerate(sorted({(r[0], hashlib.md5(r[1].encode()).digest()) for r in kept["language_id"] if r[0] is not None}))}
    row = lambda r: (r[0], hashlib.md5(r[1].encode()).digest())
    classes = brute_classes(sorted({(numbered[row(r)], r[1]) for r in kept["language_id"] if r[0] is not None}))
    want = {(r[0], r[1]) for r in kept["language_id"] if r[0] is None or classes[numbered[row(r)]] == numbered[row(r)]}
    assert sorted([(r[0], r[1]) for r in kept["minhash"]], key=str) == sorted(want, key=str) and set(kept["minhash"]) <= set(kept["language_id"])
    items = [r.text.lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert kept["decontaminate"] == [r for r in kept["minhash"] if not any(i in r[1].lower() for i in items)]
    spans = {r.text: [(s.kind, s.start, s.end) for s in r.s] for r in secrets.with_spans(spark.createDataFrame(kept["decontaminate"], docs.schema), out="s").collect()}
    masked = [(d, m := brute_masked(t, spans[t]), lang, source, len(m)) for d, t, lang, source, _ in kept["decontaminate"]]
    assert kept["secret_scan"] == sorted(masked, key=str) and kept["secret_scan"] != kept["decontaminate"]
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), [(r[0], r[1]) for r in kept["secret_scan"]])


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and rows[0].__fields__ == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_registered():
    names = set(__spark_entry__.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert set(entries.QUERIES) <= names


@pytest.mark.parametrize("name", sorted(entries.ORACLE))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df, want = __spark_entry__.queries()[name](spark, SF), con.sql(entries.ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(str(tuple(r[i] for i in at)) for r in want.fetchall())


def test_native_queries_run_no_python(spark):
    for name in ("op9_secret_scan", "op10_pii"):
        plan = __spark_entry__.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert secrets.with_spans(spark.range(1).select(F.lit("x").alias("text"))).count() == 1
