"""Centroid clustering, collocations and near-duplicate vectors against their SQL over awkward tables, and by parts."""

from __future__ import annotations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parchment.llm import collocations, embedding_dedup, hamerly
from parchment.llm.corpus_sql import clusters_sql, collocations_sql, grouped_sql

VECTORS = "vec_id long, embedding array<double>, cluster string, links int"
TEXTS = "doc_id long, text string, lang string, phrase string"


def by_sql(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    out = con.execute(sql).to_arrow_table()
    return sorted(map(str, out.select(sorted(out.column_names)).to_pylist()))


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).toArrow().to_pylist()))


def vectors(spark, x, ids=None):
    return spark.createDataFrame([(i, [float(v) for v in r], "c", 1) for i, r in zip(ids or range(len(x)), x, strict=True)], VECTORS)


def odd_vectors(size):
    nan, inf = float("nan"), float("inf")
    one = [0.5] * size
    return [(900, None, "c", 1), (901, [], "c", 1), (902, [0.0] * size, "c", 1), (903, [nan, *one[1:]], "c", 1), (904, [inf, *one[1:]], "c", 1), (905, [None, *one[1:]], "c", 1), (906, one[1:], "c", 1), (None, one, "c", 1), (907, one, "c", 1), (907, one, "c", 1), (907, [-v for v in one], "c", 1), (908, [-0.0, *one[1:]], "c", 1), (909, [0.0, *one[1:]], "c", 1)]


# ---- 11 centroids


def test_clusters_by_sql(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate((rng.normal(0, 0.3, (150, 64)), np.round(rng.normal(0, 1, (40, 64))), np.repeat(rng.normal(0, 1, (1, 64)), 60, 0)))
    df = vectors(spark, x).union(spark.createDataFrame(odd_vectors(64), VECTORS)).repartition(5)
    assert rows(hamerly.clusters(df)) == by_sql(clusters_sql(), embeddings=df.select("vec_id", "embedding"))


@pytest.mark.parametrize("n", [0, 1, 3])
def test_clusters_of_few(spark, n):
    df = vectors(spark, np.full((3, 64), 2.0)).limit(n)
    got = hamerly.clusters(df).collect()
    assert len(got) == n and all(r.distance == 0 and r.inertia == 0 for r in got)
    assert hamerly.clusters(df).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_huge_components_are_limited(spark):
    got = hamerly.clusters(vectors(spark, [[1e300] * 64, [-1e300] * 64, [0.0] * 64]), count=1, rounds=1).collect()
    assert max(r.distance for r in got) == 64 * hamerly.LIMIT**2 and max(r.inertia for r in got) > 0


@pytest.mark.parametrize("scale", [4, 200, 1 << 25])
def test_bounds_change_nothing(scale):
    """Rounds with bounds equal full scans, ties included, and scan less."""
    rng = np.random.default_rng(scale)
    x = rng.integers(-scale, scale, (12, 8))[rng.integers(0, 12, 3000)] + rng.integers(-scale // 4, scale // 4 + 1, (3000, 8))
    now = x[:9].astype(np.int64)
    a, upper, lower = hamerly.scan(x, now)
    scanned = 0
    for _ in range(8):
        before, now = now, np.array([np.floor_divide(x[a == k].sum(0), max((a == k).sum(), 1)) if (a == k).any() else now[k] for k in range(9)])
        a, upper, lower, n = hamerly.reassign(x, a, upper, lower, hamerly.Moves(now, before))
        scanned += n
        d = ((x[:, None].astype(object) - now[None].astype(object)) ** 2).sum(2)
        assert (a == d.argmin(1)).all()
        assert (upper**2 >= d[np.arange(len(x)), a].astype(float)).all()
    assert 0 < scanned < 0.7 * 8 * len(x)


# ---- 12 phrases


def odd_texts():
    some = ["New York city is big. New York city\tis far, new york City!", "a b a b a b a b", "x; y: z? x y z\nx y z\x0bx y z\x0cx\ry z", "É é É é and ß ß ß", "no break word no break word", "the the the the", ""]
    return [(i, t, lang, "p") for i, (t, lang) in enumerate([(t, lang) for lang in ("en", "fr", None) for t in some for _ in range(6)])] + [(None, None, "en", "p"), (99, "w1 w2 w3 . " * 9000, "en", "p"), (99, "long" * 50_000 + " tail", None, "p"), (100, " \t. ,", "xx", "p")]


@pytest.mark.parametrize(("least", "covered"), [(10, 50), (3, 90), (1, 101)])
def test_collocations_by_sql(spark, least, covered):
    df = spark.createDataFrame(odd_texts(), TEXTS).repartition(6)
    got = collocations.collocations(df, least=least, covered=covered, top=40)
    assert rows(got) == by_sql(collocations_sql(least, covered, 40), documents=df)


def test_no_phrases(spark):
    df = spark.createDataFrame(odd_texts(), TEXTS)
    for some in (df.limit(0), df.where("text is null"), df.where("lang = 'xx'")):
        assert collocations.collocations(some).collect() == []


def test_scores_pass_64_bits(spark):
    big = spark.createDataFrame([("en", "a b", 90_000_000_000_000)], "lang string, phrase string, a long")
    one = spark.createDataFrame([("en", "a", 90_000_000_000_001), ("en", "b", 90_000_000_000_007)], "lang string, phrase string, a long")
    (row,) = collocations._scored(big, 2, [one, big]).collect()
    assert row.score == 10**6 * row.a**2 // (row.l * row.r)


def test_lists_hold_positions():
    (batch,) = collocations._segment(pa.table({"lang": ["en", "en"], "text": ["b a. A b", "a b"]}))
    words, counts = batch.column("words")[0].as_py(), batch.column("counts")[0].as_py()
    at = np.split(np.cumsum(np.frombuffer(batch.column("positions")[0].as_py(), np.int32)), np.cumsum(counts)[:-1])
    assert dict(zip(words, [x.tolist() for x in at], strict=True)) == {"b": [0, 4, 7], "a": [1, 3, 6]}


def test_filter_holds_back_nothing_frequent(spark):
    phrases = [f"word{i} other{i * 7}" for i in range(5000)]
    f = collocations.filter_of(spark.createDataFrame([("en", p) for p in phrases], "lang string, phrase string"))
    assert f.has("en", pa.array(phrases)).all() and f.has("fr", pa.array(phrases)).mean() < 0.01
    assert not len(f.has("en", pa.array([], pa.string())))


# ---- 13 vectors


def planted(rng, n, size, groups):
    """Vectors, some of them moved away from others by every angle round the threshold."""
    x = rng.normal(size=(n, size))
    for i in range(groups):
        base = x[rng.integers(n)] / 1.0
        noise = rng.normal(size=size)
        noise -= base * (noise @ base) / (base @ base)
        t = rng.uniform(0.85, 1.0)
        x[rng.integers(n)] = t * base / np.linalg.norm(base) + np.sqrt(1 - t * t) * noise / np.linalg.norm(noise)
    return x


@pytest.mark.parametrize("size", [2, 3, 64])
@pytest.mark.parametrize("exact", [False, True])
def test_groups_by_sql(spark, monkeypatch, size, exact):
    """Many cells and blocks: exact visits lose nothing, and data of few dimensions get them anyway."""
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 40)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(size)
    x = planted(rng, 240 if size > 3 else 60, size, 80 if size > 3 else 0)
    x[:30] = x[0] * 3
    x[30:45] = x[0] + rng.normal(0, 1e-3, (15, size))
    df = vectors(spark, x).union(spark.createDataFrame(odd_vectors(size), VECTORS)).repartition(3)
    got = embedding_dedup.grouped(df, exact=exact)
    assert rows(got) == by_sql(grouped_sql(), embeddings=df.select("vec_id", "embedding"))


def test_recall_by_cells(spark, monkeypatch):
    """Links found with visits of the default reach, over vectors that fill 64 dimensions and pairs just above the threshold."""
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 50)
    rng = np.random.default_rng(1)
    x = planted(rng, 2500, 64, 1500)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = ((u @ u.T >= 0.9).sum(1) - 1).tolist()
    got = {r.vec_id: r.n_links for r in embedding_dedup.grouped(vectors(spark, x)).collect()}
    assert sum(got.values()) >= 0.995 * sum(want) and all(got[i] <= n for i, n in enumerate(want))


def test_no_vectors(spark):
    df = spark.createDataFrame(odd_vectors(4), VECTORS)
    assert embedding_dedup.grouped(df.limit(0)).collect() == []
    none = embedding_dedup.grouped(df.where("vec_id between 900 and 905")).collect()
    assert len(none) == 6 and all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in none)


def test_stars_span_links():
    """Stars join what links join, also where a vertex's least neighbour isn't its component's least."""
    rng = np.random.default_rng(5)
    for _ in range(50):
        n = 30
        a = rng.random((n, n)) < 0.04
        a |= a.T
        np.fill_diagonal(a, False)
        reach = np.linalg.matrix_power((a | np.eye(n, dtype=bool)).astype(float), n) > 0
        vertex, star = embedding_dedup.stars(a, np.arange(n), np.arange(n))
        label = np.arange(n)
        for _ in range(n):
            for v, s in zip(vertex, star, strict=True):
                label[label == max(label[v], label[s])] = min(label[v], label[s])
        assert ((label[:, None] == label[None]) == reach).all()


def test_registered_over_whole_tables(spark):
    from parchment.llm.entries import QUERIES

    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert QUERIES["op11_centroid_clustering"](spark, sf).count() == n == QUERIES["op13_embedding_dedup"](spark, sf).agg(F.countDistinct("vec_id")).first()[0]
