"""Content-defined files, the as-of join that places rows in them, footers and zone maps, and writers that lose their lease."""

import bisect
import glob
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parchment.plans import files
from parchment.plans.asof import asof
from parchment.plans.store import Fenced, SnapshotStore, Superseded
from parchment.sources import footers

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("partition", T.StringType()), T.StructField("text", T.StringType()), T.StructField("file", T.BinaryType())])


@pytest.mark.parametrize("slices", [1, 6])
def test_asof_against_brute_force(spark, slices):
    """A hot key, keys without right rows, ties, nulls, and matches that lie slices before."""
    rng = random.Random(slices)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", "c", None])
    left = [(i, key(), rng.choice([None, *range(400)])) for i in range(600)] + [(9999, "only left", 5)]
    right = [(key(), rng.choice([None, *range(0, 400, 9)]), i % 7) for i in range(60)] + [("a", 3, 1), ("a", 3, 2), ("late", 390, 0)]
    want = {}
    for i, k, t in left:
        hits = [(u, v) for x, u, v in right if x == k and k is not None and u is not None and t is not None and u <= t]
        want[i] = max(hits, default=None)
    got = asof(spark.createDataFrame(left, "i int, k string, t int").repartition(4), spark.createDataFrame(right, "k string, t int, v int"), ["k"], "t", slices=slices).collect()
    assert len(got) == len(left) and {r.i: r.match and (r.match.t, r.match.v) for r in got} == want


def test_a_changed_row_changes_its_file_only(spark):
    keys = spark.range(100_000).select(F.lit("p").alias("partition"), F.format_string("%06d", "id").alias("key"), F.lit(100).cast("long").alias("weight"), F.sha2(F.col("id").cast("string"), 256).alias("line"))
    edited = keys.withColumn("line", F.when(F.col("key") == "054321", "changed").otherwise(F.col("line")))
    dropped = keys.where("key <> '054321'")
    of = lambda df: files.file_digests(files.placed_in_files(df, 200_000, slices=3)).cache()
    first = of(keys)
    n = first.count()
    assert 25 < n < 85 and first.agg(F.sum("rows")).first()[0] == 100_000  # 50 files of 200,000 bytes
    for now in (edited, dropped):
        plan = files.file_changes(of(now), first.withColumn("path", F.lit("held")))
        fresh = plan.where("path is null").collect()
        assert len(fresh) == 1 and fresh[0].start <= "054321"
    starts = sorted(r.start for r in first.collect())
    placed = files.placed_in_files(keys, 200_000, slices=3).where("key > '099990' or key < '000009'").collect()
    assert all(r.start == starts[bisect.bisect_right(starts, r.key) - 1] for r in placed)


def rows_of(spark, texts):
    return spark.createDataFrame([(f"id{i:05d}", f"OT{i % 3}", t, t.encode()) for i, t in texts.items()], SCHEMA)


def test_a_commit_writes_changed_files_only(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s", SCHEMA, file_bytes=6000)
    texts = {i: f"text of {i}" * 5 for i in range(900)}
    first = store.commit(rows_of(spark, texts), store.manifest())
    paths = set(store.paths())
    assert 12 < len(paths) and store.files().agg(F.sum("rows")).first()[0] == 900 == store.read().count()
    assert {r.partition for r in store.read(["OT1"]).collect()} == {"OT1"} and len(store.paths(["OT1"])) < len(paths)
    texts[450] = "other" * 10
    second = store.commit(rows_of(spark, texts), first)
    now = set(store.paths())
    assert len(now - paths) == 1 and len(paths - now) == 1 and second["partitions"]["OT0"]["rows"] == 300
    assert {r.id: r.text for r in store.read().collect()} == {f"id{i:05d}": t for i, t in texts.items()}
    assert {r.id: r.text for r in store.read(manifest=first).collect()}["id00450"] == "text of 450" * 5  # the version before is whole
    third = store.commit(rows_of(spark, {i: t for i, t in texts.items() if i % 3 == 1}), second)
    assert set(store.paths()) == now and third["partitions"] == second["partitions"]
    placed = store.read_placed()
    assert placed.where("_stored_in <> partition or _stored_in is null").count() == 0 and placed.count() == 900
    # what two versions name stays, the rest goes
    assert store.vacuum(keep=1) and store.read().count() == 900
    with pytest.raises(Superseded):
        store.commit(rows_of(spark, texts), first)


def test_null_and_repeated_ids_are_kept(spark, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/s", SCHEMA, file_bytes=200)
    rows = [(None, "P", "a", None), ("x", "P", "b", b"1"), ("x", "P", "b", b"1"), ("x", "P", "c", None), ("y", None, None, None), ("z", "P", "", b"")]
    store.commit(spark.createDataFrame(rows, SCHEMA), store.manifest())
    got = sorted(((r.id, r.partition, r.text, r.file if r.file is None else bytes(r.file)) for r in store.read().collect()), key=str)
    assert got == sorted(rows, key=str) and store.manifest()["partitions"][""]["rows"] == 1


def test_a_writer_that_lost_its_lease_cannot_commit(spark, tmp_path):
    slow, quick = (SnapshotStore(spark, f"file://{tmp_path}/s", SCHEMA) for _ in range(2))
    base = slow.manifest()
    token = slow.acquire("slow", "2026-09-01T00:00:00")
    slow.renew(token, "slow", "2026-09-01T00:10:00")
    assert quick.leases()[-1] | {} == {"by": "slow", "at": "2026-09-01T00:10:00", "ended": False, "token": 1}
    later = quick.acquire("quick", "2026-09-01T02:00:00")  # slow sleeps past its lease
    assert later == token + 1
    for attempt in (lambda: slow.renew(token, "slow", "2026-09-01T02:01:00"), lambda: slow.commit(rows_of(spark, {1: "slow"}), base, token=token)):
        with pytest.raises(Fenced):
            attempt()
    quick.commit(rows_of(spark, {1: "quick"}), base, token=later)
    assert slow.vacuum() == []  # quick is at work
    quick.renew(later, "quick", "2026-09-01T02:02:00", ended=True)
    assert [r.text for r in slow.read().collect()] == ["quick"] and [x["ended"] for x in slow.leases()] == [False, True]
    with pytest.raises(Superseded):  # of two that want one token, one gets it
        slow._create(f"_leases/{later:09d}.json", "{}")


def many_files(folder, n=20):
    """Files of 100 terms each, in two row groups; the last has a column without statistics."""
    os.makedirs(folder)
    for i in range(n):
        t = pa.table({"term": pa.array([None, *range(100 * i, 100 * i + 99)], pa.int64()), "x": pa.array([j / 4 for j in range(100)]), "name": [f"n{j}" for j in range(100)], "day": pa.array([j * 86_400_000_000 for j in range(100)], pa.timestamp("us"))})
        pq.write_table(t, f"{folder}/f{i:02d}.parquet", row_group_size=50, write_statistics=["term", "x", "name", "day"] if i < n - 1 else ["x"])


def test_footers(spark, tmp_path):
    folder = f"{tmp_path}/t"
    many_files(folder)
    got = footers.footers(spark, folder, files_a_task=3)
    assert got.count() == 20 * 2 * 4 and got.select("path").distinct().rdd.getNumPartitions() >= 1
    stats = {r.column: r for r in footers.column_statistics(got).collect()}
    assert (stats["x"].rows, stats["x"].nulls, stats["x"].least, stats["x"].most) == (2000, 0, 0.0, 24.75)
    assert stats["term"].least is None  # a file doesn't say
    meta = pq.ParquetFile(f"{folder}/f03.parquet").metadata
    one = {(r.row_group, r.column): r for r in got.where(F.col("path") == f"{folder}/f03.parquet").collect()}
    assert len(one) == 8
    for (g, c), r in one.items():
        col = next(meta.row_group(g).column(k) for k in range(4) if meta.row_group(g).column(k).path_in_schema == c)
        assert (r.bytes, r.nulls) == (col.total_compressed_size, col.statistics.null_count)
    assert (one[0, "name"].least_text, one[1, "term"].most, one[1, "day"].most) == ("n0", 398.0, 99 * 86400.0)
    # neighbours are joined: term and x of a row group lie side by side
    both = footers.ranges(got.where(F.col("path") == f"{folder}/f03.parquet"), ["term", "x"]).collect()
    assert len(both) == 2 and sum(r.bytes for r in both) == sum(r.bytes for (_, c), r in one.items() if c in ("term", "x"))
    whole = footers.ranges(got.where(F.col("path") == f"{folder}/f03.parquet"), ["term", "x", "name", "day"]).collect()
    assert len(whole) == 1 and whole[0].bytes == sum(r.bytes for r in one.values())


def test_a_filter_on_paths_and_columns_is_pushed_into_the_plan(spark, tmp_path):
    folder = f"{tmp_path}/t"
    many_files(folder, 4)
    reader = footers.FooterReader({"paths": f'["{folder}"]', "filesatask": 1})
    assert len(reader.partitions()) == 4
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    left = list(reader.pushFilters([In(("path",), (f"{folder}/f01.parquet", f"{folder}/f02.parquet", "none")), EqualTo(("column",), "x"), GreaterThan(("rows",), 1)]))
    assert [type(f).__name__ for f in left] == ["GreaterThan"] and [p.paths for p in reader.partitions()] == [[f"{folder}/f01.parquet"], [f"{folder}/f02.parquet"]]
    assert {r[2] for r in reader.read(reader.partitions()[0])} == {"x"}
    assert footers.footers(spark, folder).where(F.col("column").isin("x", "term") & (F.col("path") == f"{folder}/f01.parquet")).count() == 4


def test_a_pruned_scan_opens_the_files_that_can_hold_a_term(spark, tmp_path):
    folder = f"{tmp_path}/t"
    many_files(folder)
    zone_map = footers.zones(footers.footers(spark, folder), "term")
    wanted = spark.createDataFrame([(205,), (206,), (777,), (99,), (5000,), (None,)], "term long")
    got = footers.pruned_scan(spark, zone_map, wanted, "term", 64.0)
    opened = sorted(os.path.basename(f) for f in got.inputFiles())
    assert opened == ["f02.parquet", "f07.parquet", "f19.parquet"]  # f19 doesn't say what it holds; 99 is in no file
    every = spark.read.parquet(*glob.glob(f"{folder}/*.parquet")).join(wanted, "term", "left_semi")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, every.collect())) and got.count() == 3
    assert footers.pruned_scan(spark, zone_map.where("known"), wanted.where("term = 5000"), "term", 64.0) is None
