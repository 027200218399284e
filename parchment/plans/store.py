"""A snapshot store over plain Parquet: content-defined files, a table of files and a manifest for each version.

Readers see a version's files or the next version's, never a mixture: a commit writes the files that no version has yet (see
parchment.plans.files), then the version's table of files, then its manifest under a number that another writer can't have taken.  Data moves
through Spark and every path through Hadoop's file system, so any store that Spark reaches will do.

Writers are fenced: acquire() takes a lease with a token, one above all tokens before, renew() keeps it, and a commit whose token isn't the
latest fails, however long its writer was asleep.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parchment.operators.grouping import line_digest
from parchment.plans.files import FILE_BYTES, FILES, file_changes, file_digests, placed_in_files, row_digest, row_weight
from parchment.schema import DOCUMENTS, conform

ROW_GROUP_BYTES = 64 << 20


class Superseded(RuntimeError):
    """Another writer committed since this one last read."""


class Fenced(Superseded):
    """A later writer has taken the lease."""


class SnapshotStore:
    """partition gives a row's partition: a column of the schema, or an expression over its columns."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = DOCUMENTS, key: str = "id", partition: Column | str = "partition", file_bytes: int = FILE_BYTES):
        self.spark, self.root, self.schema, self.key, self.file_bytes = spark, root.rstrip("/"), schema, key, file_bytes
        self.partition = F.col(partition) if isinstance(partition, str) else partition
        self._listed: dict[str | None, list[tuple[str, str]]] = {}
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ---- small files

    def _exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.root}/{name}"))

    def _read(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> None:
        """Write a file that must not exist yet; creation without overwrite is what decides between two writers."""
        try:
            stream = self._fs.create(self._path(f"{self.root}/{name}"), False)
        except Exception as e:
            raise Superseded(name) from e
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def free_bytes(self) -> int:
        """What the file system says is left."""
        return self._fs.getStatus(self._path(self.root)).getRemaining()

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/_manifests")
        return sorted(int(s.getPath().getName().split(".")[0]) for s in self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def manifest(self, version: int | None = None) -> dict:
        """The latest manifest, or an empty one."""
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "partitions": {}, "failures": {}, "listing": None, "runs": []}
        return json.loads(self._read(f"_manifests/{version if version is not None else known[-1]:09d}.json"))

    # ---- leases

    def leases(self) -> list[dict]:
        """Every lease taken, in order of its token, with its last renewal."""
        folder = self._path(f"{self.root}/_leases")
        names = sorted((x.getPath().getName() for x in self._fs.listStatus(folder)), key=lambda n: n.split(".")[0]) if self._fs.exists(folder) else []
        out: dict[int, dict] = {}
        for n in names:  # TOKEN.json, then TOKEN-BEAT.json
            token = int(n.split(".")[0].split("-")[0])
            out[token] = json.loads(self._read(f"_leases/{n}")) | {"token": token}
        return [out[t] for t in sorted(out)]

    def acquire(self, writer: str, at: str) -> int:
        """Take the lease; returns its token.  Of two writers that try for one token, the file system lets one have it."""
        token = max((x["token"] for x in self.leases()), default=0) + 1
        self._create(f"_leases/{token:09d}.json", json.dumps({"by": writer, "at": at, "ended": False}))
        return token

    def renew(self, token: int, writer: str, at: str, ended: bool = False) -> None:
        """Say that the writer is alive (or done); fails if a later token was taken."""
        self.guard(token)
        self._create(f"_leases/{token:09d}-{uuid.uuid1().time:020d}.json", json.dumps({"by": writer, "at": at, "ended": ended}))

    def guard(self, token: int | None) -> None:
        latest = max((x["token"] for x in self.leases()), default=0)
        if token is not None and token != latest:
            raise Fenced(f"token {token} was followed by {latest}")

    def _expect(self, base: dict, token: int | None) -> None:
        """Whether base is still the latest version, and token the latest lease."""
        self.guard(token)
        if self.versions()[-1:] not in ([], [base["version"]]):
            raise Superseded(f"version {base['version'] + 1} exists")

    # ---- data

    def files(self, manifest: dict | None = None) -> DataFrame:
        """(partition, start, rows, bytes, digest, path) of a version's data files; their contents aren't opened."""
        table = (manifest or self.manifest()).get("files")
        return self.spark.read.schema(FILES).parquet(f"{self.root}/{table}") if table else self.spark.createDataFrame([], FILES)

    def paths(self, partitions: list[str] | None = None, manifest: dict | None = None) -> list[str]:
        """Where a version's files are: what a reader must be told.  A table of files never changes, so it is asked once."""
        table = (manifest or self.manifest()).get("files")
        if table not in self._listed:
            self._listed = {table: [(r.partition, f"{self.root}/{r.path}") for r in self.files({"files": table}).select("partition", "path").collect()]}
        wanted = None if partitions is None else set(partitions)
        return [path for home, path in self._listed[table] if wanted is None or home in wanted]

    def read(self, partitions: list[str] | None = None, manifest: dict | None = None) -> DataFrame:
        """Rows of the named partitions (or all); only their files are opened, and only the columns that are used."""
        paths = self.paths(partitions, manifest)
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read_placed(self, manifest: dict | None = None) -> DataFrame:
        """All rows with _stored_in, the partition whose file they lie in: one scan, and the file table by the file's folder."""
        paths = self.paths(None, manifest)
        if not paths:
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("_stored_in", T.StringType())]))
        folder = F.regexp_extract("_metadata.file_path", r"_digest=([0-9a-f]+)/[^/]+\z", 1)
        rows = self.spark.read.schema(self.schema).parquet(*paths).select("*", folder.alias("_digest"))
        homes = self.files(manifest).select(F.col("digest").alias("_digest"), F.col("partition").alias("_stored_in"))
        return rows.join(homes, "_digest", "left").drop("_digest")

    def commit(self, changed: DataFrame, base: dict, stamps: dict[str, dict] | None = None, token: int | None = None, **record) -> dict:
        """Replace the partitions that occur in changed; base is the manifest the change was planned on; stamps go to the
        entries of partitions that are known; token is the writer's lease.

        Files are planned over ids, weights and digests of rows.  Only files whose rows no file of base has are written, each by one
        task, from the rows that are theirs; the others are named again.
        """
        self._expect(base, token)
        run, number = uuid.uuid4().hex, base["version"] + 1
        out, planned = f"{self.root}/_staging/{run}", f"{self.root}/_staging/plan-{run}"
        rows = conform(changed, self.schema).withColumn("_home", F.coalesce(self.partition, F.lit("")))
        keys = rows.select(F.col("_home").alias("partition"), F.col(self.key).cast("string").alias("key"), row_digest(self.schema).alias("line"), row_weight(self.schema).alias("weight"), *[c for c in ("listed", "file_size", "term") if c in rows.columns])
        placed_in_files(keys, self.file_bytes).write.parquet(f"{planned}/keys")  # two passes read it
        keys = self.spark.read.parquet(f"{planned}/keys")
        had = self.files(base)
        plan = file_changes(file_digests(keys), had).withColumn("_new", F.col("path").isNull()).withColumn("path", F.coalesce("path", F.concat(F.lit(f"_staging/{run}/_digest="), "digest")))
        plan.write.parquet(f"{planned}/files")
        plan = self.spark.read.parquet(f"{planned}/files")
        fresh = keys.join(plan.where("_new").select("partition", "start", F.col("digest").alias("_digest")), ["partition", "start"]).select(F.col("partition").alias("_home"), F.col("key").alias("_key"), "_digest").distinct()
        rows = rows.withColumn("_own", F.col(self.key).cast("string"))
        theirs = rows.join(fresh.withColumnRenamed("_home", "_in"), (F.col("_home") == F.col("_in")) & F.col("_own").eqNullSafe(F.col("_key"))).select(*self.schema.fieldNames(), "_digest")
        theirs.repartition("_digest").sortWithinPartitions("_digest", self.key).write.partitionBy("_digest").option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(out)
        counts = [F.count("*").alias("rows"), line_digest(F.col("key")).alias("ids_sha256")]
        if "listed" in keys.columns:
            counts += [F.count_if("listed").alias("listed"), F.coalesce(F.sum("file_size"), F.lit(0)).alias("file_bytes")]
        if "term" in keys.columns:
            counts += [F.count_if(F.col("term").isNull()).alias("undated"), F.max("term").alias("last_term")]
        manifest = json.loads(json.dumps(base)) | record
        for r in keys.groupBy("partition").agg(*counts).collect():  # one row a partition
            d = r.asDict()
            name = d.pop("partition")
            manifest["partitions"][name] = manifest["partitions"].get(name, {}) | d
        for name, stamp in (stamps or {}).items():
            if name in manifest["partitions"]:
                manifest["partitions"][name] |= stamp
        table = f"_files/{number:09d}-{run}"
        kept = had.join(plan.select("partition").distinct(), "partition", "left_anti")
        kept.unionByName(plan.select(*FILES.fieldNames())).coalesce(8).write.parquet(f"{self.root}/{table}")
        manifest |= {"version": number, "files": table}
        self._fs.delete(self._path(planned), True)
        self._expect(base, token)  # the number decides between writers that both get this far
        self._create(f"_manifests/{number:09d}.json", json.dumps(manifest, indent=1, sort_keys=True))
        return manifest

    def hashes(self) -> DataFrame:
        """(path, sha256) of every data file, hashed where it is read."""
        paths = self.paths()
        reader = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        return reader.load(paths).select("path", F.sha2("content", 256).alias("sha256")) if paths else self.spark.createDataFrame([], "path string, sha256 string")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete staged folders that no file of the last versions lies in; returns them.

        What a run on the latest version has fetched stays, and while a writer holds the lease nothing goes.
        """
        if self.leases() and not self.leases()[-1]["ended"]:
            return []
        last = [self.manifest(v) for v in self.versions()[-keep:]]
        used = {r.f for m in last for r in self.files(m).select(F.split_part("path", F.lit("/"), F.lit(2)).alias("f")).distinct().collect()}
        current = f"-of-{last[-1]['version'] if last else 0:09d}"
        gone = []
        for folder, known in (("_staging", lambda n: n in used or n.endswith(current)), ("_files", lambda n: any(m.get("files") == f"_files/{n}" for m in last))):
            path = self._path(f"{self.root}/{folder}")
            names = [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []
            for name in (n for n in names if not known(n)):
                self._fs.delete(self._path(f"{self.root}/{folder}/{name}"), True)
                gone.append(name)
        return gone
