"""Parquet footers as a table: what every column of every row group holds, without reading a data page.

A Spark data source plans groups of files as partitions; a task opens a file's last bytes only.  Filters on path and column are pushed into
the plan: files that no filter admits aren't planned, columns that none admits aren't returned.  Paths go through pyarrow's
file systems (local, S3, GCS, HDFS by their schemes).

On top of it: the byte ranges that a projection has to read, and zone maps, which tell a reader the files that can hold a wanted value.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

FOOTERS = "path string, row_group int, column string, kind string, rows long, nulls long, least double, most double, least_text string, most_text string, offset long, bytes long"
#: Files whose footers a task reads.
FILES_A_TASK = 64


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _number(value) -> float | None:
    """A bound as a number: of dates and times, seconds since 1970 in UTC."""
    import datetime as dt

    if isinstance(value, dt.datetime):
        return (value if value.tzinfo else value.replace(tzinfo=dt.UTC)).timestamp()
    if isinstance(value, dt.date):
        return float((value - dt.date(1970, 1, 1)).days * 86400)
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None


class FooterReader(DataSourceReader):
    def __init__(self, options: dict):
        self.given, self.files_a_task = json.loads(options["paths"]), int(options.get("filesatask", FILES_A_TASK))
        self.admitted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if name not in ("path", "column"):
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.admitted[name] = self.admitted.get(name, values) & values

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        paths = []
        for given in self.given:
            store, inner = fs.FileSystem.from_uri(given)
            scheme = given[: len(given) - len(inner)] if given.endswith(inner) else ""
            info = store.get_file_info(inner)
            if info.type == fs.FileType.Directory:
                paths += [scheme + x.path for x in store.get_file_info(fs.FileSelector(inner, recursive=True)) if x.is_file and x.path.endswith(".parquet")]
            else:
                paths.append(given)
        paths = sorted(p for p in set(paths) if "path" not in self.admitted or p in self.admitted["path"])
        return [Files(paths[i : i + self.files_a_task]) for i in range(0, len(paths), self.files_a_task)]

    def read(self, partition: Files) -> Iterator[tuple]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for path in partition.paths if partition else []:
            store, inner = fs.FileSystem.from_uri(path)
            with store.open_input_file(inner) as f:
                meta = pq.ParquetFile(f).metadata
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        col = group.column(c)
                        name = col.path_in_schema
                        if "column" in self.admitted and name not in self.admitted["column"]:
                            continue
                        s = col.statistics
                        low, high = (s.min, s.max) if s is not None and s.has_min_max else (None, None)
                        text = [v if isinstance(v, str) else None for v in (low, high)]
                        at = col.dictionary_page_offset if col.has_dictionary_page else col.data_page_offset
                        yield (path, g, name, col.physical_type, group.num_rows, s.null_count if s is not None and s.has_null_count else None, _number(low), _number(high), *text, at, col.total_compressed_size)


class FooterSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "parquet_footers"

    def schema(self) -> str:
        return FOOTERS

    def reader(self, schema) -> FooterReader:
        return FooterReader(self.options)


def footers(spark: SparkSession, *paths: str, files_a_task: int = FILES_A_TASK) -> DataFrame:
    """FOOTERS of the files (or of all Parquet files in folders)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FooterSource)
    return spark.read.format("parquet_footers").option("paths", json.dumps(list(paths))).option("filesatask", files_a_task).load()


def column_statistics(found: DataFrame) -> DataFrame:
    """(column, rows, nulls, least, most) over all row groups; bounds are null if a group that has values lacks them."""
    bounded = F.coalesce(F.col("least").isNotNull() | (F.col("nulls") == F.col("rows")), F.lit(False))
    whole = F.every(bounded)
    return found.groupBy("column").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.when(whole, F.min("least")).alias("least"), F.when(whole, F.max("most")).alias("most"))


def ranges(found: DataFrame, columns: list[str]) -> DataFrame:
    """(path, offset, bytes): the stretches of a file that a projection reads, neighbours joined."""
    own = found.where(F.col("column").isin(*columns) | F.split_part("column", F.lit("."), F.lit(1)).isin(*columns))
    chunks = own.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("offset", "bytes"))).alias("c"))  # a file's column chunks

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["offset"].alias("offset"), (last["bytes"] + x["bytes"]).alias("bytes"))))
        return F.when((F.size(done) > 0) & (last["offset"] + last["bytes"] == x["offset"]), joined).otherwise(F.concat(done, F.array(x)))

    none = F.array().cast("array<struct<offset:bigint,bytes:bigint>>")
    return chunks.select("path", F.explode(F.reduce("c", none, lambda done, x: F.when(F.size(done) == 0, F.array(x)).otherwise(step(done, x)))).alias("r")).select("path", "r.offset", "r.bytes")


def zones(found: DataFrame, column: str) -> DataFrame:
    """(path, least, most) of a column; a file with a row group of unknown bounds has null ones, which hold anything."""
    own = found.where(F.col("column") == column)
    known = F.every(F.coalesce(F.col("least").isNotNull() | (F.col("nulls") == F.col("rows")), F.lit(False)))
    return own.groupBy("path").agg(F.when(known, F.min("least")).alias("least"), F.when(known, F.max("most")).alias("most"), known.alias("known"))


def wanted_files(zone_map: DataFrame, wanted: DataFrame, column: str, width: float) -> DataFrame:
    """(path) of files whose range holds a wanted value.

    An interval join over cells of a width: a range is in every cell that it touches, a value in one, equal cells meet and the range decides.
    Ranges should span few cells; files of unknown bounds are wanted in any case.
    """
    cell = lambda c: F.floor(c / width).cast("long")
    spread = zone_map.where("known and least is not null").select("path", "least", "most", F.explode(F.sequence(cell(F.col("least")), cell(F.col("most")))).alias("cell"))
    values = wanted.select(F.col(column).cast("double").alias("value")).where("value is not null").distinct().withColumn("cell", cell(F.col("value")))
    hit = spread.join(values, "cell").where("value between least and most").select("path")
    return hit.unionByName(zone_map.where("not known").select("path")).distinct()


def pruned_scan(spark: SparkSession, zone_map: DataFrame, wanted: DataFrame, column: str, width: float) -> DataFrame | None:
    """Rows whose column has a wanted value, read from the files that can hold one; None where no file can.

    The driver sees the paths of those files, as any reader must be told them.
    """
    paths = [r.path for r in wanted_files(zone_map, wanted, column, width).collect()]
    if not paths:
        return None
    return spark.read.parquet(*paths).join(wanted.select(column).distinct(), column, "left_semi")
