"""Keyed tables that no date divides: rows in buckets by a hash of their key, and upserts that touch few files.

A row lies in the folder of its bucket. Within a bucket files are ranges of the key, and an index notes the first and
last key and the number of rows of each. An upsert finds the buckets of its batch, and in them the files whose
range holds one of its keys; it reads these only, writes new files for them, and leaves all others as they are.
Which files make up the table is stated by a manifest that is written last: readers see all of an upsert
or nothing of it, and what an interrupted one wrote is never read.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..operators.merge import require_unique, upsert
from . import lake
from .workspace import checkpointed, read_or_empty, scratch

BUCKET, VERSION = "bucket", "version"
#: Rows of a file: a bucket that grows is cut into more files, by ranges of the key.
FILE_ROWS = 1_000_000
#: Files that an upsert lists by name at most in one scan.
MOST_FILES = 100_000


@dataclass(frozen=True)
class Upserted:
    """What an upsert did: rows of its batch, files of the table before, files read and written."""

    rows: int
    files: int
    read: int
    written: int


@dataclass(frozen=True)
class BucketedTable:
    """A table below ``path`` with one row per ``key``; ``ddl`` names and types its columns.

    ``buckets`` is fixed for the life of a table. Rows whose key is absent in part are one key like others.
    """

    path: str
    ddl: str
    key: tuple[str, ...]
    buckets: int
    file_rows: int = FILE_ROWS

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def _index_ddl(self) -> str:
        kinds = {f.name: f.dataType.simpleString() for f in self.schema}
        ends = ", ".join(f"`{k}`: {kinds[k]}" for k in self.key)
        return f"file string, {BUCKET} int, first struct<{ends}>, last struct<{ends}>, rows bigint"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    # --- reading ----------------------------------------------------------------

    def manifest(self, spark: SparkSession) -> DataFrame:
        """The files of the newest version: path below the table, bucket, first and last key, rows."""
        versions = read_or_empty(spark, f"{self.path}/manifests", f"{self._index_ddl}, {VERSION} string")
        names = [p.split(f"/{VERSION}=")[1].split("/")[0] for p in versions.inputFiles()]  # from names, nothing is opened
        return versions.filter(F.col(VERSION) == (max(names) if names else "")).drop(VERSION)

    def _files(self, spark: SparkSession, listed: Sequence[str]) -> DataFrame:
        if not listed:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.path}/{name}" for name in listed])

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows. The driver holds a name per file."""
        return self._files(spark, sorted(r["file"] for r in self.manifest(spark).select("file").collect()))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys; only files whose range holds one of them are opened."""
        spark, wanted = keys.sparkSession, keys.select(*self.key).distinct()
        placed = self._placed(wanted, self.manifest(spark)).filter(F.struct(*self.key) <= F.col("_last"))
        rows = self._files(spark, sorted(r["_file"] for r in placed.select("_file").distinct().collect()))
        near = wanted.select(*[F.col(k).alias(f"_{k}") for k in self.key])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.key])
        return rows.join(near, same, "left_semi")

    def _placed(self, rows: DataFrame, manifest: DataFrame) -> DataFrame:
        """Rows with the file they belong to (``_file``, its ``_last`` key): of their bucket the last that begins at or before
        their key, or else the first; none in a bucket without files.

        Rows and files are sorted together by bucket and key, so each row looks back to the nearest file; pairs are
        never formed, and as keys are unique, buckets are even.
        """
        names = rows.columns
        files = manifest.select(BUCKET, F.col("first").alias("_at"), F.struct("file", "last").alias("_begun"))
        marked = rows.select(self._bucket().alias(BUCKET), F.struct(*self.key).alias("_at"), F.struct(*names).alias("_row"))
        order = Window.partitionBy(BUCKET).orderBy("_at", F.col("_begun").isNull())
        both = files.unionByName(marked, allowMissingColumns=True).withColumn("_begun", F.last("_begun", ignorenulls=True).over(order))
        opening = manifest.groupBy(BUCKET).agg(F.min_by(F.struct("file", "last"), "first").alias("_opening"))
        found = both.filter("_row is not null").join(F.broadcast(opening), BUCKET, "left")  # a row per bucket
        begun = F.coalesce("_begun", "_opening")
        return found.select("_row.*", begun["file"].alias("_file"), begun["last"].alias("_last"))

    # --- writing ----------------------------------------------------------------

    def upsert(self, delta: DataFrame, updates: Sequence[str] | None = None) -> Upserted:
        """Insert or update a batch that holds each key once; known keys change in ``updates`` (default: all but the key)."""
        spark = delta.sparkSession
        names = [f.name for f in self.schema]
        manifest = checkpointed(self.manifest(spark))
        staged = scratch(spark, "keyed-batch")
        self._placed(delta.select(*names), manifest).drop("_last").write.parquet(staged)
        batch = spark.read.schema(T.StructType([*self.schema, T.StructField("_file", T.StringType())])).parquet(staged)
        require_unique(batch, self.key)
        listed = sorted(r["_file"] for r in batch.select("_file").distinct().collect() if r["_file"] is not None)
        if len(listed) > MOST_FILES:
            raise ValueError(f"The batch touches {len(listed)} files; upsert it in parts")
        changed = [n for n in names if n not in self.key] if updates is None else list(updates)
        held = self._files(spark, listed)
        held = held.select(*names, self._name(F.col("_metadata.file_path")).alias("_file")) if listed else held.withColumn("_file", F.lit(None).cast("string"))
        merged = upsert(held, batch, self.key, changed)
        version = _new_version()
        written = self._write(merged.withColumn(BUCKET, self._bucket()).withColumn("span", F.coalesce("_file", F.lit("new"))).drop("_file"), version)
        kept = manifest.filter(~F.col("file").isin(listed)) if listed else manifest
        self._state(kept.unionByName(written), version)
        return Upserted(batch.count(), manifest.count(), len(listed), written.count())

    def compact(self, spark: SparkSession) -> int:
        """Write all rows again in files of full size; returns their number."""
        version = _new_version()
        written = self._write(self.read(spark).withColumn(BUCKET, self._bucket()).withColumn("span", F.lit("new")), version)
        self._state(written, version)
        return written.count()

    def _name(self, path: Column) -> Column:
        """A file's name below the table."""
        return F.regexp_extract(path, r"(files/[^/]+/bucket=\d+/[^/]+/[^/]+)$", 1)

    def _write(self, rows: DataFrame, version: str) -> DataFrame:
        """Write rows (with their bucket, and the ``span`` of keys they lie in) as files that are ranges of the key; their index.

        Rows of different spans never share a file: between two files that are written again may lie one that is not.
        """
        tasks = min(self.buckets, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        folder = F.substring(F.sha2("span", 256), 1, 32)
        target = f"{self.path}/files/{version}"
        (
            rows.withColumn("span", folder).repartition(tasks, BUCKET).sortWithinPartitions(BUCKET, "span", *self.key)
            .write.option("maxRecordsPerFile", self.file_rows).partitionBy(BUCKET, "span").parquet(target)
        )
        spark = rows.sparkSession
        held = spark.read.schema(T.StructType([*self.schema, T.StructField(BUCKET, T.IntegerType()), T.StructField("span", T.StringType())])).parquet(target)
        place = F.struct(*self.key)
        index = held.select(self._name(F.col("_metadata.file_path")).alias("file"), BUCKET, place.alias("place")).groupBy("file", BUCKET).agg(
            F.min("place").alias("first"), F.max("place").alias("last"), F.count(F.lit(1)).alias("rows"))
        return checkpointed(index)

    def _state(self, index: DataFrame, version: str) -> None:
        """The manifest of a version: it counts from here on."""
        index.select("file", BUCKET, "first", "last", "rows").coalesce(1).write.parquet(f"{self.path}/manifests/{VERSION}={version}")

    def vacuum(self, spark: SparkSession, keep: int = 1) -> int:
        """Remove versions before the newest ``keep`` and the folders of files that no kept version names."""
        if keep < 1:
            raise ValueError("the newest version stays")
        manifests = read_or_empty(spark, f"{self.path}/manifests", f"{self._index_ddl}, {VERSION} string")
        versions = sorted({p.split(f"/{VERSION}=")[1].split("/")[0] for p in manifests.inputFiles()})
        folder = F.regexp_extract("file", r"^(files/[^/]+)/", 1)
        named = manifests.select(VERSION, folder.alias("folder")).distinct().collect()  # folders, not files
        kept = set(versions[-keep:])
        used = {r["folder"] for r in named if r[VERSION] in kept}
        gone = sorted({r["folder"] for r in named} - used)
        lake.remove_folders(spark, [f"{self.path}/manifests/{VERSION}={v}" for v in versions if v not in kept])
        lake.remove_folders(spark, [f"{self.path}/{g}" for g in gone])
        return len(gone)


def _new_version() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex}"
