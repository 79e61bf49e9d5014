"""Shared scratch space: checkpoints and trial tables.

A cluster names a folder every node can reach in ``spark.checkpoint.dir``. Only on a local master,
where neither that setting nor a checkpoint directory exists (tests), a local folder is used;
it is removed when the process ends.
"""

from __future__ import annotations

import atexit
import json
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def shared_root(spark: SparkSession) -> str:
    """Folder for intermediate data that all executors see."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all nodes can reach")
    local = tempfile.mkdtemp(prefix="tidewell-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch(spark: SparkSession, name: str) -> str:
    """A new path of its own under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame written to reliable storage, with its lineage cut."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a file that a pattern matches, is there: one question to the file system, nothing is listed or
    read, and nothing fails."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if any(sign in path for sign in "*?[{"):
        return bool(files.globStatus(place))
    return files.exists(place)


def read_or_empty(spark: SparkSession, path: str, schema: str | T.StructType, **options: object) -> DataFrame:
    """A parquet table, empty while nothing has been written."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not exists(spark, path):
        return spark.createDataFrame([], fields)
    try:  # it may vanish in between
        return spark.read.schema(fields).options(**options).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], fields)


def literal_rows(spark: SparkSession, rows: Sequence[dict], ddl: str) -> DataFrame:
    """A few receipt rows as a one-partition frame that needs no Python worker."""
    schema = T.ArrayType(T.StructType.fromDDL(ddl))
    text = json.dumps(list(rows), default=lambda moment: moment.isoformat())
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), schema)))


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the duration of one write."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
