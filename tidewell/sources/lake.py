"""Layered lake: date-partitioned batches, bounded scans, listing, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import text as X
from .workspace import exists, setting

PARTITIONS = ("year", "month", "day")
BROKEN = "_broken"


def batch_path(root: str, layer: str, run_ts: dt.datetime, batch: str, style: str = "hive") -> str:
    """Folder of one run's batch of a layer: all its rows share the run's date."""
    last = f"batch={batch}" if style == "hive" else batch
    return f"{root}/{layer}/{X.day_path(run_ts, style)}/{last}"


def write_batch(df: DataFrame, path: str, file_format: str = "parquet") -> str:
    """Write a batch to its own folder. Repeating it replaces only this batch."""
    df.write.mode("overwrite").format(file_format).save(path)
    return path


def write_split(df: DataFrame, path: str, flag: str) -> DataFrame:
    """Write rows into one folder per value of a boolean column and read them back.

    A task keeps a file open per value, so its rows need not be sorted by the flag first.
    """
    spark = df.sparkSession
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "4"):
        df.write.mode("overwrite").partitionBy(flag).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_day_parts(df: DataFrame, event_time: str) -> DataFrame:
    """Zero-padded text partition columns of the event date."""
    return df.withColumns(
        {
            "year": F.date_format(event_time, "yyyy"),
            "month": F.date_format(event_time, "MM"),
            "day": F.date_format(event_time, "dd"),
        }
    )


def write_by_day(df: DataFrame, path: str, event_time: str, file_format: str = "parquet", mode: str = "append") -> str:
    """Write rows into Hive-style day folders of their event time.

    The rebalance hint brings the rows of a day together, so that each task writes few
    folders, and lets adaptive execution cut a day that is too large into several files.
    """
    parts = with_day_parts(df, event_time)
    (
        parts.hint("rebalance", *PARTITIONS)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .format(file_format)
        .save(path)
    )
    return path


def day_of_parts() -> Column:
    return F.make_date(*[F.col(p).cast("int") for p in PARTITIONS])


def within_days(df: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Inclusive date bounds on the partition columns: whole folders are skipped."""
    if first is not None:
        df = df.filter(day_of_parts() >= F.lit(first))
    if last is not None:
        df = df.filter(day_of_parts() <= F.lit(last))
    return df


def read_by_day(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    file_format: str = "parquet",
) -> DataFrame:
    """Day folders between two dates. ``schema`` covers the data columns."""
    base = _ddl(spark, schema)
    parts = "".join(f", {p} string" for p in PARTITIONS)
    whole = spark.read.schema(f"{base}{parts}").format(file_format).load(path)
    return within_days(whole, first, last)


def _ddl(spark: SparkSession, schema: T.StructType | str) -> str:
    if isinstance(schema, str):
        return schema
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def read_json(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, multi_line: bool = True
) -> DataFrame:
    """JSON batches, an object or an array per file; missing and broken files are skipped.

    ``multi_line`` is needed for pretty-printed files, which cannot be split; files with
    one object per line are read in parallel without it, and only broken lines are skipped.
    """
    ddl = _ddl(spark, schema)
    whole = _parsed_json(spark, paths, ddl, multi_line)
    if whole is None:
        return spark.createDataFrame([], T.StructType.fromDDL(ddl))
    return whole.filter(F.col(BROKEN).isNull()).drop(BROKEN)


def broken_json(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, multi_line: bool = True
) -> DataFrame:
    """(path, text) of the files, or lines, that ``read_json`` skips because they do not parse."""
    found = [p for p in ([paths] if isinstance(paths, str) else paths) if exists(spark, p)]
    if not found:
        return spark.createDataFrame([], "path string, text string")
    texts = spark.read.text(found, wholetext=multi_line).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    # an object counts as an array of one; what is neither gives NULL
    parsed = F.from_json("text", T.ArrayType(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema))
    return texts.filter((F.trim("text") != "") & parsed.isNull())


def _parsed_json(spark: SparkSession, paths: str | Sequence[str], ddl: str, multi_line: bool) -> DataFrame | None:
    """All rows of the files that exist, with the broken text beside; None if there is no file.

    A path that is absent, or vanishes before it is read, is no error. All paths are listed by one scan.
    """
    found = [p for p in ([paths] if isinstance(paths, str) else paths) if exists(spark, p)]
    if not found:
        return None
    return (
        spark.read.schema(f"{ddl}, {BROKEN} string")
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", BROKEN)
        .option("mode", "PERMISSIVE")
        .option("ignoreMissingFiles", True)
        .option("ignoreCorruptFiles", True)
        .json(found)
    )


def list_files(
    spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Files below a path with the date of their folder, from the listing alone.

    A file whose path holds no date is kept whatever the bounds.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("length").alias("bytes"))
        .withColumn("day", X.day_of_path(F.col("path")))
    )
    keep = F.lit(True)
    if first is not None:
        keep = keep & (F.col("day") >= F.lit(first))
    if last is not None:
        keep = keep & (F.col("day") <= F.lit(last))
    return found.filter(F.col("day").isNull() | keep)


def latest_batch(df: DataFrame, batch: str = "batch") -> DataFrame:
    """Rows of the newest batch of a table partitioned by its stamp. The stamps come from the
    names of the files, so no file is opened to find the newest."""
    named = [X.partition_value(path, batch) for path in df.inputFiles()]
    held = [value for value in named if value is not None]
    newest = F.lit(max(held)) if held else df.agg(F.max(batch).alias("b")).scalar()
    return df.filter(F.col(batch) == newest)


def export_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def remove_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Remove folders with what they hold; one that is gone already is no error."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder in folders:
        path = hadoop.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def expire_days(spark: SparkSession, path: str, today: dt.date, keep_days: int) -> list[dt.date]:
    """Remove the day folders older than ``keep_days`` and return their dates.

    Whole folders go; nothing that stays is read or rewritten. The listing has one entry
    per day of the layer.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path("/".join([path, *[f"{p}=*" for p in PARTITIONS]]))
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = []
    for status in files.globStatus(pattern) or []:
        folder = status.getPath()
        try:
            day = dt.date(*[int(part.split("=")[1]) for part in folder.toString().split("/")[-3:]])
        except ValueError:
            continue
        if day < today - dt.timedelta(days=keep_days):
            files.delete(folder, True)
            removed.append(day)
    return sorted(removed)
