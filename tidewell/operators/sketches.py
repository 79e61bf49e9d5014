"""Distinct counts that add up: one sketch per group and day, merged over any range of days.

An exact distinct count of a range has to group all values of the range again, because distinct counts of
days do not add up. A HyperLogLog sketch of a day has a fixed size whatever it has seen, and the union of
sketches is the sketch of the union: a range of days costs one small row per group and day. A value that
arrives twice, in one load or in two, changes nothing, so loads may overlap or be repeated.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..sources.workspace import read_or_empty, scratch

#: Binary logarithm of the number of buckets of a sketch, and the day column of a sketch table.
LG_BUCKETS, DAY = 12, "date"
_SKETCHED = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def relative_error(lg_buckets: int = LG_BUCKETS) -> float:
    """Standard error of an estimate as a share of the true count."""
    return 1.04 / math.sqrt(1 << lg_buckets)


def _value(df: DataFrame, columns: Sequence[str]) -> Column:
    """What is counted: one column, or a combination of several, which goes by a 64-bit hash. A
    combination with an absent part is not counted, as an absent value is not."""
    if len(columns) > 1:
        whole = F.lit(True)
        for c in columns:
            whole = whole & F.col(c).isNotNull()
        return F.when(whole, F.xxhash64(*columns))
    kind = df.schema[columns[0]].dataType
    return F.col(columns[0]) if isinstance(kind, _SKETCHED) else F.col(columns[0]).cast("string")


def daily_sketches(
    df: DataFrame, columns: Sequence[str], event_time: str, by: Sequence[str] = (), lg_buckets: int = LG_BUCKETS
) -> DataFrame:
    """([by], date, sketch): the values of each group and UTC day. Rows without a moment or group belong to none.

    Sketches combine before the shuffle, so a hot group leaves each task as one row of a few kilobytes.
    """
    present = df.dropna(subset=[event_time, *by]).withColumn(DAY, F.to_date(event_time)).withColumn("_value", _value(df, columns))
    return present.groupBy(*by, DAY).agg(F.hll_sketch_agg("_value", F.lit(lg_buckets)).alias("sketch"))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One sketch per group of rows that hold sketches."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch", F.lit(True)).alias("sketch"))


def estimated(sketches: DataFrame, name: str = "distinct") -> DataFrame:
    """The estimates in place of the sketches."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def sketch_ddl(by: str) -> str:
    """Schema of a sketch table; ``by`` names and types its groups, or is empty."""
    return ", ".join(x for x in (by, "sketch binary", f"{DAY} date") if x)


def read_sketches(
    spark: SparkSession, path: str, by: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """The sketches of the days between two dates; only their folders are opened."""
    rows = read_or_empty(spark, path, sketch_ddl(by))
    if first is not None:
        rows = rows.filter(F.col(DAY) >= F.lit(first))
    if last is not None:
        rows = rows.filter(F.col(DAY) <= F.lit(last))
    return rows


def load_sketches(
    df: DataFrame, path: str, columns: Sequence[str], event_time: str, by: str = "", lg_buckets: int = LG_BUCKETS
) -> None:
    """Merge a batch into a sketch table. Only the days of the batch are read and rewritten; repeating
    the batch, or another that overlaps it, leaves the table as it is."""
    spark = df.sparkSession
    groups = [part.split()[0].strip("`") for part in by.split(", ") if part]
    staged = scratch(spark, "sketches")
    daily_sketches(df, columns, event_time, groups, lg_buckets).write.parquet(staged)
    delta = spark.read.schema(sketch_ddl(by)).parquet(staged)
    days = [r[DAY] for r in delta.select(DAY).distinct().collect()]  # a date per day of the batch
    if not days:
        return
    held = read_or_empty(spark, path, sketch_ddl(by)).filter(F.col(DAY).isin(days))
    both = merged(held.unionByName(delta), [*groups, DAY])
    # written aside first: a job that fails leaves the days as they were
    whole = scratch(spark, "sketches")
    both.write.parquet(whole)
    rows = spark.read.schema(sketch_ddl(by)).parquet(whole)
    rows.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def distinct_between(
    spark: SparkSession, path: str, by: str = "", first: dt.date | None = None, last: dt.date | None = None, name: str = "distinct"
) -> DataFrame:
    """([by], estimate) over the days between two dates, from the table alone."""
    groups = [part.split()[0].strip("`") for part in by.split(", ") if part]
    return estimated(merged(read_sketches(spark, path, by, first, last), groups), name)
