"""Mark and sweep: folders of the lake that no reader can reach any more, and the lineage rows of expired ones.

Marked are the attempts that the lineage names, less those superseded by a newer attempt at their run and layer
and those older than their layer is kept. All other attempt folders are swept: vetoed and failed attempts
too, which never had a lineage row. A folder with a file younger than the grace period is left alone, as its run may
still be under way.

Whatever is interrupted, readers find what the lineage names: rows go before folders, and rows of superseded
attempts before expired ones, lest an older attempt become the newest. What an interrupted sweep leaves is found
by the next.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as fixed
from ..sources import lake
from ..sources.workspace import checkpointed
from . import receipts as P
from .medallion import Tables

#: A folder of one attempt, from its layer on.
_ATTEMPT = r"([^/]+/year=\d+/month=\d+/day=\d+/batch=[^/]+/attempt=[^/]+)"
#: Layers whose folders no lineage names; they expire by day.
UNNAMED = ("quarantine", "failed_payloads")


@dataclass(frozen=True)
class Swept:
    """What a sweep removed: receipts of the lineage, and attempt folders."""

    superseded_rows: int
    expired_rows: int
    folders: tuple[str, ...]


def attempt_of(path: Column) -> Column:
    """The attempt folder that a path lies in, without the root; empty if it lies in none."""
    return F.regexp_extract(path, _ATTEMPT, 1)


def marked(rows: DataFrame, today: dt.date, keep_days: dict[str, int]) -> DataFrame:
    """Lineage rows with their ``fate``: kept, superseded, or expired. Layers that ``keep_days`` does not name never expire."""
    current = P.current_artifacts(rows.drop("fate")).select("run_id", "layer", F.col("attempt").alias("_newest"))
    limit = F.lit(None).cast("date")
    for layer, days in keep_days.items():
        limit = F.when(F.col("layer") == layer, F.lit(today - dt.timedelta(days=days))).otherwise(limit)
    old = F.col("attempt") != F.col("_newest")
    fate = F.when(old, "superseded").when(F.col("day") < limit, "expired").otherwise("kept")
    return rows.join(current, ["run_id", "layer"]).withColumn("fate", fate).drop("_newest")


def unreachable(spark: SparkSession, tables: Tables, kept: DataFrame, before: dt.datetime) -> DataFrame:
    """(folder) of the attempts in the lake that no kept lineage row names and whose files are all older than a moment.

    The listing has a row per file; it is grouped and joined by Spark, and only folder names leave it.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(tables.root)
        .select(attempt_of(F.col("path")).alias("folder"), "modificationTime")
        .filter((F.col("folder") != "") & ~F.substring_index("folder", "/", 1).isin(*UNNAMED))
    )
    held = files.groupBy("folder").agg(F.max("modificationTime").alias("newest"))
    named = kept.select(attempt_of(F.concat("key", F.lit("/"))).alias("folder")).distinct()
    return held.join(named, "folder", "left_anti").filter(F.col("newest") < F.lit(before)).select("folder")


def sweep(
    spark: SparkSession, tables: Tables, now: dt.datetime, keep_days: dict[str, int] | None = None,
    grace: dt.timedelta = dt.timedelta(days=1), quarantine_days: int = fixed.QUARANTINE_DAYS,
) -> Swept:
    """Remove what readers cannot reach and what is older than its layer is kept (``keep_days``, by layer).

    ``now`` is the moment from which ages are measured; files younger than ``grace`` before the real time are left.
    """
    gone = {fate: _drop_rows(spark, tables, fate, now.date(), keep_days or {}) for fate in ("superseded", "expired")}
    kept = tables.receipts(spark, "lineage")
    before = dt.datetime.now(dt.timezone.utc) - grace
    folders = sorted(r["folder"] for r in unreachable(spark, tables, kept, before).collect())
    lake.remove_folders(spark, [f"{tables.root}/{folder}" for folder in folders])
    for layer in UNNAMED:
        lake.expire_days(spark, f"{tables.root}/{layer}", now.date(), quarantine_days)
    return Swept(gone["superseded"], gone["expired"], tuple(folders))


def _drop_rows(spark: SparkSession, tables: Tables, fate: str, today: dt.date, keep_days: dict[str, int]) -> int:
    """Remove the lineage rows of one fate; returns their number. What else a receipt holds is written first, beside
    it: while both are there, readers see the same artifact once."""
    rows = checkpointed(marked(tables.receipts(spark, "lineage"), today, keep_days))
    listed = rows.groupBy("day", "receipt").agg(
        F.count_if(F.col("fate") == fate).alias("gone"), F.count_if(F.col("fate") != fate).alias("left")).filter("gone > 0").collect()
    for receipt in listed:
        folder = f"{tables.ops('lineage')}/day={receipt['day'].isoformat()}/receipt={receipt['receipt']}"
        if receipt["left"]:
            own = (F.col("day") == receipt["day"]) & (F.col("receipt") == receipt["receipt"])
            rows.filter(own & (F.col("fate") != fate)).drop("day", "receipt", "fate").coalesce(1).write.mode("overwrite").parquet(f"{folder}-left")
        lake.remove_folders(spark, [folder])
    return sum(r["gone"] for r in listed)
