"""What was derived from what: traversal of the lineage from any folder to all that depends on it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import numeric as N
from ..sources.workspace import checkpointed
from . import receipts as P

if TYPE_CHECKING:
    from .medallion import Tables

#: Rounds of a traversal; lineage is as deep as there are layers, so more means a circle.
MOST_ROUNDS = 50


def closure(edges: DataFrame, origins: DataFrame) -> DataFrame:
    """(origin, key, depth): every node that can be reached from each of ``origins`` (one column) over ``edges``
    (parent, child), with the length of the shortest way; an origin reaches itself at depth 0.

    Breadth first: a round joins the newest nodes to their edges, and what was reached before is left out, so a
    node with many ways to it is followed once. Circles end, as they reach nothing new.
    """
    links = edges.toDF("parent", "child").filter("parent is not null and child is not null").distinct()
    start = origins.toDF("origin").filter("origin is not null").distinct()
    newest = checkpointed(start.select("origin", F.col("origin").alias("key"), F.lit(0).alias("depth")))
    reached = newest
    for depth in range(1, MOST_ROUNDS + 1):
        ahead = newest.join(links, F.col("key") == F.col("parent")).select("origin", F.col("child").alias("key")).distinct()
        newest = checkpointed(ahead.join(reached, ["origin", "key"], "left_anti").withColumn("depth", F.lit(depth)))
        if newest.isEmpty():
            return reached
        reached = reached.union(newest)
    raise ValueError(f"Lineage is deeper than {MOST_ROUNDS}")


def served_rows(days: DataFrame, result: P.RunResult, key: str) -> DataFrame:
    """Receipts of the serving days that a load has rewritten from a gold folder."""
    return days.select(
        F.lit(result.run_id).alias("run_id"), F.lit(key).alias("key"), F.col("day").alias("served_on"), F.lit(result.attempt).alias("attempt"),
        N.as_moment(dt.datetime.now(dt.timezone.utc)).alias("written_at"),
    )


def derived(spark: SparkSession, tables: Tables, folders: Sequence[str]) -> DataFrame:
    """(origin, key, depth, layer, run_id, record_count, day, current) of all that was derived from some folders, the folders
    included. ``current`` tells whether readers see it: newer attempts at a run take the place of older ones. The
    days of the serving table appear as layer ``serving`` with their ``day``; rows they were given by an older
    attempt may still be in them.
    """
    rows = tables.receipts(spark, "lineage")
    served = tables.receipts(spark, "served")
    day_key = F.concat(F.lit(f"{tables.serving}/recorded_on="), F.col("served_on").cast("string"))
    edges = rows.select(F.explode("parents").alias("parent"), F.col("key").alias("child")).union(
        served.select(F.col("key").alias("parent"), day_key.alias("child")))
    origins = spark.sql("VALUES (1) AS t(one)").select(F.explode(F.array(*[F.lit(f) for f in folders]).cast("array<string>")).alias("origin"))
    reached = closure(edges, origins)
    current = P.current_artifacts(rows).select("key", F.lit(True).alias("_current"))
    nothing = F.lit(None)
    known = rows.select("key", "layer", "run_id", "record_count", nothing.cast("date").alias("day")).join(current, "key", "left").select(
        "key", "layer", "run_id", "record_count", "day", F.coalesce("_current", F.lit(False)).alias("current"))
    days = served.select(
        day_key.alias("key"), F.lit("serving").alias("layer"), nothing.cast("string").alias("run_id"),
        nothing.cast("bigint").alias("record_count"), F.col("served_on").alias("day"), F.lit(True).alias("current")).distinct()
    return reached.join(known.union(days), "key")
