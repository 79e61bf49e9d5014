"""Reports over run rows and gate rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions import numeric as N
from ..operators.keyed_join import joined_to_parent
from ..operators.reads import latest_per_key, newest

RECENT_COLUMNS = (
    "run_id",
    "status",
    "started_at",
    "completed_at",
    "duration_seconds",
    "entities_processed",
    "records_loaded",
    "quality_gate_passed",
    "error_message",
)


def _day_and_layer(gates: DataFrame, *more: Column) -> DataFrame:
    passed = F.col("gate_passed")
    return gates.groupBy(F.to_date("evaluated_at").cast("string").alias("date"), "layer").agg(
        *more,
        # pass rates have two decimals: their sum is exact, whatever the order
        N.exact_mean(F.col("pass_rate").cast("double")).alias("avg_pass_rate"),
        F.count_if(passed).alias("gates_passed"),
        F.count_if(~passed).alias("gates_failed"),
    )


def quality_trend(gates: DataFrame, now: dt.datetime, days: int = fixed.TREND_DAYS) -> DataFrame:
    """Daily average pass rate per layer in the look-back window, oldest first."""
    since = now - dt.timedelta(days=days)
    if gates.schema["evaluated_at"].dataType.typeName() == "timestamp_ntz":
        start = F.lit(since.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    else:
        start = N.as_moment(since)
    return _day_and_layer(gates.filter(F.col("evaluated_at") >= start)).orderBy("date", "layer")


def quality_summary(gates: DataFrame) -> DataFrame:
    """The whole history per day and layer with the number of gates, newest first."""
    counted = _day_and_layer(gates, F.count(F.lit(1)).alias("total_runs"))
    return counted.orderBy(F.desc("date"), "layer")


def run_stats(runs: DataFrame, window: int = fixed.RUN_STATS_WINDOW, tie_break: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Success share and mean duration of the newest runs beside the count and last start
    of all runs; no row when there are no runs."""
    recent = newest(runs.select("status", "duration_seconds", "started_at", *tie_break), "started_at", window, tie_break)
    whole = runs.agg(F.max("started_at").alias("last_run_at"), F.count(F.lit(1)).alias("total_runs"))
    counted = recent.agg(
        N.round_even(F.avg("duration_seconds")).alias("avg_duration_seconds"),
        N.share_percent(F.count_if(F.col("status") == "success"), F.count(F.lit(1))).alias("success_rate"),
        F.count(F.lit(1)).alias("_recent"),
    ).filter("_recent > 0")
    return counted.select(
        whole.select("last_run_at").scalar().alias("last_run_at"),
        whole.select("total_runs").scalar().alias("total_runs"),
        "avg_duration_seconds",
        "success_rate",
    )


def recent_runs(runs: DataFrame, limit: int = fixed.RECENT_RUNS, tie_break: tuple[str, ...] = ("run_id",)) -> DataFrame:
    shown = [c for c in RECENT_COLUMNS if c in runs.columns]
    return newest(runs, "started_at", limit, tie_break).select(*shown)


def latest_gate_results(gates: DataFrame, tie_break: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """The newest gate row of each layer."""
    return latest_per_key(gates, ["layer"], "evaluated_at", tie_break)


def gates_of_runs(gates: DataFrame, runs: DataFrame, **how) -> DataFrame:
    """Gate rows with the columns of the run they belong to."""
    return joined_to_parent(gates, runs, ["run_id"], **how)
