"""Named views, so that the serving and operational tables can be queried in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import fixed_values as fixed
from ..operators.reads import latest_per_key, newest
from ..sources import serving
from ..spec import WEATHER, TableSpec
from .medallion import Tables
from .reports import quality_summary, recent_runs

# Names of the tables and views, and the columns of the latest-row view.
GOLD, RUNS, GATES = "gold_weather", "pipeline_runs", "data_quality_metrics"
LATEST, SUMMARY, RECENT = "v_latest_weather", "v_quality_summary", "v_recent_runs"
LATEST_COLUMNS = (
    "id", "city", "country", "temperature_celsius", "humidity", "weather_condition",
    "weather_description", "wind_speed", "recorded_at", "ingested_at",
)


def register(
    gold: DataFrame, runs: DataFrame, gates: DataFrame, entity: str = "city",
    event_time: str = "recorded_at", tie_break: tuple[str, ...] = (), prefix: str = "",
) -> None:
    """Register the three tables and the three views over them, their names after ``prefix``:
    views of the same names in the session are replaced."""
    tables = {GOLD: gold, RUNS: runs, GATES: gates}
    latest = latest_per_key(gold, [entity], event_time, tie_break)
    shown = [c for c in LATEST_COLUMNS if c in latest.columns] if entity == "city" else latest.columns
    views = {
        LATEST: latest.select(*shown),
        SUMMARY: quality_summary(gates),
        RECENT: recent_runs(runs, fixed.RUN_STATS_WINDOW),
    }
    for name, df in (tables | views).items():
        df.createOrReplaceTempView(prefix + name)


def register_installation(spark: SparkSession, tables: Tables, spec: TableSpec = WEATHER) -> None:
    """Register the tables of one installation by their paths."""
    register(
        serving.read_served(spark, tables.serving, spec),
        tables.read_ops(spark, "runs"),
        tables.read_ops(spark, "quality_metrics"),
        spec.entity,
    )


def latest_rows(spark: SparkSession, limit: int = fixed.LATEST_ROWS) -> DataFrame:
    """Newest rows of the serving view."""
    return newest(spark.table(GOLD), "recorded_at", limit, ["city"])
