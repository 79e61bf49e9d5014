"""Grouped and global statistics, histogram, bounds.

Every grouping here combines before the shuffle: a task sends one row per group it saw,
so neither the number of rows nor a group that holds most of them matters after the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions import numeric as N


@dataclass(frozen=True)
class Measure:
    """A column and its statistics.

    ``digits`` declares that all its values have that many decimals, which makes the mean
    exact; None, the default, claims nothing.
    """

    column: str
    stats: tuple[str, ...]
    digits: int | None = None

    def columns(self) -> list[Column]:
        return [self._one(s).alias(f"{self.column}_{s}") for s in self.stats]

    def _one(self, stat: str) -> Column:
        value = F.col(self.column)
        if stat == "mean":
            return N.mean(value, self.digits)
        if stat == "std":
            return N.round_even(F.stddev_samp(value))
        if stat == "count":
            return F.count(value)
        return N.round_even({"min": F.min, "max": F.max}[stat](value))


# Which statistics the daily and the per-city report hold.
DAILY_MEASURES = (
    Measure("temperature_celsius", ("mean", "min", "max", "std")),
    Measure("humidity", ("mean", "min", "max")),
    Measure("pressure", ("mean",)),
    Measure("wind_speed", ("mean", "max")),
    Measure("clouds_percentage", ("mean",)),
    Measure("visibility", ("mean",)),
)
CITY_MEASURES = (
    Measure("temperature_celsius", ("mean", "min", "max", "std", "count")),
    Measure("humidity", ("mean",)),
    Measure("pressure", ("mean",)),
    Measure("wind_speed", ("mean",)),
)
# Names and types of the daily serving table.
DAILY_SERVING = {
    "temp_avg": ("temperature_celsius_mean", "decimal(5,2)"),
    "temp_min": ("temperature_celsius_min", "decimal(5,2)"),
    "temp_max": ("temperature_celsius_max", "decimal(5,2)"),
    "temp_std": ("temperature_celsius_std", "decimal(5,2)"),
    "humidity_avg": ("humidity_mean", "decimal(5,2)"),
    "pressure_avg": ("pressure_mean", "decimal(7,2)"),
    "wind_speed_avg": ("wind_speed_mean", "decimal(6,2)"),
    "wind_speed_max": ("wind_speed_max", "decimal(6,2)"),
    "clouds_avg": ("clouds_percentage_mean", "decimal(5,2)"),
}


def grouped_statistics(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Measure], rows: str | None = None
) -> DataFrame:
    """Rounded statistics per group; rows with a NULL key belong to no group."""
    present = df.dropna(subset=list(keys))
    columns = [c for m in measures for c in m.columns()]
    if rows:
        columns.append(F.count(F.lit(1)).alias(rows))
    return present.groupBy(*keys).agg(*columns)


def daily_statistics(
    df: DataFrame,
    keys: Sequence[str] = ("city", "country"),
    event_time: str = "timestamp",
    measures: Sequence[Measure] = DAILY_MEASURES,
    rows: str | None = None,
) -> DataFrame:
    """Statistics per group and UTC calendar date; the date is text."""
    dated = df.withColumn("date", F.to_date(event_time))
    return grouped_statistics(dated, [*keys, "date"], measures, rows).withColumn(
        "date", F.col("date").cast("string")
    )


def city_statistics(
    df: DataFrame,
    keys: Sequence[str] = ("city", "country"),
    measures: Sequence[Measure] = CITY_MEASURES,
    counted: str = "temperature_celsius",
) -> DataFrame:
    return grouped_statistics(df, keys, measures).withColumnRenamed(
        f"{counted}_count", "observation_count"
    )


def daily_serving_rows(df: DataFrame, entity: str = "city", event_time: str = "timestamp") -> DataFrame:
    """Rows of the daily serving table, keyed by entity and date. A statistic that does not
    fit its column fails the query: it must not turn into an absent one."""
    daily = daily_statistics(df, (entity,), event_time, rows="observation_count")
    served = [
        F.when(F.col(source).isNull() | F.col(source).try_cast(kind).isNotNull(), F.col(source).try_cast(kind))
        .otherwise(F.raise_error(F.lit(f"{source} does not fit {kind}")).cast(kind))
        .alias(name)
        for name, (source, kind) in DAILY_SERVING.items()
    ]
    return daily.select(entity, F.col("date").cast("date").alias("date"), *served, "observation_count")


def batch_metadata(df: DataFrame, entity: str, event_time: str) -> DataFrame:
    """One row: records, distinct entities, first and last date."""
    return df.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct(entity).alias("entity_count"),
        F.to_date(F.min(event_time)).cast("string").alias("start_date"),
        F.to_date(F.max(event_time)).cast("string").alias("end_date"),
    )


def quality_snapshot(
    df: DataFrame,
    entity: str = "city",
    event_time: str = "recorded_at",
    measure: str = "temperature_celsius",
    completeness: str = "humidity",
    plausible: tuple[float, float] = fixed.PLAUSIBLE_CELSIUS,
    digits: int | None = None,
) -> DataFrame:
    """One row of table health; zero-safe on an empty table."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(entity).alias("unique_entities"),
        F.min(event_time).alias("earliest_record"),
        F.max(event_time).alias("latest_record"),
        F.coalesce(N.mean(F.col(measure), digits), F.lit(0.0)).alias("avg_measure"),
        F.count(completeness).alias("_complete"),
        F.count_if(F.col(measure).between(*plausible)).alias("_plausible"),
    )
    total = F.col("total_records")
    return counted.select(
        "total_records",
        "unique_entities",
        "earliest_record",
        "latest_record",
        "avg_measure",
        N.share_percent(F.col("_complete"), total).alias("data_completeness"),
        N.share_percent(F.col("_plausible"), total).alias("valid_measure_pct"),
    )


def filtered_statistics(
    df: DataFrame, measure: str, second: str, digits: int | None = None
) -> DataFrame:
    """Count and range of the rows a reader has selected."""
    return df.agg(
        F.count(F.lit(1)).alias("count"),
        N.mean(F.col(measure), digits).alias("avg_measure"),
        F.max(measure).alias("max_measure"),
        F.min(measure).alias("min_measure"),
        N.mean(F.col(second), digits).alias("avg_second"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def date_bounds(df: DataFrame, event_time: str) -> DataFrame:
    """First and last calendar date, the default range of a date filter."""
    return df.agg(
        F.to_date(F.min(event_time)).alias("first_date"), F.to_date(F.max(event_time)).alias("last_date")
    )


def histogram(
    df: DataFrame, value: str, bins: int = fixed.HISTOGRAM_BINS, split: str | None = None
) -> DataFrame:
    """Counts in equal-width bins between the smallest and the largest value.

    The bounds are a scalar subquery, so the counting pass stays one narrow scan followed
    by a combine of at most ``bins`` rows per split value and task.
    """
    number = F.col(value).cast("double")  # NaN and infinities have no bin
    present = df.filter(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))))
    bounds = present.agg(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))
    low, high = bounds.select("low").scalar(), bounds.select("high").scalar()
    width = (high - low) / F.lit(float(bins))
    position = F.when(width > 0, F.floor((F.col(value) - low) / width)).otherwise(F.lit(0))
    keys = ["bin"] + ([split] if split else [])
    return (
        present.withColumn("bin", F.least(position, F.lit(bins - 1)).cast("int"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("low", low + F.col("bin") * width)
        .withColumn("high", low + (F.col("bin") + 1) * width)
    )
