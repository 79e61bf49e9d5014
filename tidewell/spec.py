"""Table specifications: which fields a layer has and what makes a row usable.

A spec is the only place where a table's fields are listed. The cleaner, the row
validator, the gate rules and the constraint checks are all derived from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from . import fixed_values as fixed

TEXT, NUMBER, WHOLE, MOMENT = "text", "number", "whole", "moment"

SPARK_TYPES = {
    TEXT: T.StringType(),
    NUMBER: T.DoubleType(),
    WHOLE: T.LongType(),
    MOMENT: T.TimestampType(),
}


@dataclass(frozen=True)
class Field:
    """One cleaned column.

    ``low``/``high`` are the inclusive limits a present value must respect to be kept
    as a row. ``max_length``, ``allowed`` and ``serving_range`` apply only on the way
    into the serving table, where ``precision`` gives its DECIMAL type.
    """

    name: str
    kind: str
    required: bool = False
    low: float | None = None
    high: float | None = None
    max_length: int | None = None
    allowed: tuple[str, ...] = ()
    serving_range: tuple[float, float] | None = None
    precision: tuple[int, int] | None = None

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.kind]

    @property
    def ranged(self) -> bool:
        return self.low is not None and self.high is not None


@dataclass(frozen=True)
class TableSpec:
    """A table of observations: one row per ``key``, measured at ``event_time``."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    entity: str
    event_time: str
    raw_columns: tuple[str, ...] = ()
    # serving columns that a redelivered key changes; None means all but the key
    updates: tuple[str, ...] | None = None
    # ranged fields that the silver gate checks once more; None means all of them
    gated: tuple[str, ...] | None = None

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    @property
    def clean_columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields) + fixed.METADATA_COLUMNS

    @property
    def required(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if f.required)

    @property
    def ranged(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if f.ranged)


# The weather observation with its validity ranges and serving types.
WEATHER = TableSpec(
    name="weather",
    fields=(
        Field("city", TEXT, required=True, max_length=100),
        Field("country", TEXT, required=True, max_length=10),
        Field("temperature_celsius", NUMBER, required=True, low=-100, high=100, precision=(5, 2)),
        Field("feels_like_celsius", NUMBER, precision=(5, 2)),
        Field("humidity", WHOLE, low=0, high=100, serving_range=(0, 100)),
        Field("pressure", WHOLE, low=800, high=1200),
        Field("wind_speed", NUMBER, low=0, high=200, precision=(6, 2)),
        Field("wind_direction", WHOLE, serving_range=(0, 360)),
        Field("weather_condition", TEXT, max_length=50),
        Field("weather_description", TEXT, max_length=200),
        Field("clouds_percentage", WHOLE, low=0, high=100, serving_range=(0, 100)),
        Field("visibility", WHOLE, low=0, high=100000),
        Field("timestamp", MOMENT, required=True),
        Field("sunrise", MOMENT),
        Field("sunset", MOMENT),
    ),
    key=("city", "timestamp"),
    entity="city",
    event_time="timestamp",
    raw_columns=fixed.BRONZE_COLUMNS,
    updates=fixed.UPSERT_UPDATES,
    gated=("temperature_celsius", "humidity"),
)
