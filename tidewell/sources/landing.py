"""Landing payloads: classify the fetch outcome and flatten to bronze columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as fixed
from ..functions import cleaning as C, enrichment as E, numeric as N

# The layout of one payload.
PAYLOAD_DDL = (
    "coord struct<lon: double, lat: double>, "
    "weather array<struct<id: int, main: string, description: string, icon: string>>, "
    "base string, "
    "main struct<temp: double, feels_like: double, temp_min: double, temp_max: double, "
    "pressure: bigint, humidity: bigint>, "
    "visibility bigint, wind struct<speed: double, deg: bigint>, clouds struct<all: bigint>, "
    "dt bigint, sys struct<country: string, sunrise: bigint, sunset: bigint>, "
    "timezone int, id bigint, name string, cod string"
)
CORRUPT = "_corrupt_record"


def read_landing(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """Payload files; one that does not parse keeps its text in ``_corrupt_record``."""
    paths = [path] if isinstance(path, str) else list(path)
    return (
        spark.read.schema(f"{PAYLOAD_DDL}, {CORRUPT} string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        .json(paths)
    )


def parse_landing(df: DataFrame, column: str) -> DataFrame:
    """Payloads that arrive as a text column, parsed the same way."""
    parsed = F.from_json(
        F.col(column),
        f"{PAYLOAD_DDL}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    # the generated row keeps the text from being parsed once per field that is read
    return df.select(F.inline(F.array(parsed)))


def fetch_outcome(payloads: DataFrame) -> Column:
    """NULL for a usable payload, else why the fetch failed."""
    code = F.col("cod").try_cast("int")
    if CORRUPT in payloads.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("Payload does not parse"))
    else:
        reason = F.when(F.lit(False), F.lit(""))
    name = F.coalesce(F.col("name"), F.lit(fixed.UNKNOWN))
    for status, text in fixed.FETCH_OUTCOMES.items():
        head, _, tail = text.partition("{name}")
        message = F.concat(F.lit(head), name, F.lit(tail)) if "{name}" in text else F.lit(text)
        reason = reason.when(code == status, message)
    bad = F.coalesce(~code.between(200, 399), F.lit(False))
    return reason.when(bad, F.lit(fixed.FETCH_FAILED))


def for_entities(payloads: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Payloads of the wanted entities; no list means all."""
    return payloads if names is None else payloads.filter(F.col("name").isin(list(names)))


def split_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable payloads, and the failed ones with their reason."""
    judged = payloads.withColumn("reason", fetch_outcome(payloads))
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def flatten(payloads: DataFrame, run_ts: dt.datetime, compat_defaults: bool = False) -> DataFrame:
    """One bronze row per payload.

    Absent input stays NULL, to be judged by the cleaner. ``compat_defaults`` fills it with
    zero, 'Unknown' or the epoch instead.
    """

    def given(name: str, default: object) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if compat_defaults else F.col(name)

    first = F.try_element_at(F.col("weather"), F.lit(1))

    def of_first(name: str, default: str) -> Column:
        return F.coalesce(first[name], F.lit(default)) if compat_defaults else first[name]

    def moment(name: str) -> Column:
        return C.from_epoch(given(name, 0).cast("double"))

    kelvin = given("main.temp", 0.0)
    return payloads.select(
        F.col("name").alias("city"),
        given("sys.country", fixed.UNKNOWN).alias("country"),
        kelvin.alias("temperature_kelvin"),
        E.kelvin_to_celsius(kelvin).alias("temperature_celsius"),
        E.kelvin_to_celsius(given("main.feels_like", 0.0)).alias("feels_like_celsius"),
        given("main.humidity", 0).alias("humidity"),
        given("main.pressure", 0).alias("pressure"),
        given("wind.speed", 0.0).alias("wind_speed"),
        given("wind.deg", 0).alias("wind_direction"),
        of_first("main", fixed.UNKNOWN).alias("weather_condition"),
        of_first("description", "").alias("weather_description"),
        given("clouds.all", 0).alias("clouds_percentage"),
        given("visibility", 0).alias("visibility"),
        moment("dt").alias("timestamp"),
        moment("sys.sunrise").alias("sunrise"),
        moment("sys.sunset").alias("sunset"),
        N.as_moment(run_ts).alias("ingested_at"),
    )
