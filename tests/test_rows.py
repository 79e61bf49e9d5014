"""Cleaning, validation and quarantine of weather rows."""

import json

import pytest
from pyspark.sql import functions as F

from samples import BRAGA, TURIN, RUN_TS, rows
from tidewell import fixed_values as fixed
from tidewell.operators import cleaning as K
from tidewell.spec import WEATHER


def judged(df):
    return K.clean_with_reason(df, WEATHER, RUN_TS)


def test_columns_against_bronze(raw):
    cleaned = K.clean(raw({}), WEATHER, RUN_TS)
    assert set(fixed.BRONZE_COLUMNS) - set(cleaned.columns) == {"temperature_kelvin", "ingested_at"}
    assert set(cleaned.columns) - set(fixed.BRONZE_COLUMNS) == {"_transformed_at", "_source_layer"}
    assert judged(raw({})).drop("reason", "record").columns == cleaned.columns


@pytest.mark.parametrize("name", ["city", "country", "temperature_celsius", "timestamp"])
def test_missing_required_field(raw, name):
    assert rows(judged(raw({name: None})), "reason") == [(f"Missing required field '{name}'",)]
    assert rows(judged(raw({}, drop=[name])), "reason") == [(f"Missing required field '{name}'",)]


def test_first_failure_names_the_reason(raw):
    broken = dict(country=" ", temperature_celsius="200", humidity="150")
    assert rows(judged(raw(broken)), "reason") == [("Missing required field 'country'",)]
    broken["country"] = "GB"
    assert rows(judged(raw(broken)), "reason") == [("temperature_celsius=200.0 outside range [-100, 100]",)]
    broken["temperature_celsius"] = "20"
    assert rows(judged(raw(broken)), "reason") == [("humidity=150 outside range [0, 100]",)]


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"pressure": "799"}, "pressure=799 outside range [800, 1200]"),
        ({"visibility": "100001"}, "visibility=100001 outside range [0, 100000]"),
        ({"wind_speed": "nan"}, "wind_speed=NaN outside range [0, 200]"),
        ({"humidity": "inf"}, "cannot convert float infinity to integer"),
        ({"wind_direction": "1e30"}, "wind_direction=1.0E30 is too large"),
    ],
)
def test_ranges(raw, change, reason):
    assert rows(judged(raw(change)), "reason") == [(reason,)]


def test_bounds_are_inclusive_and_null_passes(raw):
    kept = raw(
        {"temperature_celsius": "-100"}, {"temperature_celsius": "100"}, {"humidity": None, "visibility": None, "wind_speed": "0"},
        {"feels_like_celsius": "nan"},
    )
    assert rows(judged(kept), "reason") == [(None,)] * 4
    assert rows(K.valid_rows(judged(kept)).filter("humidity is null"), "humidity", "visibility", "wind_speed") == [(None, None, 0.0)]
    assert K.valid_rows(judged(kept)).filter("feels_like_celsius is null").count() == 1


def test_absent_temperature_is_never_zero(raw):
    assert K.valid_rows(judged(raw({"temperature_celsius": None}))).count() == 0


def test_quarantine(raw):
    both = judged(raw({}, {"temperature_celsius": "200"}))
    assert K.valid_rows(both).count() == 1
    dead = K.quarantine_rows(both, RUN_TS).collect()
    assert len(dead) == 1
    assert dead[0]["source_layer"] == "silver" and dead[0]["reason"]
    assert dead[0]["quarantined_at"].replace(tzinfo=None) == RUN_TS.replace(tzinfo=None)
    assert json.loads(dead[0]["record"]) == dict(BRAGA, temperature_celsius="200")


def test_typed_input_needs_no_text(spark):
    df = spark.createDataFrame([("Rome", "IT", 12.5, 40)], "city string, country string, temperature_celsius double, humidity int")
    found = judged(df.withColumn("timestamp", F.timestamp_seconds(F.lit(1706616000))))
    assert rows(found, "city", "temperature_celsius", "humidity", "reason") == [("Rome", 12.5, 40, None)]


def test_values_are_parsed_once(raw):
    """A filter on the reason stays above the parsing."""
    plan = K.valid_rows(judged(raw(TURIN)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")
    assert "Filter" not in plan[plan.index("Generate"):]
