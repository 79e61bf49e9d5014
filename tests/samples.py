"""Weather rows to work on, and collected rows as tuples."""

from __future__ import annotations

import datetime as dt

RUN_TS = dt.datetime(2024, 1, 30, 13, 0, tzinfo=dt.timezone.utc)
RAW_DDL = (
    "city string, country string, temperature_kelvin string, temperature_celsius string, "
    "feels_like_celsius string, humidity string, pressure string, wind_speed string, wind_direction string, "
    "weather_condition string, weather_description string, clouds_percentage string, visibility string, "
    "timestamp string, sunrise string, sunset string, ingested_at string"
)
BRAGA = dict(
    city="Braga", country="PT", temperature_kelvin="286.9", temperature_celsius="13.75", feels_like_celsius="12.5",
    humidity="58", pressure="1021", wind_speed="6.25", wind_direction="305", weather_condition="Rain",
    weather_description="light rain", clouds_percentage="35", visibility="8200", timestamp="2024-01-30T12:00:00+00:00",
    sunrise="2024-01-30T07:52:10+00:00", sunset="2024-01-30T17:48:30+00:00", ingested_at="2024-01-30T12:06:00+00:00",
)
TURIN = dict(
    BRAGA, city="Turin", country="IT", temperature_celsius="6.25", feels_like_celsius="4.5", humidity="71",
    pressure="1017", wind_speed="2.75", wind_direction="15", weather_condition="Mist", clouds_percentage="80",
    visibility="4100",
)


def rows(df, *columns):
    """Collected rows as plain tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
