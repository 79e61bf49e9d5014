"""Derived columns: bins, heat index, calendar features."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fixed


def binned(value: Column, edges: tuple, labels: tuple) -> Column:
    """Label of the right-closed bin (edge, next edge] that holds the value."""
    label = None
    for low, high, name in zip(edges, edges[1:], labels):
        inside = (value > F.lit(low)) & (value <= F.lit(high))
        label = F.when(inside, F.lit(name)) if label is None else label.when(inside, F.lit(name))
    return label


def temperature_category(celsius: Column) -> Column:
    return binned(celsius, fixed.TEMPERATURE_EDGES, fixed.TEMPERATURE_LABELS)


def wind_category(speed: Column) -> Column:
    return binned(speed, fixed.WIND_EDGES, fixed.WIND_LABELS)


def kelvin_to_celsius(kelvin: Column) -> Column:
    return F.round(kelvin - F.lit(fixed.KELVIN_OFFSET), 2)


def heat_index(celsius: Column, humidity: Column) -> Column:
    """Felt temperature in Celsius; the plain temperature where it is mild or dry."""
    warm = celsius * 9 / 5 + 32
    felt = F.lit(0.5) * (
        warm
        + F.lit(fixed.HEAT_BASE)
        + (warm - F.lit(fixed.HEAT_PIVOT)) * F.lit(fixed.HEAT_SLOPE)
        + humidity * F.lit(fixed.HEAT_HUMIDITY_SLOPE)
    )
    applies = (warm >= fixed.HEAT_MIN_FAHRENHEIT) & (humidity >= fixed.HEAT_MIN_HUMIDITY)
    return (F.when(applies, felt).otherwise(warm) - 32) * 5 / 9


def calendar_features(moment: Column, celsius: Column, humidity: Column) -> dict[str, Column]:
    """Hour, weekday name, daytime and comfort flags; absence means false."""
    hour = F.hour(moment)
    comfortable = celsius.between(*fixed.COMFORT_CELSIUS) & humidity.between(*fixed.COMFORT_HUMIDITY)
    return {
        "hour": hour,
        "day_of_week": F.date_format(moment, "EEEE"),
        "is_daytime": F.coalesce(hour.between(*fixed.DAYTIME_HOURS), F.lit(False)),
        "is_comfortable": F.coalesce(comfortable, F.lit(False)),
        "heat_index": heat_index(celsius, humidity),
    }
