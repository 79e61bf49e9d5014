"""Rounding, exact means, shares and ages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def round_even(value: Column, digits: int = 2) -> Column:
    """Round with ties to the even neighbour of the scaled value."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def fixed_point(value: Column, digits: int = 2) -> Column:
    """The value in whole units of its last digit (cents for two digits)."""
    return F.round(value * F.lit(float(10**digits))).cast("bigint")


def exact_mean(value: Column, digits: int = 2) -> Column:
    """Mean of a measure with a fixed number of decimals, rounded to the same number.

    The sum is kept in whole units, so it does not depend on the order in which partial
    sums arrive: a retried task or another partitioning gives the same result to the last
    digit, which a floating-point sum does not.
    """
    units = F.sum(fixed_point(value, digits)).cast("double")
    return F.rint(units / F.count(value)) / F.lit(float(10**digits))


def mean(value: Column, digits: int | None = None) -> Column:
    """Mean rounded to two digits; exact where the decimals of the measure are declared."""
    return round_even(F.avg(value)) if digits is None else exact_mean(value, digits)


def share_percent(part: Column, total: Column, digits: int = 2) -> Column:
    """Percentage of a total that may be zero."""
    return round_even(
        part.cast("double") / F.greatest(total, F.lit(1)).cast("double") * F.lit(100.0), digits
    )


def pass_rate(passed: Column, total: Column) -> Column:
    """passed / total in percent as DECIMAL(5,2); zero for an empty batch."""
    exact = passed.cast("decimal(20,0)") * F.lit(100) / total.cast("decimal(20,0)")
    return F.when(total > 0, exact).otherwise(F.lit(0)).cast("decimal(5,2)")


def as_moment(moment: dt.datetime) -> Column:
    """Literal for one run-wide moment; a value without zone is UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    return F.timestamp_micros(F.lit(_micros(aware)))


def _micros(aware: dt.datetime) -> int:
    return (aware - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def age_hours(moment: Column, now: dt.datetime) -> Column:
    """Hours between an observation and the run moment."""
    return (F.unix_micros(as_moment(now)) - F.unix_micros(moment.cast("timestamp"))) / F.lit(3.6e9)


def whole_seconds(seconds: Column) -> Column:
    """Duration truncated to whole seconds."""
    return seconds.cast("bigint")
