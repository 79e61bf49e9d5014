"""Robust outliers per group by the modified z-score (median and MAD)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions import cleaning as C, numeric as N
from .keyed_join import attach
from .medians import EXACT_GROUP_ROWS, GroupSizes, group_sizes, grouped_median

_ENTITY = "_entity"


def group_spread(
    readings: DataFrame, entity: str, value: str, sizes: GroupSizes, exact_rows: int = EXACT_GROUP_ROWS
) -> DataFrame:
    """Row count ``n``, ``median`` and ``mad`` of each group; NULL is a group like any other."""
    small = sizes.fits_broadcast()
    slim = readings.select(entity, value)
    medians = grouped_median(slim, [entity], value, sizes, exact_rows=exact_rows).drop("n")
    held = slim.withColumn(_ENTITY, F.struct(entity))  # never NULL itself
    centres = medians.select(F.struct(entity).alias(_ENTITY), "median")
    deviations = attach(held, centres, [_ENTITY], small=small).select(
        entity, "median", F.abs(F.col(value) - F.col("median")).alias("_deviation")
    )
    return grouped_median(
        deviations, [entity], "_deviation", sizes, name="mad", carry=["median"], exact_rows=exact_rows
    )


def robust_outliers(
    df: DataFrame,
    entity: str,
    value: str,
    threshold: float = fixed.OUTLIER_THRESHOLD,
    min_samples: int = fixed.OUTLIER_MIN_SAMPLES,
    exact_rows: int = EXACT_GROUP_ROWS,
) -> DataFrame:
    """Rows whose score 0.6745 * (x - median) / MAD reaches the threshold.

    Groups with too few readings or without spread are not scored; absent and
    non-numeric readings are ignored; rows without an entity are a group of their own. Adds
    ``z_score`` rounded to two digits.
    """
    number = C.to_number(F.col(value), df.schema[value].dataType)
    readings = df.withColumn("_x", number).filter(
        F.col("_x").isNotNull() & ~F.isnan("_x")
    ).withColumn(_ENTITY, F.struct(entity))
    slim = readings.select(entity, "_x")
    sizes = group_sizes(slim, [entity])
    spread = group_spread(slim, entity, "_x", sizes, exact_rows)
    scored = spread.filter((F.col("n") >= min_samples) & (F.col("mad") != 0)).select(
        F.struct(entity).alias(_ENTITY), F.col("median").alias("_median"), F.col("mad").alias("_mad")
    )
    z = F.lit(fixed.MAD_SCALE) * (F.col("_x") - F.col("_median")) / F.col("_mad")
    return (
        attach(readings, scored, [_ENTITY], small=sizes.fits_broadcast())
        .withColumn("_z", z)
        .filter(F.abs("_z") >= threshold)
        .withColumn("z_score", N.round_even(F.col("_z")))
        .select(*df.columns, "z_score")
    )


def by_severity(outliers: DataFrame, *tie_break: str) -> DataFrame:
    """Largest absolute score first."""
    return outliers.orderBy(F.abs("z_score").desc(), *tie_break)
