"""Spec-driven cleaning, row validation and the valid/reject split."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import fixed_values as fixed
from ..functions import cleaning as C, numeric as N
from ..spec import MOMENT, NUMBER, TEXT, WHOLE, Field, TableSpec

_BUILDERS = {TEXT: C.clean_text, NUMBER: C.to_number, WHOLE: C.to_whole, MOMENT: C.to_moment}

REASON, RECORD = "reason", "record"


def _source(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """Column and type of a raw field; an absent column reads as NULL text."""
    if name in df.columns:
        return F.col(f"`{name}`"), df.schema[name].dataType
    return F.lit(None).cast("string"), T.StringType()


def _cleaned(df: DataFrame, field: Field) -> Column:
    value = _BUILDERS[field.kind](*_source(df, field.name))
    if field.kind == NUMBER and not field.ranged:
        # a ranged NaN is kept, so that the range check rejects the row
        value = F.nanvl(value, F.lit(None).cast("double"))
    return value.alias(field.name)


def clean(df: DataFrame, spec: TableSpec, run_ts: dt.datetime, source_layer: str = "bronze") -> DataFrame:
    """Project raw rows onto the cleaned columns plus run metadata."""
    return df.select(
        *[_cleaned(df, f) for f in spec.fields],
        N.as_moment(run_ts).alias("_transformed_at"),
        F.lit(source_layer).alias("_source_layer"),
    )


def _range_reason(field: Field) -> Column:
    value = F.col(field.name)
    text = F.concat(
        F.lit(field.name + "="),
        value.cast("string"),
        F.lit(fixed.RANGE_REASON.format(low=field.low, high=field.high)),
    )
    return F.when(~value.between(field.low, field.high), text)


def rejection_reason(spec: TableSpec) -> Column:
    """First failing requirement of a cleaned row, NULL for a usable one."""
    missing = [
        F.when(F.col(f.name).isNull(), F.lit(fixed.MISSING_REASON.format(field=f.name)))
        for f in spec.required
    ]
    return F.coalesce(*missing, *[_range_reason(f) for f in spec.ranged])


def _unfit_reason(field: Field, number: Column) -> Column:
    """Reason for a present number that no whole number can hold."""
    infinite = F.abs(number) == F.lit(float("inf"))
    text = F.concat(F.lit(field.name + "="), number.cast("string"), F.lit(" is too large"))
    unfit = C.does_not_fit(number)
    return F.when(unfit & infinite, F.lit(fixed.INFINITE_REASON)).when(unfit, text)


def clean_with_reason(
    df: DataFrame, spec: TableSpec, run_ts: dt.datetime, source_layer: str = "bronze"
) -> DataFrame:
    """Cleaned rows with ``reason`` and, for rejects only, the raw row as JSON ``record``.

    One narrow pass over the raw rows: nothing is shuffled, and the JSON text is built
    only where there is a reason. The steps are separate projections, so that a value is
    parsed once however often it is checked; the generated row keeps a later filter on
    ``reason`` from being pushed below the parsing, which would parse everything again.
    """
    parsed, early, finished = [], [], {}
    for f in spec.fields:
        value, source = _source(df, f.name)
        if f.kind == WHOLE and not isinstance(source, T.IntegralType):
            number = F.col(f"_n_{f.name}")
            parsed.append(C.to_number(value, source).alias(f"_n_{f.name}"))
            finished[f.name] = number.try_cast("bigint").alias(f.name)
            early.append(_unfit_reason(f, number))
        else:
            parsed.append(_cleaned(df, f))
            finished[f.name] = F.col(f.name)
    raw = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_raw")
    first = F.coalesce(*early) if early else F.lit(None).cast("string")
    judged = (
        df.select(*parsed, raw)
        .select(*[finished[f.name] for f in spec.fields], first.alias("_early"), "_raw")
        .select(
            *[f.name for f in spec.fields],
            N.as_moment(run_ts).alias("_transformed_at"),
            F.lit(source_layer).alias("_source_layer"),
            F.coalesce(F.col("_early"), rejection_reason(spec)).alias(REASON),
            "_raw",
        )
    )
    record = F.when(F.col(REASON).isNotNull(), F.to_json("_raw")).alias(RECORD)
    return judged.select(F.inline(F.array(F.struct(*spec.clean_columns, REASON, record))))


def valid_rows(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(REASON).isNull()).drop(REASON, RECORD)


def quarantine_rows(judged: DataFrame, run_ts: dt.datetime, source_layer: str = "silver") -> DataFrame:
    """Dead-letter rows: raw record, reason, time, layer that rejected it."""
    return judged.filter(F.col(REASON).isNotNull()).select(
        RECORD,
        REASON,
        N.as_moment(run_ts).alias("quarantined_at"),
        F.lit(source_layer).alias("source_layer"),
    )
