"""Dataset checks.

Two kinds of rule exist. An ``AggRule`` names aggregate measures and turns their values
into issues with plain column expressions; all AggRules of a gate share one aggregation,
so ten checks read the data once. A ``FrameRule`` needs an own grouping (uniqueness,
referential integrity) and returns a frame of issues, at most a handful of rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import fixed_values as fixed
from ..functions import cleaning as C, numeric as N, text as X
from ..spec import WHOLE, TableSpec

ISSUE_DDL = (
    "rule_name string, severity string, message string, affected_records bigint, "
    "details map<string,string>"
)
TOTAL = "total_records"


def issue(
    rule_name: str,
    severity: Column | str,
    message: Column | str,
    affected: Column | int = 0,
    details: dict[str, Column | str] | None = None,
) -> Column:
    """One issue as a struct column."""

    def lit(value):
        return value if isinstance(value, Column) else F.lit(value)

    pairs = [lit(x).cast("string") for kv in (details or {}).items() for x in kv]
    return F.struct(
        F.lit(rule_name).alias("rule_name"),
        lit(severity).alias("severity"),
        lit(message).alias("message"),
        lit(affected).cast("bigint").alias("affected_records"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("details"),
    )


@dataclass(frozen=True)
class AggRule:
    """Measures over the whole batch, judged by column expressions.

    ``measures`` maps a frame to named aggregate columns. ``judge`` gets the columns that
    hold the total and the measured values, and returns one struct column per possible
    issue, NULL where the check passes. ``measures_where`` gives the same aggregates over the
    rows for which a condition holds; a rule without it cannot be observed on part of a frame.
    """

    name: str
    measures: Callable[[DataFrame], dict[str, Column]]
    judge: Callable[[Column, dict[str, Column], DataFrame], Sequence[Column]]
    describe: dict[str, str] = field(default_factory=dict)
    measures_where: Callable[[DataFrame, Column], dict[str, Column]] | None = None


@dataclass(frozen=True)
class FrameRule:
    """A check with its own grouping; ``issues`` returns rows of ``ISSUE_DDL``."""

    name: str
    issues: Callable[[DataFrame], DataFrame]
    describe: dict[str, str] = field(default_factory=dict)


Rule = AggRule | FrameRule


def value_of(df: DataFrame, name: str) -> Column:
    """A column of the batch; one it does not have reads as NULL."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None)


def _number(holds: Column, where: Column | None) -> Column:
    """How many rows fulfil a condition, among all or among those of ``where``."""
    return F.count_if(holds if where is None else where & holds)


def _python_list(names: Iterable[str]) -> str:
    return ", ".join(f"'{n}'" for n in sorted(names))


def schema_drift(expected: Iterable[str]) -> AggRule:
    """Missing columns are critical, extra ones a warning; an empty batch has no drift."""
    wanted = frozenset(expected)

    def judge(total, _, df):
        missing, extra = wanted - set(df.columns), set(df.columns) - wanted
        found = []
        if missing:
            text = f"Missing expected columns: {{{_python_list(missing)}}}"
            found.append(("critical", text, {"missing_columns": ",".join(sorted(missing))}))
        if extra:
            text = f"Unexpected columns found: {{{_python_list(extra)}}}"
            found.append(("warning", text, {"extra_columns": ",".join(sorted(extra))}))
        return [
            F.when(total > 0, issue("schema_drift", severity, text, 0, details))
            for severity, text, details in found
        ]

    return AggRule("schema_drift", lambda df: {}, judge, {"columns": ",".join(sorted(wanted))}, lambda df, where: {})


def null_check(columns: Sequence[str]) -> AggRule:
    """NULLs in required columns; critical above ten percent of the rows."""

    def measures(df, where=None):
        return {c: _number(value_of(df, c).isNull(), where) for c in columns}

    def judge(total, found, _):
        issues = []
        for c in columns:
            percent = found[c] / total * F.lit(100.0)
            severity = F.when(percent > fixed.NULL_PERCENT_CRITICAL, "critical").otherwise("warning")
            text = F.concat(
                F.format_string(f"Column '{c}' has %d null values (", found[c]),
                X.one_decimal(percent),
                F.lit("%)"),
            )
            details = {"column": c, "null_percentage": percent}
            issues.append(F.when(found[c] > 0, issue("null_check", severity, text, found[c], details)))
        return issues

    return AggRule("null_check", measures, judge, {"columns": ",".join(columns)}, measures)


def violates_range(value: Column, low: float, high: float) -> Column:
    """Present and outside the inclusive range."""
    return F.coalesce(~value.between(low, high), F.lit(False))


def range_samples(value: Column, low: float, high: float) -> dict[str, Column]:
    """Samples of what lies outside a range: its ends and the nearest misses on either side.
    Plain aggregates, so they cost no pass of their own and combine before the shuffle."""
    below, above = F.when(value < low, value), F.when(value > high, value)
    return {"sample0": F.min(below), "sample1": F.max(below), "sample2": F.min(above), "sample3": F.max(above)}


def sample_text(values: Sequence[Column]) -> Column:
    """Distinct present values in ascending order, as one text."""
    held = F.array_sort(F.array_distinct(F.filter(F.array(*values), lambda v: v.isNotNull())))
    return F.concat(F.lit("["), F.array_join(F.transform(held, lambda v: v.cast("string")), ", "), F.lit("]"))


def range_check(column: str, low: float, high: float) -> AggRule:
    """Values outside an inclusive range; NULL passes."""

    def measures(df, where=None):
        value = value_of(df, column) if where is None else F.when(where, value_of(df, column))
        return {"outside": F.count_if(violates_range(value, low, high)), **range_samples(value, low, high)}

    def judge(total, found, _):
        n = found["outside"]
        text = F.format_string(f"Column '{column}' has %d values outside range [{low}, {high}]", n)
        samples = sample_text([found[k] for k in found if k.startswith("sample")])
        details = {"column": column, "expected_range": f"[{low}, {high}]", "sample_violations": samples}
        return [F.when(n > 0, issue("range_check", "warning", text, n, details))]

    return AggRule("range_check", measures, judge, {"columns": column, "range": f"[{low}, {high}]"}, measures)


def freshness(column: str, now: dt.datetime, max_age_hours: int = fixed.FRESHNESS_HOURS) -> AggRule:
    """Rows older than a number of hours at the run moment; unreadable moments are not judged."""

    def measures(df, where=None):
        kind = df.schema[column].dataType if column in df.columns else T.NullType()
        moment = C.to_moment(value_of(df, column), kind)
        return {"stale": _number(N.age_hours(moment, now) > max_age_hours, where)}

    def judge(total, found, _):
        n = found["stale"]
        text = F.format_string(f"%d records are older than {max_age_hours} hours", n)
        return [F.when(n > 0, issue("freshness_check", "warning", text, n))]

    return AggRule("freshness_check", measures, judge, {"columns": column}, measures)


def min_rows(least: int) -> AggRule:
    """Opt-in guard against an empty or tiny batch, which every other rule passes."""

    def judge(total, _, __):
        text = F.format_string(f"Batch has %d rows, fewer than {least}", total)
        return [F.when(total < least, issue("min_rows", "critical", text, total))]

    return AggRule("min_rows", lambda df: {}, judge, {"least": str(least)}, lambda df, where: {})


def constraint(name: str, column: str, holds: Callable[[Column], Column], what: str) -> AggRule:
    """A domain constraint on present values (enumeration, length, limits)."""

    def measures(df, where=None):
        value = value_of(df, column)
        return {"broken": _number(value.isNotNull() & F.coalesce(~holds(value), F.lit(False)), where)}

    def judge(total, found, _):
        n = found["broken"]
        text = F.format_string(f"Column '{column}' has %d values that break: {what}", n)
        return [F.when(n > 0, issue(name, "critical", text, n, {"column": column}))]

    return AggRule(name, measures, judge, {"columns": column, "constraint": what}, measures)


def not_null(column: str) -> AggRule:
    """NOT NULL constraint: any NULL is critical."""

    def measures(df, where=None):
        return {"nulls": _number(value_of(df, column).isNull(), where)}

    def judge(total, found, _):
        n = found["nulls"]
        text = F.format_string(f"Column '{column}' has %d nulls", n)
        return [F.when(n > 0, issue("not_null", "critical", text, n, {"column": column}))]

    return AggRule("not_null", measures, judge, {"columns": column, "constraint": "NOT NULL"}, measures)


def one_of(column: str, allowed: Sequence[str]) -> AggRule:
    return constraint(
        "enumeration", column, lambda c: c.isin(list(allowed)), "one of " + ", ".join(allowed)
    )


def max_length(column: str, length: int) -> AggRule:
    return constraint(
        "max_length", column, lambda c: F.length(c) <= length, f"at most {length} characters"
    )


def within(column: str, low: float, high: float) -> AggRule:
    return constraint("limits", column, lambda c: c.between(low, high), f"between {low} and {high}")


def fits_decimal(column: str, precision: int, scale: int) -> AggRule:
    decimal = f"decimal({precision},{scale})"
    return constraint(
        "precision", column, lambda c: c.try_cast(decimal).isNotNull(), f"fits {decimal}"
    )


def fits_whole(column: str) -> AggRule:
    return constraint("precision", column, lambda c: c.try_cast("bigint").isNotNull(), "fits a 64-bit whole number")


def serving_constraints(spec: TableSpec) -> list[AggRule]:
    """Column constraints of the serving table, as declared in the spec."""
    rules: list[AggRule] = []
    for f in spec.fields:
        if f.required:
            rules.append(not_null(f.name))
        if f.max_length:
            rules.append(max_length(f.name, f.max_length))
        if f.allowed:
            rules.append(one_of(f.name, f.allowed))
        if f.serving_range:
            rules.append(within(f.name, *f.serving_range))
        if f.precision:
            rules.append(fits_decimal(f.name, *f.precision))
        elif f.kind == WHOLE:
            rules.append(fits_whole(f.name))
    return rules


def duplicated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count; NULLs compare equal.

    Counting is combined before the shuffle, so a key that holds a third of all rows
    reaches its reducer as one row per task.
    """
    keyed = df.select(*[value_of(df, c).alias(c) for c in columns])
    return keyed.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def leading(df: DataFrame, order: Sequence[Column | str], most: int, flag: str = "_leads") -> DataFrame:
    """The rows with a mark on the first ``most`` of each task, so that one aggregation can count all
    rows and collect a bounded number of them."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the place within the task
    return df.sortWithinPartitions(*order).withColumn(flag, place < most)


def unique_check(columns: Sequence[str]) -> FrameRule:
    """Distinct duplicated keys of a compound key; any is critical.

    The keys are grouped once: their number and the first of them come from one aggregation.
    """
    shown = "[" + ", ".join(f"'{c}'" for c in columns) + "]"

    def issues(df):
        as_text = F.array_join(F.array(*[F.col(c).cast("string") for c in columns]), ", ", "null")
        sample = F.struct(F.struct(*columns).alias("_key"), F.concat(F.lit("["), as_text, F.lit("]")).alias("_shown"))
        counted = leading(duplicated_keys(df, columns), columns, fixed.SAMPLE_SIZE).agg(
            F.count(F.lit(1)).alias("n"), F.collect_list(F.when(F.col("_leads"), sample)).alias("_held")
        )
        first = F.slice(F.sort_array("_held"), 1, fixed.SAMPLE_SIZE)
        text = F.format_string(f"Compound key {shown} has %d duplicate value(s)", F.col("n"))
        details = {"columns": ",".join(columns), "sample_duplicates": F.array_join(F.transform(first, lambda k: k["_shown"]), ", ")}
        found = issue("unique_check", "critical", text, F.col("n"), details)
        return counted.filter("n > 0").select(found.alias("i")).select("i.*")

    return FrameRule("unique_check", issues, {"columns": ",".join(columns)})


def references(column: str, parents: DataFrame, parent_column: str) -> FrameRule:
    """Referential integrity: rows whose value is absent from the parent table."""

    def issues(df):
        # one row per distinct value, counted before the shuffle: no skew reaches the join
        held = (
            df.filter(F.col(column).isNotNull())
            .groupBy(column)
            .agg(F.count(F.lit(1)).alias("copies"))
        )
        known = parents.select(F.col(parent_column).alias(column)).distinct()
        lost = held.join(known, column, "left_anti").agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("n")
        )
        text = F.format_string(f"Column '{column}' has %d rows without a parent", F.col("n"))
        found = issue("references", "critical", text, F.col("n"), {"column": column})
        return lost.filter("n > 0").select(found.alias("i")).select("i.*")

    return FrameRule("references", issues, {"columns": column})


def violation_samples(
    df: DataFrame, violation: Column, key: Sequence[str], columns: Sequence[str], k: int = fixed.SAMPLE_SIZE
) -> DataFrame:
    """The k violating rows with the lowest keys: a per-task top-k, then a merge."""
    return df.filter(violation).select(*columns).orderBy(*key).limit(k)


def json_key_drift(df: DataFrame, json_column: str, expected: Sequence[str]) -> DataFrame:
    """Top-level JSON keys against an expected list: key, status, rows that hold it.

    Works on the raw text, because a reader with a schema hides missing and extra keys.
    """
    present = (
        df.select(F.explode(F.json_object_keys(json_column)).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    spark = df.sparkSession
    wanted = spark.range(1).select(
        F.explode(F.array(*[F.lit(k) for k in expected])).alias("key"), F.lit(True).alias("wanted")
    )
    joined = present.join(wanted, "key", "full_outer")
    status = (
        F.when(F.col("records").isNull(), "missing").when(F.col("wanted").isNull(), "extra").otherwise("expected")
    )
    return joined.select(
        "key", status.alias("status"), F.coalesce("records", F.lit(0)).cast("bigint").alias("records")
    )
