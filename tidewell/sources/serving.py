"""Serving table: projection, load checks, keyed upsert into day partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import numeric as N
from ..operators import rules as R
from ..operators.gates import BLOCK, Gate, GateBlocked
from ..operators.merge import upsert
from ..operators.observed import write_observed
from ..spec import MOMENT, NUMBER, WEATHER, WHOLE, TableSpec
from .workspace import read_or_empty

DAY = "recorded_on"
SERVED_TIME = "recorded_at"
LISTED_DAYS = 1_000


def serving_columns(spec: TableSpec = WEATHER) -> list[str]:
    names = [SERVED_TIME if f.name == spec.event_time else f.name for f in spec.fields]
    return names + ["ingested_at"]


def serving_key(spec: TableSpec = WEATHER) -> list[str]:
    return [SERVED_TIME if k == spec.event_time else k for k in spec.key]


def serving_ddl(spec: TableSpec = WEATHER) -> str:
    kinds = []
    for f in spec.fields:
        name = SERVED_TIME if f.name == spec.event_time else f.name
        if f.kind == NUMBER and f.precision:
            kind = "decimal({},{})".format(*f.precision)
        else:
            kind = {WHOLE: "bigint", MOMENT: "timestamp", NUMBER: "double"}.get(f.kind, "string")
        kinds.append(f"`{name}` {kind}")
    return ", ".join(["id string", *kinds, "ingested_at timestamp"])


def serving_rows(df: DataFrame, run_ts: dt.datetime, spec: TableSpec = WEATHER) -> DataFrame:
    """Projection to serving columns and types; one ``ingested_at`` for the whole batch.

    The event time may already carry its serving name.
    """
    columns = []
    for f in spec.fields:
        if f.name == spec.event_time:
            present = [F.col(c) for c in (f.name, SERVED_TIME) if c in df.columns]
            columns.append(F.coalesce(*present).cast("timestamp").alias(SERVED_TIME))
        elif f.kind == NUMBER and f.precision:
            columns.append(F.col(f.name).try_cast("decimal({},{})".format(*f.precision)).alias(f.name))
        elif f.kind == WHOLE:
            columns.append(F.col(f.name).try_cast("bigint").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns, N.as_moment(run_ts).alias("ingested_at"))


def load_gate(spec: TableSpec = WEATHER, run_id: str = "", unique: bool = False) -> Gate:
    """Constraints of the serving table, checked on the batch before it is loaded; ``unique``
    states that the key has been checked already."""
    key = [] if unique else [R.unique_check(spec.key)]
    return Gate("serving_constraints", BLOCK, run_id, [*R.serving_constraints(spec), *key])


def load(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    staging: str,
    run_ts: dt.datetime,
    spec: TableSpec = WEATHER,
    run_id: str = "",
    unique: bool = False,
) -> int:
    """Insert or update a batch in the serving table; returns the accepted rows.

    The table is partitioned by the UTC date of the observation time. That time is part of
    the key, so a row can only meet its older version in its own day: only the days of the
    batch are read, merged and rewritten, once. Spark writes them beside the table and lets them take
    the place of the old days when all tasks are done, so a job that fails leaves the old rows; the
    staged batch stays for another attempt.
    """
    gate = load_gate(spec, run_id, unique)
    # The batch is evaluated once: staged with its surrogate ids while its constraints are observed.
    names, key = ["id", *serving_columns(spec)], serving_key(spec)
    held = serving_rows(df, run_ts, spec).withColumn("id", F.expr("uuid()")).select(*names)

    def stage(observed: DataFrame) -> DataFrame:
        rows = serving_rows(observed, run_ts, spec).withColumn("id", F.expr("uuid()")).select(*names)
        rows.write.mode("overwrite").parquet(f"{staging}/batch")
        return spark.read.schema(held.schema).parquet(f"{staging}/batch")

    delta, seen, accepted = write_observed(df, gate.rules, stage)
    judged = delta.withColumnRenamed(SERVED_TIME, spec.event_time) if seen is not None else df
    verdict = gate.evaluate(judged, "serving", run_ts, seen)
    if verdict.blocked:
        raise GateBlocked(verdict)
    if not accepted:
        return 0
    dated = delta.withColumn(DAY, F.to_date(SERVED_TIME))
    base = read_served(spark, path, spec)
    touched = within_days_of(base, dated).select(*names)
    merged = upsert(touched, delta, key, _updates(spec, names, key))
    (
        merged.withColumn(DAY, F.to_date(SERVED_TIME))
        .hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )
    return accepted


def touched_days(spark: SparkSession, staging: str) -> DataFrame:
    """The days that a load has rewritten: those of the batch it staged."""
    batch = spark.read.schema(f"{SERVED_TIME} timestamp").parquet(f"{staging}/batch")
    return batch.select(F.to_date(SERVED_TIME).alias("day")).distinct()


def within_days_of(base: DataFrame, dated: DataFrame) -> DataFrame:
    """Rows of the table in the days of a batch. The days are literals in the filter, so only
    their folders are scanned; a batch of very many days is bounded by its first and last."""
    days = dated.select(DAY).distinct()
    listed = sorted(r[DAY] for r in days.limit(LISTED_DAYS + 1).collect() if r[DAY] is not None)
    if len(listed) <= LISTED_DAYS:
        return base.filter(F.col(DAY).isin(listed) if listed else F.lit(False))
    ends = days.agg(F.min(DAY).alias("first"), F.max(DAY).alias("last")).collect()[0]
    bounded = base.filter(F.col(DAY).between(F.lit(ends["first"]), F.lit(ends["last"])))
    # one date per touched day; the calendar of years 1 to 9999 has 3.7 million of them
    return bounded.join(F.broadcast(days), DAY, "left_semi")


def _updates(spec: TableSpec, names: list[str], key: list[str]) -> list[str]:
    """Columns a known key takes from the batch; its surrogate id always stays."""
    if spec.updates is not None:
        return list(spec.updates)
    return [n for n in names if n not in key and n != "id"]


def read_served(spark: SparkSession, path: str, spec: TableSpec = WEATHER) -> DataFrame:
    """The serving table; empty before the first load."""
    return read_or_empty(spark, path, f"{serving_ddl(spec)}, {DAY} date")
