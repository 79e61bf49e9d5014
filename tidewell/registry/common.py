"""Views of the test tables in the roles the operators expect."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import numeric as N
from ..spec import MOMENT, NUMBER, TEXT, WHOLE, Field, TableSpec

RUN_TS = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
ZERO_TEXT = "2024-01-31 00:00:00.000000"

EVENTS = TableSpec(
    name="events",
    fields=(
        Field("event_id", WHOLE, required=True),
        Field("event_type", TEXT, required=True, max_length=20,
              allowed=("click", "error", "purchase", "signup", "view")),
        Field("user_id", WHOLE),
        Field("value", NUMBER, required=True, low=0, high=200, precision=(6, 2)),
        Field("k", WHOLE, low=10, high=95, serving_range=(0, 99)),
        Field("ts", MOMENT, required=True),
    ),
    key=("user_id", "ts"),
    entity="event_type",
    event_time="ts",
    updates=("value", "ingested_at"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(moment: Column) -> Column:
    """A moment as text with microseconds, the same in both engines."""
    return F.date_format(moment.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def big(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def real(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number held in their JSON text."""
    e = table(spark, sf_dir, "events")
    return e.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def moments(df: DataFrame, column: str = "ts") -> DataFrame:
    """Zone-free moments as UTC timestamps."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as untidy text, the way a landing file holds them.

    Names are padded or blank, numbers unreadable, absent or fractional, moments in three
    spellings: each defect depends on the row's own k.
    """
    e, k = events(spark, sf_dir), F.col("k")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(k < 3, F.lit(" \t ")).otherwise(F.concat(F.lit("  "), "event_type", F.lit("\n"))).alias("event_type"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(k == 50, F.lit("n/a")).when(k == 51, F.lit(None)).otherwise(F.col("value").cast("string")).alias("value"),
        F.when(k == 60, F.lit(None)).otherwise(F.concat(k.cast("string"), F.lit(".9"))).alias("k"),
        F.when(k == 70, F.lit("not-a-timestamp")).when(k.between(71, 80), seconds.cast("string")).otherwise(iso).alias("ts"),
    )


# SQL twin of raw_events after cleaning, without rejection
CLEAN_SQL = """
    SELECT event_id,
           CASE WHEN k < 3 THEN NULL ELSE event_type END AS event_type,
           user_id,
           CASE WHEN k IN (50, 51) THEN NULL ELSE value END AS value,
           CASE WHEN k = 60 THEN NULL ELSE k END AS k,
           CASE WHEN k = 70 THEN NULL WHEN k BETWEEN 71 AND 80 THEN date_trunc('second', ts) ELSE ts END AS ts
    FROM (SELECT event_id, event_type, user_id, value, ts, CAST(props->>'$.k' AS BIGINT) AS k FROM events) e
"""
REASON_SQL = f"""
    SELECT *, CASE
        WHEN event_type IS NULL THEN 'Missing required field ''event_type'''
        WHEN value IS NULL THEN 'Missing required field ''value'''
        WHEN ts IS NULL THEN 'Missing required field ''ts'''
        WHEN value < 0 OR value > 200 THEN 'value=' || CAST(value AS VARCHAR) || ' outside range [0, 200]'
        WHEN k < 10 OR k > 95 THEN 'k=' || CAST(k AS VARCHAR) || ' outside range [10, 95]'
    END AS reason
    FROM ({CLEAN_SQL}) c
"""
EVENTS_SQL = "(SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events)"


def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the role of gate rows: layer, moment, records, verdict."""
    li = table(spark, sf_dir, "lineitem")
    total = F.col("l_quantity").cast("bigint")
    passed = F.greatest(total - F.col("l_linenumber"), F.lit(0))
    return li.select(
        F.col("l_orderkey").alias("run_id"),
        F.col("l_returnflag").alias("layer"),
        F.col("l_shipdate").alias("evaluated_at"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_linestatus",
        total.alias("total_records"),
        passed.alias("passed_records"),
        N.pass_rate(passed, total).alias("pass_rate"),
        (F.col("l_discount") < 0.08).alias("gate_passed"),
    )


GATES_SQL = """(
    SELECT l_orderkey AS run_id, l_returnflag AS layer, l_shipdate AS evaluated_at,
           l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_linestatus,
           CAST(l_quantity AS BIGINT) AS total_records,
           greatest(CAST(l_quantity AS BIGINT) - l_linenumber, 0) AS passed_records,
           CASE WHEN l_quantity > 0
                THEN CAST(greatest(CAST(l_quantity AS BIGINT) - l_linenumber, 0) * 100 / CAST(l_quantity AS DOUBLE) AS DECIMAL(5,2))
                ELSE 0 END AS pass_rate,
           l_discount < 0.08 AS gate_passed
    FROM lineitem)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the role of run rows: state, start, duration, counts, messages."""
    o = table(spark, sf_dir, "orders")
    state = F.col("o_orderstatus")
    status = F.when(state == "F", "success").when(state == "O", "failed").otherwise("blocked")
    return o.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        "o_orderkey",
        status.alias("status"),
        F.col("o_orderdate").alias("started_at"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("duration_seconds"),
        F.col("o_custkey").alias("records_ingested"),
        F.floor(F.col("o_totalprice")).cast("bigint").alias("records_transformed"),
        F.length("o_orderpriority").cast("bigint").alias("records_loaded"),
        (status != "blocked").alias("quality_gate_passed"),
        F.when(status == "blocked", F.col("o_orderpriority")).otherwise("").alias("quality_gate_reason"),
        F.when(status == "failed", F.col("o_orderpriority")).otherwise("").alias("error_message"),
    )


RUNS_SQL = """(
    SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'blocked' END AS status,
           o_orderdate AS started_at, CAST(floor(o_totalprice / 1000) AS BIGINT) AS duration_seconds,
           o_custkey AS records_ingested, CAST(floor(o_totalprice) AS BIGINT) AS records_transformed,
           length(o_orderpriority) AS records_loaded, o_orderpriority AS note,
           o_orderstatus IN ('F', 'O') AS quality_gate_passed
    FROM orders)"""
