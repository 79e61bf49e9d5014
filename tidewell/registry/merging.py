"""Queries: upserts, referential maintenance, joins to a parent table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keyed_join as J, merge as M
from ..plans import reports as P
from . import common as C

# the base holds the orders up to the second date; the delta redelivers from the first on
FIRST, SECOND = "1997-01-01", "1999-01-01"


def _orders(spark, sf_dir):
    return C.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate")


def _sides(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    base = orders.filter(F.col("o_orderdate") < F.lit(SECOND).cast("timestamp_ntz"))
    delta = orders.filter(F.col("o_orderdate") >= F.lit(FIRST).cast("timestamp_ntz")).withColumns(
        {"o_totalprice": F.col("o_totalprice") * 2, "o_orderstatus": F.lit("R")}
    )
    return base, delta


def upsert_partial(spark, sf_dir):
    merged = M.upsert(*_sides(spark, sf_dir), ["o_orderkey"], ["o_totalprice"])
    return merged.withColumn("o_orderdate", C.micros(F.col("o_orderdate")))


def upsert_whole(spark, sf_dir):
    merged = M.upsert(*_sides(spark, sf_dir), ["o_orderkey"])
    return merged.withColumn("o_orderdate", C.micros(F.col("o_orderdate")))


def _big_customers(spark, sf_dir):
    return C.table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))


def _children(spark, sf_dir):
    return C.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


def orphans(spark, sf_dir):
    return J.orphans(_children(spark, sf_dir), _big_customers(spark, sf_dir), ["o_custkey"])


def survivors(spark, sf_dir):
    return J.survivors(_children(spark, sf_dir), _big_customers(spark, sf_dir), ["o_custkey"], small=False)


def cascade_delete(spark, sf_dir):
    return J.cascade(_children(spark, sf_dir), _big_customers(spark, sf_dir), ["o_custkey"])


def run_gate_join(spark, sf_dir):
    """Gate rows with the state of their run, whatever share of them one run holds."""
    gates = C.gates(spark, sf_dir).withColumn("run_id", F.col("run_id").cast("string"))
    runs = C.runs(spark, sf_dir).select("run_id", "status", "duration_seconds")
    joined = P.gates_of_runs(gates, runs, small=False)
    return joined.select(
        "run_id", "layer", "l_linenumber", "l_partkey", "status", "duration_seconds", "gate_passed",
        C.real("pass_rate").alias("pass_rate"),
    )


def run_gate_counts(spark, sf_dir):
    gates = C.gates(spark, sf_dir).withColumn("run_id", F.col("run_id").cast("string"))
    runs = C.runs(spark, sf_dir).select("run_id", "status")
    joined = P.gates_of_runs(gates, runs)
    return joined.groupBy("status", "layer").agg(
        F.count(F.lit(1)).alias("gates"), F.count_if(~F.col("gate_passed")).alias("failed")
    )


_BASE = f"SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{SECOND}'"
_DELTA = f"SELECT * REPLACE (o_totalprice * 2 AS o_totalprice, 'R' AS o_orderstatus) FROM orders WHERE o_orderdate >= TIMESTAMP '{FIRST}'"
_DATE = "strftime(coalesce(b.o_orderdate, d.o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate"
_CHILD = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
_BIG = "SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_custkey = o_custkey"

ORACLES = {
    "upsert_partial": f"""
        SELECT o_orderkey, coalesce(d.o_totalprice, b.o_totalprice) AS o_totalprice,
               coalesce(b.o_orderstatus, d.o_orderstatus) AS o_orderstatus,
               coalesce(b.o_orderpriority, d.o_orderpriority) AS o_orderpriority, {_DATE}
        FROM ({_BASE}) b FULL JOIN ({_DELTA}) d USING (o_orderkey)""",
    "upsert_whole": f"""
        SELECT o_orderkey, coalesce(d.o_totalprice, b.o_totalprice) AS o_totalprice,
               coalesce(d.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
               coalesce(d.o_orderpriority, b.o_orderpriority) AS o_orderpriority, {_DATE}
        FROM ({_BASE}) b FULL JOIN ({_DELTA}) d USING (o_orderkey)""",
    "orphans": f"{_CHILD} WHERE NOT EXISTS ({_BIG})",
    "survivors": f"{_CHILD} WHERE EXISTS ({_BIG})",
    "cascade_delete": f"{_CHILD} WHERE NOT EXISTS ({_BIG})",
    "run_gate_join": f"""
        SELECT r.run_id, layer, l_linenumber, l_partkey, status, duration_seconds, gate_passed,
               CAST(pass_rate AS DOUBLE) AS pass_rate
        FROM {C.GATES_SQL} g JOIN {C.RUNS_SQL} r ON CAST(g.run_id AS VARCHAR) = r.run_id""",
    "run_gate_counts": f"""
        SELECT status, layer, count(*) AS gates, count(*) FILTER (WHERE NOT gate_passed) AS failed
        FROM {C.GATES_SQL} g JOIN {C.RUNS_SQL} r ON CAST(g.run_id AS VARCHAR) = r.run_id GROUP BY 1, 2""",
}
QUERIES = {name: globals()[name] for name in ORACLES}
