"""Queries: run reports, gate history, lineage, metric series, alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import gates as G, rules as R
from ..operators.merge import upsert
from ..plans import receipts as P, reports as V, views as W
from . import common as C

NOW = dt.datetime(2000, 6, 1)
# before the names of the temporary views of a query, so that none of the caller's is replaced
_VIEWS = "registered_"


def quality_trend(spark, sf_dir):
    return V.quality_trend(C.gates(spark, sf_dir), NOW, days=365)


def quality_summary(spark, sf_dir):
    return V.quality_summary(C.gates(spark, sf_dir))


def run_stats(spark, sf_dir):
    found = V.run_stats(C.runs(spark, sf_dir), tie_break=("o_orderkey",))
    return found.withColumn("last_run_at", C.micros(F.col("last_run_at")))


def recent_runs(spark, sf_dir):
    found = V.recent_runs(C.runs(spark, sf_dir), tie_break=("o_orderkey",))
    return found.withColumns(
        {"started_at": C.micros(F.col("started_at")), "error_message": F.nullif("error_message", F.lit(""))}
    )


def latest_gate(spark, sf_dir):
    ties = ("run_id", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    found = V.latest_gate_results(C.gates(spark, sf_dir), ties)
    return found.select(
        "layer", "run_id", C.micros(F.col("evaluated_at")).alias("evaluated_at"), "total_records",
        "passed_records", C.real("pass_rate").alias("pass_rate"), "gate_passed",
    )


def stored_runs(spark, sf_dir):
    runs = C.runs(spark, sf_dir).withColumn("duration_seconds", F.col("duration_seconds") + 0.75)
    return P.stored_runs(runs).select("run_id", "status", "duration_seconds", "quality_gate_reason", "error_message")


def lineage(spark, sf_dir):
    """Events of a day and type as the artifacts of that day's run."""
    e = C.table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd")
    artifacts = e.groupBy(day.alias("run_id"), F.col("event_type").alias("layer")).agg(
        F.count(F.lit(1)).alias("record_count")
    ).withColumn("key", F.concat("layer", F.lit("/"), "run_id"))
    nested = P.lineage(artifacts)
    return nested.select(
        "run_id", "artifact_count",
        F.array_join(
            F.transform("artifacts", lambda a: F.concat(a["key"], F.lit("="), a["record_count"].cast("string"))), ","
        ).alias("artifacts"),
    )


def metrics_long(spark, sf_dir):
    return P.stage_series(C.runs(spark, sf_dir))


def metrics_runs(spark, sf_dir):
    return P.runs_by_status(C.runs(spark, sf_dir))


def metrics_latest(spark, sf_dir):
    return P.latest_run_gauges(C.runs(spark, sf_dir), ("o_orderkey",))


def upsert_runs(spark, sf_dir):
    """Final run rows over the rows written when the runs began; the start stays."""
    columns = ("run_id", "status", "duration_seconds", "started_at")
    final = C.runs(spark, sf_dir).select(*columns)
    begun = final.filter("status <> 'blocked'").withColumns({"status": F.lit("running"), "duration_seconds": F.lit(0).cast("bigint")})
    later = final.withColumn("started_at", F.col("started_at") + F.expr("INTERVAL 1 DAY"))
    merged = upsert(begun, later, ["run_id"], ["status", "duration_seconds"])
    return merged.withColumn("started_at", C.micros(F.col("started_at")))


def sql_views(spark, sf_dir):
    """The views queried in SQL: newest runs, newest gate days, newest event per user."""
    gates = C.gates(spark, sf_dir)
    events = C.events(spark, sf_dir).withColumnRenamed("ts", "recorded_at")
    W.register(events, C.runs(spark, sf_dir), gates, "user_id", "recorded_at", ("event_id",), _VIEWS)
    return spark.sql(f"""
        SELECT 'latest' AS source, CAST(user_id AS STRING) AS name, CAST(event_id AS DOUBLE) AS value FROM {_VIEWS}{W.LATEST}
        UNION ALL SELECT 'summary', layer, CAST(count(*) AS DOUBLE) FROM {_VIEWS}{W.SUMMARY} GROUP BY layer
        UNION ALL SELECT 'recent', 'runs', CAST(count(*) AS DOUBLE) FROM {_VIEWS}{W.RECENT}
        UNION ALL SELECT 'gates', layer, CAST(max(total_records) AS DOUBLE) FROM {_VIEWS}{W.GATES} GROUP BY layer""")


def metrics_issues(spark, sf_dir):
    """Gate verdicts and issues by severity, from gates over three tables."""
    def gate(name, layer, rules, mode="block"):
        df = C.table(spark, sf_dir, name)
        return G.gate_rows(df, rules, gate_name=name, layer=layer, mode=mode, run_ts=C.RUN_TS)

    gates = gate("customer", "silver", [R.range_check("c_acctbal", 0, 9000), R.range_check("c_nationkey", 0, 20)]).unionByName(
        gate("lineitem", "gold", [R.unique_check(["l_orderkey", "l_linenumber"])])
    ).unionByName(gate("events", "bronze", [R.null_check(["event_type"])]))
    issues = P.issues_by_severity(gates).select("layer", F.col("severity").alias("label"), C.big("value").alias("value"))
    states = P.gates_by_status(gates).select("layer", F.col("status").alias("label"), "value")
    return issues.unionByName(states)


def alerts(spark, sf_dir):
    return P.alerts(C.runs(spark, sf_dir))


_RATE = "round_even(sum(CAST(pass_rate * 100 AS BIGINT)) / count(*), 0) / 100"
_CUSTOMER = "(SELECT count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 9000) AS a, count(*) FILTER (WHERE c_nationkey > 20) AS b FROM customer)"

ORACLES = {
    "quality_trend": f"""
        SELECT strftime(evaluated_at, '%Y-%m-%d') AS date, layer, {_RATE} AS avg_pass_rate,
               count(*) FILTER (WHERE gate_passed) AS gates_passed, count(*) FILTER (WHERE NOT gate_passed) AS gates_failed
        FROM {C.GATES_SQL} g WHERE evaluated_at >= TIMESTAMP '2000-06-01' - INTERVAL 365 DAY GROUP BY 1, 2""",
    "quality_summary": f"""
        SELECT strftime(evaluated_at, '%Y-%m-%d') AS date, layer, {_RATE} AS avg_pass_rate, count(*) AS total_runs,
               count(*) FILTER (WHERE gate_passed) AS gates_passed, count(*) FILTER (WHERE NOT gate_passed) AS gates_failed
        FROM {C.GATES_SQL} g GROUP BY 1, 2""",
    "run_stats": f"""
        WITH recent AS (SELECT * FROM {C.RUNS_SQL} r ORDER BY started_at DESC, o_orderkey DESC LIMIT 50)
        SELECT (SELECT strftime(max(started_at), '%Y-%m-%d %H:%M:%S.%f') FROM {C.RUNS_SQL} a) AS last_run_at,
               (SELECT count(*) FROM orders) AS total_runs, round_even(avg(duration_seconds) * 100, 0) / 100 AS avg_duration_seconds,
               round_even(count(*) FILTER (WHERE status = 'success') / count(*) * 100 * 100, 0) / 100 AS success_rate
        FROM recent""",
    "recent_runs": f"""
        SELECT run_id, status, strftime(started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at, duration_seconds, records_loaded,
               quality_gate_passed, CASE WHEN status = 'failed' THEN note END AS error_message
        FROM (SELECT * FROM {C.RUNS_SQL} x ORDER BY started_at DESC, o_orderkey DESC LIMIT 20) r""",
    "latest_gate": f"""
        SELECT layer, run_id, strftime(evaluated_at, '%Y-%m-%d %H:%M:%S.%f') AS evaluated_at, total_records, passed_records,
               CAST(pass_rate AS DOUBLE) AS pass_rate, gate_passed
        FROM {C.GATES_SQL} g QUALIFY row_number() OVER (PARTITION BY layer
            ORDER BY g.evaluated_at DESC, run_id DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    "stored_runs": f"""
        SELECT run_id, status, duration_seconds, CASE WHEN status = 'blocked' THEN note END AS quality_gate_reason,
               CASE WHEN status = 'failed' THEN note END AS error_message FROM {C.RUNS_SQL} r""",
    "lineage": """
        WITH a AS (SELECT strftime(ts, '%Y%m%d') AS run_id, event_type || '/' || strftime(ts, '%Y%m%d') AS key, count(*) AS n
                   FROM events GROUP BY 1, 2)
        SELECT run_id, count(*) AS artifact_count, string_agg(key || '=' || n, ',' ORDER BY key) AS artifacts
        FROM a GROUP BY run_id""",
    "metrics_long": f"""
        SELECT run_id, 'ingested' AS stage, records_ingested AS value FROM {C.RUNS_SQL} a
        UNION ALL SELECT run_id, 'transformed', records_transformed FROM {C.RUNS_SQL} b
        UNION ALL SELECT run_id, 'loaded', records_loaded FROM {C.RUNS_SQL} c""",
    "metrics_runs": f"SELECT status, count(*) AS value FROM {C.RUNS_SQL} r GROUP BY status",
    "metrics_latest": f"""
        WITH r AS (SELECT * FROM {C.RUNS_SQL} x ORDER BY started_at DESC, o_orderkey DESC LIMIT 1)
        SELECT run_id, 'duration_seconds' AS gauge, CAST(duration_seconds AS DOUBLE) AS value FROM r
        UNION ALL SELECT run_id, 'last_run_timestamp_seconds', epoch(started_at) FROM r
        UNION ALL SELECT run_id, 'ingested', records_ingested FROM r
        UNION ALL SELECT run_id, 'transformed', records_transformed FROM r
        UNION ALL SELECT run_id, 'loaded', records_loaded FROM r""",
    "upsert_runs": f"""
        SELECT run_id, status, duration_seconds, strftime(CASE WHEN status = 'blocked' THEN started_at + INTERVAL 1 DAY
               ELSE started_at END, '%Y-%m-%d %H:%M:%S.%f') AS started_at FROM {C.RUNS_SQL} r""",
    "sql_views": f"""
        SELECT 'latest' AS source, CAST(user_id AS VARCHAR) AS name, CAST(arg_max(event_id, (ts, event_id)) AS DOUBLE) AS value
        FROM events GROUP BY user_id
        UNION ALL SELECT 'summary', l_returnflag, count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem GROUP BY 2
        UNION ALL SELECT 'recent', 'runs', least(count(*), 50) FROM orders
        UNION ALL SELECT 'gates', l_returnflag, max(floor(l_quantity)) FROM lineitem GROUP BY 2""",
    "metrics_issues": f"""
        SELECT layer, label, CAST(value AS BIGINT) AS value FROM (
            SELECT 'silver' AS layer, 'warning' AS label, CAST(a > 0 AS INT) + CAST(b > 0 AS INT) AS value FROM {_CUSTOMER} c
            UNION ALL VALUES ('silver', 'info', 0), ('silver', 'critical', 0), ('gold', 'info', 0), ('gold', 'warning', 0),
                ('bronze', 'info', 0), ('bronze', 'warning', 0), ('bronze', 'critical', 0), ('bronze', 'passed', 1)
            UNION ALL SELECT 'gold', 'critical', count(*) FROM (SELECT 1 FROM
                (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) y LIMIT 1) x
            UNION ALL SELECT 'gold', 'blocked', 1
            UNION ALL SELECT 'silver', 'blocked', CAST(a + b > 0 AS INT) FROM {_CUSTOMER} c) z""",
    "alerts": f"""
        SELECT run_id, status, CASE status WHEN 'blocked' THEN '🛑' ELSE '❌' END || ' *Pipeline ' || upper(status) || '* — run `'
               || run_id || '`' || chr(10) || note || chr(10) || '_ingested=' || records_ingested || ', transformed='
               || records_transformed || ', loaded=' || records_loaded || '_' AS text
        FROM {C.RUNS_SQL} r WHERE status IN ('failed', 'blocked')""",
}
QUERIES = {name: globals()[name] for name in ORACLES}
