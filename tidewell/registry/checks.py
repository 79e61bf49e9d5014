"""Queries: dataset checks, gates, constraints, rule catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as K, gates as G, rules as R
from ..operators.keyed_join import attach
from ..operators.observed import write_observed
from ..plans import layers as L
from ..sources.workspace import scratch
from . import common as C

_ISSUE = ("rule_name", "severity", "message", "affected_records")


def _issues(df, rules):
    return G.measured(df, rules).select(F.explode("issues").alias("i")).select(*[f"i.{c}" for c in _ISSUE])


def _labelled(spark, sf_dir):
    documents = C.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return attach(documents, C.table(spark, sf_dir, "labels"), ["doc_id"])


def gate_null(spark, sf_dir):
    return _issues(_labelled(spark, sf_dir), [R.null_check(["doc_id", "lang", "quality", "toxic"])])


def gate_range(spark, sf_dir):
    return _issues(C.table(spark, sf_dir, "customer"), [R.range_check("c_acctbal", 0, 9000)])


def gate_unique_fail(spark, sf_dir):
    return _issues(C.table(spark, sf_dir, "lineitem"), [R.unique_check(["l_orderkey", "l_linenumber"])])


def gate_unique_pass(spark, sf_dir):
    return _issues(C.table(spark, sf_dir, "events"), [R.unique_check(["user_id", "ts"])])


def gate_freshness(spark, sf_dir):
    return _issues(C.moments(C.table(spark, sf_dir, "events")), [R.freshness("ts", C.RUN_TS)])


def gate_schema_drift(spark, sf_dir):
    return R.json_key_drift(C.table(spark, sf_dir, "events"), "props", ["k", "unit"])


def _gates(spark, sf_dir, observe=False):
    """Four gates of different tables, verdicts and modes; evaluated on the tables, or observed while they are written."""

    def gate(df, rules, name, layer, mode):
        seen = None
        if observe:
            path = scratch(spark, f"observed-{name}")

            def write(given):
                given.write.parquet(path)
                return spark.read.schema(df.schema).parquet(path)

            df, seen, _ = write_observed(df, rules, write)
        return G.gate_rows(df, rules, gate_name=name, layer=layer, mode=mode, run_id=f"run-{name}", run_ts=C.RUN_TS, seen=seen)

    customer = C.table(spark, sf_dir, "customer")
    ranges = [R.range_check("c_acctbal", 0, 9000), R.range_check("c_nationkey", 0, 20), R.null_check(["c_name"])]
    found = gate(customer, ranges, "customer_block", "silver", "block")
    rest = [
        gate(customer, ranges, "customer_warn", "silver", "warn"),
        gate(_labelled(spark, sf_dir), [R.null_check(["quality"]), R.schema_drift(["doc_id", "lang", "source", "quality"])], "labels", "bronze", "warn"),
        gate(C.table(spark, sf_dir, "lineitem"), [R.unique_check(["l_orderkey", "l_linenumber"])], "lineitem", "gold", "warn"),
        gate(C.table(spark, sf_dir, "events"), [R.unique_check(["user_id", "ts"]), R.null_check(["event_type"])], "events", "gold", "block"),
    ]
    for more in rest:
        found = found.unionByName(more)
    return found


def gate_status(spark, sf_dir):
    metrics = [C.big(f"metrics.{m}").alias(m) for m in
               ("total_records", "rules_evaluated", "issues_found", "critical_issues", "warning_issues")]
    first = F.try_element_at(F.transform("issues", lambda i: i["rule_name"]), F.lit(1))
    return _gates(spark, sf_dir).select("gate_name", "run_id", "status", "layer", *metrics, first.alias("first_rule"))


def _metrics(gates):
    rows = G.metric_rows(gates)
    counts = ("total_records", "passed_records", "failed_records", "expectations_evaluated", "expectations_passed")
    return rows.select(
        "run_id", "layer", *[C.big(c).alias(c) for c in counts], C.real("pass_rate").alias("pass_rate"),
        "expectation_suite", "gate_passed", "failure_reason", C.micros(F.col("evaluated_at")).alias("evaluated_at"),
    )


def gate_metrics_row(spark, sf_dir):
    return _metrics(_gates(spark, sf_dir))


def gate_observed(spark, sf_dir):
    """The same metric rows from measures observed while each table was written."""
    return _metrics(_gates(spark, sf_dir, observe=True))


def constraint_rules(spark, sf_dir):
    customer = C.table(spark, sf_dir, "customer")
    lineitem = C.table(spark, sf_dir, "lineitem")
    nation = C.table(spark, sf_dir, "nation").filter("n_regionkey < 3")
    on_customer = [
        R.one_of("c_mktsegment", ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]),
        R.max_length("c_mktsegment", 8),
        R.within("c_acctbal", 0, 9000),
        R.fits_decimal("c_acctbal", 5, 2),
        R.not_null("c_name"),
        R.references("c_nationkey", nation, "n_nationkey"),
    ]
    found = _issues(customer, on_customer).unionByName(
        _issues(lineitem, [R.unique_check(["l_orderkey", "l_linenumber"]), R.within("l_discount", 0, 0.09)])
    )
    return found.select("rule_name", "severity", "affected_records")


def layer_rules(spark, sf_dir):
    """The rules wired to each layer and two user-defined ones, with what they find."""
    raw = C.raw_events(spark, sf_dir)
    cleaned = K.clean(raw, C.EVENTS, C.RUN_TS)
    large = R.AggRule(
        "large_values",
        lambda df: {"n": F.count_if(F.col("value") > 300)},
        lambda total, m, df: [F.when(m["n"] > 0, R.issue("large_values", "info", "large", m["n"]))],
    )

    def busy(df):
        users = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("held")).filter("held > 60")
        found = users.agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
        return found.select(R.issue("busy_users", "info", "busy", F.col("n")).alias("i")).select("i.*")

    own = [large, R.FrameRule("busy_users", busy)]
    found = None
    for layer, df, more in (("bronze", raw, []), ("silver", cleaned, []), ("gold", cleaned, own)):
        issues = _issues(df, [*L.layer_rules(layer, C.EVENTS), *more]).withColumn("layer", F.lit(layer))
        found = issues if found is None else found.unionByName(issues)
    counted = found.groupBy("layer", "rule_name").agg(
        F.sum("affected_records").alias("affected"), F.count(F.lit(1)).alias("issues")
    )
    wired = L.rule_catalogue(spark, C.EVENTS).filter("layer is not null")
    known = wired.groupBy("layer", "rule_name").agg(F.count(F.lit(1)).alias("rules"))
    zero = F.lit(0)
    return known.join(counted, ["layer", "rule_name"], "full_outer").select(
        "layer", "rule_name",
        *[C.big(F.coalesce(c, zero)).alias(c) for c in ("rules", "issues", "affected")],
    )


def gate_range_samples(spark, sf_dir):
    """The samples that a range check shows: ends and nearest misses."""
    found = G.measured(C.table(spark, sf_dir, "customer"), [R.range_check("c_acctbal", 0, 9000)]).select(F.inline("issues"))
    return found.select("rule_name", F.col("details")["sample_violations"].alias("samples"))


def gate_unique_samples(spark, sf_dir):
    """The first keys that a uniqueness check finds held twice."""
    found = G.measured(C.table(spark, sf_dir, "lineitem"), [R.unique_check(["l_suppkey", "l_linenumber"])]).select(F.inline("issues"))
    return found.select("rule_name", "affected_records", F.col("details")["sample_duplicates"].alias("samples"))


def gate_freshness_text(spark, sf_dir):
    """Freshness of moments still held as text, some of them unreadable."""
    raw = C.raw_events(spark, sf_dir)
    return _issues(raw, [R.freshness("ts", C.RUN_TS, 24 * 14)]).select("rule_name", "severity", "affected_records")


def violation_samples(spark, sf_dir):
    customer = C.table(spark, sf_dir, "customer")
    return R.violation_samples(
        customer, R.violates_range(F.col("c_acctbal"), 0, 9000), ["c_custkey"], ["c_custkey", "c_acctbal"]
    )


_RANGES = """
    SELECT count(*) AS n, count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 9000) AS bal,
           count(*) FILTER (WHERE c_nationkey < 0 OR c_nationkey > 20) AS nat FROM customer"""
_BAL = "'Column ''c_acctbal'' has ' || bal || ' values outside range [0, 9000]'"
_NAT = "'Column ''c_nationkey'' has ' || nat || ' values outside range [0, 20]'"
_LABELS = """
    SELECT count(*) AS n, count(*) FILTER (WHERE quality IS NULL) AS q, count(*) FILTER (WHERE toxic IS NULL) AS t
    FROM documents LEFT JOIN labels USING (doc_id)"""
_DUPLICATES = """
    SELECT count(*) AS d, (SELECT count(*) FROM lineitem) AS n FROM
        (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) x"""
_NULL_TEXT = "'Column ''{c}'' has ' || {v} || ' null values (' || format('{{:.1f}}', {v} * 100.0 / n) || '%)'"
_Q_TEXT = _NULL_TEXT.format(c="quality", v="q")

ORACLES = {
    "gate_null": f"""
        SELECT 'null_check' AS rule_name, CASE WHEN v * 100.0 / n > 10 THEN 'critical' ELSE 'warning' END AS severity,
               'Column ''' || c || ''' has ' || v || ' null values (' || format('{{:.1f}}', v * 100.0 / n) || '%)' AS message,
               v AS affected_records
        FROM (SELECT 'quality' AS c, q AS v, n FROM ({_LABELS}) a UNION ALL SELECT 'toxic', t, n FROM ({_LABELS}) b) z
        WHERE v > 0""",
    "gate_range": f"""
        SELECT 'range_check' AS rule_name, 'warning' AS severity, {_BAL} AS message, bal AS affected_records
        FROM ({_RANGES}) r WHERE bal > 0""",
    "gate_unique_fail": f"""
        SELECT 'unique_check' AS rule_name, 'critical' AS severity,
               'Compound key [''l_orderkey'', ''l_linenumber''] has ' || d || ' duplicate value(s)' AS message,
               d AS affected_records FROM ({_DUPLICATES}) r WHERE d > 0""",
    "gate_unique_pass": """
        SELECT 'unique_check' AS rule_name, 'critical' AS severity, '' AS message, count(*) AS affected_records
        FROM (SELECT 1 FROM events GROUP BY user_id, ts HAVING count(*) > 1) x HAVING count(*) > 0""",
    "gate_freshness": """
        SELECT 'freshness_check' AS rule_name, 'warning' AS severity,
               n || ' records are older than 24 hours' AS message, n AS affected_records
        FROM (SELECT count(*) AS n FROM events WHERE TIMESTAMP '2024-01-31' - ts > INTERVAL 24 HOUR) x WHERE n > 0""",
    "gate_schema_drift": """
        WITH keys AS (SELECT unnest(json_keys(props)) AS key FROM events),
             present AS (SELECT key, count(*) AS records FROM keys GROUP BY key),
             wanted AS (SELECT unnest(['k', 'unit']) AS key)
        SELECT coalesce(p.key, w.key) AS key,
               CASE WHEN p.key IS NULL THEN 'missing' WHEN w.key IS NULL THEN 'extra' ELSE 'expected' END AS status,
               coalesce(records, 0) AS records
        FROM present p FULL JOIN wanted w ON p.key = w.key""",
    "gate_status": f"""
        SELECT 'customer_block' AS gate_name, 'run-customer_block' AS run_id, 'blocked' AS status, 'silver' AS layer,
               n AS total_records, CAST(3 AS BIGINT) AS rules_evaluated, CAST(2 AS BIGINT) AS issues_found,
               CAST(0 AS BIGINT) AS critical_issues, CAST(2 AS BIGINT) AS warning_issues, 'range_check' AS first_rule
        FROM ({_RANGES}) a WHERE bal > 0 AND nat > 0
        UNION ALL SELECT 'customer_warn', 'run-customer_warn', 'warned', 'silver', n, 3, 2, 0, 2, 'range_check' FROM ({_RANGES}) b
        UNION ALL SELECT 'labels', 'run-labels', 'blocked', 'bronze', n, 2, 2, 1, 1, 'null_check' FROM ({_LABELS}) c WHERE q * 10 > n
        UNION ALL SELECT 'lineitem', 'run-lineitem', 'blocked', 'gold', n, 1, 1, 1, 0, 'unique_check' FROM ({_DUPLICATES}) d WHERE d > 0
        UNION ALL SELECT 'events', 'run-events', 'passed', 'gold', count(*), 2, 0, 0, 0, NULL FROM events""",
    "gate_metrics_row": f"""
        SELECT run_id, layer, total_records, greatest(total_records - failed, 0) AS passed_records,
               CAST(failed AS BIGINT) AS failed_records, CAST(evaluated AS BIGINT) AS expectations_evaluated,
               CAST(ok_rules AS BIGINT) AS expectations_passed,
               CAST(CAST(greatest(total_records - failed, 0) * 100.0 / total_records AS DECIMAL(5,2)) AS DOUBLE) AS pass_rate,
               suite AS expectation_suite, passed AS gate_passed, CASE WHEN NOT passed THEN reason END AS failure_reason,
               '{C.ZERO_TEXT}' AS evaluated_at
        FROM (
            SELECT 'run-customer_block' AS run_id, 'silver' AS layer, n AS total_records, bal + nat AS failed, 3 AS evaluated,
                   2 AS ok_rules, 'customer_block' AS suite, false AS passed,
                   'range_check: ' || {_BAL} || '; range_check: ' || {_NAT} AS reason FROM ({_RANGES}) a
            UNION ALL SELECT 'run-customer_warn', 'silver', n, bal + nat, 3, 2, 'customer_warn', true, NULL FROM ({_RANGES}) b
            UNION ALL SELECT 'run-labels', 'bronze', n, q, 2, 0, 'labels', false,
                   'null_check: ' || {_Q_TEXT} || '; schema_drift: Unexpected columns found: {{''toxic''}}' FROM ({_LABELS}) c
            UNION ALL SELECT 'run-lineitem', 'gold', n, d, 1, 0, 'lineitem', false,
                   'unique_check: Compound key [''l_orderkey'', ''l_linenumber''] has ' || d || ' duplicate value(s)' FROM ({_DUPLICATES}) d
            UNION ALL SELECT 'run-events', 'gold', count(*), 0, 2, 2, 'events', true, NULL FROM events) z""",
    "constraint_rules": f"""
        SELECT * FROM (
            SELECT 'enumeration' AS rule_name, 'critical' AS severity, count(*) AS affected_records FROM customer
            WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')
            UNION ALL SELECT 'max_length', 'critical', count(*) FROM customer WHERE length(c_mktsegment) > 8
            UNION ALL SELECT 'limits', 'critical', count(*) FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000
            UNION ALL SELECT 'precision', 'critical', count(*) FROM customer WHERE abs(c_acctbal) >= 999.995
            UNION ALL SELECT 'references', 'critical', count(*) FROM customer
                WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)
            UNION ALL SELECT 'unique_check', 'critical', d FROM ({_DUPLICATES}) d
            UNION ALL SELECT 'limits', 'critical', count(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.09) z
        WHERE affected_records > 0""",
    "layer_rules": f"""
        WITH c AS ({C.CLEAN_SQL}),
        wired(layer, rule_name, rules) AS (VALUES
            ('bronze', 'schema_drift', 1), ('bronze', 'null_check', 1), ('silver', 'schema_drift', 1),
            ('silver', 'null_check', 1), ('silver', 'range_check', 2), ('gold', 'null_check', 1),
            ('gold', 'unique_check', 1), ('gold', 'large_values', 0), ('gold', 'busy_users', 0)),
        found AS (
            SELECT 'silver' AS layer, 'null_check' AS rule_name, count(*) FILTER (WHERE event_type IS NULL) AS n FROM c
            UNION ALL SELECT 'silver', 'null_check', count(*) FILTER (WHERE value IS NULL) FROM c
            UNION ALL SELECT 'silver', 'range_check', count(*) FILTER (WHERE value < 0 OR value > 200) FROM c
            UNION ALL SELECT 'silver', 'range_check', count(*) FILTER (WHERE k < 10 OR k > 95) FROM c
            UNION ALL SELECT 'gold', 'null_check', count(*) FILTER (WHERE event_type IS NULL) FROM c
            UNION ALL SELECT 'gold', 'null_check', count(*) FILTER (WHERE value IS NULL) FROM c
            UNION ALL SELECT 'gold', 'null_check', count(*) FILTER (WHERE ts IS NULL) FROM c
            UNION ALL SELECT 'gold', 'unique_check', count(*) FROM
                (SELECT 1 FROM c GROUP BY user_id, ts HAVING count(*) > 1) x
            UNION ALL SELECT 'gold', 'large_values', count(*) FILTER (WHERE value > 300) FROM c
            UNION ALL SELECT 'gold', 'busy_users', count(*) FROM
                (SELECT 1 FROM c GROUP BY user_id HAVING count(*) > 60) y)
        SELECT layer, rule_name, CAST(max(rules) AS BIGINT) AS rules, count(*) FILTER (WHERE n > 0) AS issues,
               CAST(coalesce(sum(n), 0) AS BIGINT) AS affected
        FROM wired LEFT JOIN found USING (layer, rule_name) GROUP BY layer, rule_name""",
    "gate_range_samples": """
        SELECT 'range_check' AS rule_name, '[' || array_to_string(list_sort(list_distinct(list_filter([
            min(c_acctbal) FILTER (WHERE c_acctbal < 0), max(c_acctbal) FILTER (WHERE c_acctbal < 0),
            min(c_acctbal) FILTER (WHERE c_acctbal > 9000), max(c_acctbal) FILTER (WHERE c_acctbal > 9000)],
            lambda v: v IS NOT NULL))), ', ') || ']' AS samples
        FROM customer HAVING count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 9000) > 0""",
    "gate_unique_samples": """
        WITH d AS (SELECT l_suppkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1),
        top AS (SELECT * FROM d ORDER BY l_suppkey, l_linenumber LIMIT 5)
        SELECT 'unique_check' AS rule_name, (SELECT count(*) FROM d) AS affected_records,
            string_agg('[' || l_suppkey || ', ' || l_linenumber || ']', ', ' ORDER BY l_suppkey, l_linenumber) AS samples
        FROM top""",
    "gate_freshness_text": f"""
        SELECT 'freshness_check' AS rule_name, 'warning' AS severity, count(*) AS affected_records
        FROM ({C.CLEAN_SQL}) c WHERE ts < TIMESTAMP '2024-01-31' - INTERVAL 14 DAY HAVING count(*) > 0""",
    "violation_samples": """
        SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000 ORDER BY c_custkey LIMIT 5""",
}
ORACLES["gate_observed"] = ORACLES["gate_metrics_row"]
QUERIES = {name: globals()[name] for name in ORACLES}
