"""Rules, gates and their metric rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from samples import RUN_TS, rows
from tidewell.operators import cleaning as K, gates as G, rules as R
from tidewell.plans import layers as L
from tidewell.spec import WEATHER


@pytest.fixture
def cities(spark):
    def build(*values, ddl="city string, t double"):
        return spark.createDataFrame(list(values), ddl)

    return build


def issues(df, *rules, mode="block"):
    return G.Gate("g", mode, "r", list(rules)).evaluate(df, "silver", RUN_TS).issues


def test_schema_drift(cities):
    df = cities(("a", 1.0))
    missing = issues(df, R.schema_drift(["city", "t", "x"]))
    assert [(i.severity, "Missing" in i.message) for i in missing] == [("critical", True)]
    extra = issues(df, R.schema_drift(["city"]))
    assert [(i.severity, i.message) for i in extra] == [("warning", "Unexpected columns found: {'t'}")]
    assert issues(df, R.schema_drift(["city", "t"])) == ()
    assert issues(df.limit(0), R.schema_drift(["x"])) == ()


def test_null_check(cities):
    found = issues(cities(("a", 1.0), (None, 2.0), ("c", 3.0)), R.null_check(["city", "t"]))
    assert [(i.rule_name, i.severity, i.affected_records) for i in found] == [("null_check", "critical", 1)]
    assert found[0].message == "Column 'city' has 1 null values (33.3%)"
    tenth = cities(*[("a", 1.0)] * 9, (None, 1.0))
    assert [i.severity for i in issues(tenth, R.null_check(["city"]))] == ["warning"]
    assert [i.affected_records for i in issues(tenth, R.null_check(["absent"]))] == [10]


def test_range_check(cities):
    df = cities(("a", 25.0), ("b", 150.0), ("c", -50.0), ("d", None))
    found = issues(df, R.range_check("t", -100, 100))
    assert [(i.severity, i.affected_records) for i in found] == [("warning", 1)]
    assert found[0].message == "Column 't' has 1 values outside range [-100, 100]"
    assert found[0].details["sample_violations"] == "[150.0]"
    many = cities(*[("a", float(x)) for x in (-7, -300, 4, 9, 12, 11, 400, 12)])
    assert issues(many, R.range_check("t", 0, 10))[0].details["sample_violations"] == "[-300.0, -7.0, 11.0, 400.0]"
    assert issues(df, R.range_check("absent", 0, 1)) == ()


def test_freshness(spark):
    ages = [23, 25, None]
    df = spark.createDataFrame([(RUN_TS - dt.timedelta(hours=h) if h else None,) for h in ages], "m timestamp")
    found = issues(df, R.freshness("m", RUN_TS))
    assert [(i.severity, i.affected_records, i.message) for i in found] == [
        ("warning", 1, "1 records are older than 24 hours")
    ]


def test_freshness_of_text(spark):
    texts = ["2024-01-29T13:30:00Z", "2024-01-28T12:00:00+00:00", "yesterday", "", None, "2024-01-27T09"]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    assert [(i.rule_name, i.affected_records) for i in issues(df, R.freshness("m", RUN_TS))] == [("freshness_check", 2)]
    assert issues(df, R.freshness("absent", RUN_TS)) == ()


def test_unique_check(cities):
    ddl = "city string, at string"
    twice = cities(("Braga", "12:00"), ("Braga", "12:00"), ("Braga", "12:00"), ("Turin", "12:00"), ddl=ddl)
    found = issues(twice, R.unique_check(["city", "at"]))
    assert [(i.severity, i.affected_records) for i in found] == [("critical", 1)]
    assert found[0].message == "Compound key ['city', 'at'] has 1 duplicate value(s)"
    assert issues(cities(("a", "1"), ("a", "2"), ("b", "1"), ddl=ddl), R.unique_check(["city", "at"])) == ()
    assert issues(twice.limit(0), R.unique_check(["city", "at"])) == ()
    nulls = cities((None, "1"), (None, "1"), ddl=ddl)
    assert [i.affected_records for i in issues(nulls, R.unique_check(["city", "at"]))] == [1]
    many = cities(*[(f"c{i}", str(i)) for i in range(9)] * 2, *nulls.collect(), ddl=ddl)
    details = issues(many, R.unique_check(["city", "at"]))[0].details
    assert details["sample_duplicates"] == "[null, 1], [c0, 0], [c1, 1], [c2, 2], [c3, 3]"


@pytest.mark.parametrize(
    "mode, rule, status",
    [
        ("warn", R.range_check("t", 0, 10), "warned"),
        ("block", R.range_check("t", 0, 10), "blocked"),
        ("warn", R.unique_check(["city"]), "blocked"),
        ("block", R.null_check(["city"]), "passed"),
    ],
)
def test_status(cities, mode, rule, status):
    df = cities(("a", 1.0), ("a", 99.0))
    result = G.Gate("g", mode, "r", [rule]).evaluate(df, "gold", RUN_TS)
    assert result.status == status
    lazy = G.gate_rows(df, [rule], gate_name="g", layer="gold", mode=mode, run_id="r", run_ts=RUN_TS)
    assert rows(lazy, "status", "metrics.total_records", "metrics.issues_found") == [
        (status, 2, 0 if status == "passed" else 1)
    ]


def test_info_passes(cities):
    rule = R.AggRule("note", lambda df: {}, lambda total, m, df: [R.issue("note", "info", "seen", total)])
    result = G.Gate("g", "block", "r", [rule]).evaluate(cities(("a", 1.0)), "gold", RUN_TS)
    assert (result.status, len(result.issues)) == ("passed", 1)


def test_a_failing_rule_leaves_the_others(cities):
    broken = R.AggRule("broken", lambda df: {"x": F.max(F.col("no_such_column"))}, lambda total, m, df: [])
    result = G.Gate("g", "warn", "r").add_rule(broken).add_rule(R.range_check("t", 0, 10)).evaluate(
        cities(("a", 99.0)), "silver", RUN_TS
    )
    assert [(i.rule_name, i.severity) for i in result.issues] == [("rule_execution", "warning"), ("range_check", "warning")]
    assert result.issues[0].message.startswith("Rule execution failed")
    assert result.metrics == {
        "total_records": 1, "rules_evaluated": 2, "issues_found": 2, "critical_issues": 0, "warning_issues": 2,
    }


def test_all_scalar_rules_share_one_aggregation(cities):
    df = cities(("a", 1.0))
    rules = [R.null_check(["city", "t"]), R.range_check("t", 0, 1), R.schema_drift(["city"])]
    plan = G.measured(df, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_metric_row(spark):
    ten = spark.range(10).withColumn("t", F.when(F.col("id") < 4, F.lit(-1.0)).otherwise(1.0))
    row = G.metric_rows(
        G.gate_rows(ten, [R.range_check("t", 0, 10)], gate_name="g", layer="silver", run_id="r", run_ts=RUN_TS)
    ).collect()[0]
    assert (row["passed_records"], row["failed_records"], float(row["pass_rate"])) == (6, 4, 60.0)
    assert "range_check" in row["failure_reason"] and not row["gate_passed"]
    four = [R.range_check("t", 0, 10), R.range_check("id", 5, 10), R.null_check(["t"]), R.null_check(["id"])]
    row = G.metric_rows(
        G.gate_rows(ten, four, gate_name="g", layer="silver", run_id="r", run_ts=RUN_TS)
    ).collect()[0]
    assert (row["expectations_evaluated"], row["expectations_passed"], row["failed_records"]) == (4, 3, 9)


def test_collected_and_lazy_results_give_the_same_row(spark, cities):
    df, rules = cities(("a", 99.0), (None, 1.0)), [R.null_check(["city"]), R.range_check("t", 0, 10)]
    result = G.Gate("g", "warn", "r", rules).evaluate(df, "silver", RUN_TS)
    lazy = G.gate_rows(df, rules, gate_name="g", layer="silver", mode="warn", run_id="r", run_ts=RUN_TS)
    assert rows(G.metric_rows(G.as_rows(spark, [result]))) == rows(G.metric_rows(lazy))


def test_block_text_holds_three_issues(cities):
    df = cities((None, 99.0))
    rules = [R.null_check(["city"]), R.range_check("t", 0, 1), R.range_check("t", 0, 2), R.range_check("t", 0, 3)]
    result = G.Gate("silver_gate", "block", "r", rules).evaluate(df, "silver", RUN_TS)
    text = str(G.GateBlocked(result))
    assert text.startswith("Quality gate 'silver_gate' blocked for silver layer: null_check: ")
    assert text.count("range_check") == 2


@pytest.mark.parametrize("worst, status, listed", [("critical", "blocked", 101), ("warning", "warned", 101), (None, "passed", 100)])
def test_a_rule_with_many_issues_keeps_its_verdict(spark, worst, status, listed):
    """The only severe issue is the last of the frame; one more issue tells what is not listed."""
    n = 250 if worst else 100

    def per_row(df):
        severity = F.when(F.col("id") == n - 1, worst or "info").otherwise("info")
        text = F.format_string("row %04d", F.col("id"))
        return df.select(R.issue("per_row", severity, text, F.col("id"), {"id": F.col("id")}).alias("i")).select("i.*")

    df, rules = spark.range(0, n, 1, 3), [R.FrameRule("per_row", per_row), R.null_check(["id"]), R.FrameRule("none", lambda df: per_row(df).limit(0))]
    result = G.Gate("g", "warn", "r", rules).evaluate(df, "gold", RUN_TS)
    assert (result.status, len(result.issues)) == (status, listed)
    assert result.metrics == {
        "total_records": n, "rules_evaluated": 3, "issues_found": n,
        "critical_issues": int(worst == "critical"), "warning_issues": int(worst == "warning"),
    }
    assert result.issues[0].message == (f"row {n - 1:04d}" if worst else "row 0000")
    assert [i.details["id"] for i in result.issues[1:100]] == [str(i) for i in range(0 if worst else 1, 99 if worst else 100)]
    if worst:
        last = result.issues[-1]
        assert (last.rule_name, last.severity, last.message) == ("per_row", "info", "150 more issues are not shown")
    assert sum(i.affected_records for i in result.issues) == sum(range(n))
    lazy = G.gate_rows(df, rules, gate_name="g", layer="gold", mode="warn", run_id="r", run_ts=RUN_TS)
    row = lazy.collect()[0]
    assert row.status == status and row.metrics.asDict() == result.metrics
    assert [i.message for i in row.issues] == [i.message for i in result.issues]
    assert rows(G.metric_rows(G.as_rows(spark, [result]))) == rows(G.metric_rows(lazy))


def test_layer_rules(raw):
    cleaned = K.clean(raw({}), WEATHER, RUN_TS)
    assert [r.name for r in L.layer_rules("bronze")] == ["schema_drift", "null_check"]
    assert [r.describe.get("columns") for r in L.layer_rules("silver")[1:]] == [
        "city,temperature_celsius,country", "temperature_celsius", "humidity",
    ]
    assert [r.describe["columns"] for r in L.layer_rules("gold")] == ["city,temperature_celsius,timestamp", "city,timestamp"]
    assert L.layer_gate("bronze").evaluate(raw({}), "bronze", RUN_TS).status == "passed"
    assert L.layer_gate("silver").evaluate(cleaned, "silver", RUN_TS).status == "passed"
    with pytest.raises(ValueError):
        L.layer_rules("platinum")


def test_rule_catalogue_is_derived(spark):
    wired = {(r["rule_name"], r["layer"], r["state"]) for r in L.rule_catalogue(spark).collect()}
    assert ("unique_check", "gold", "active") in wired and ("freshness_check", None, "not wired") in wired


def test_constraints(cities):
    df = cities(("a" * 5, 1234.5), ("bb", 1.0), (None, None))
    found = issues(
        df, R.max_length("city", 3), R.one_of("city", ["bb"]), R.not_null("city"), R.fits_decimal("t", 5, 2),
        R.within("t", 0, 10), R.references("city", df.filter("city = 'bb'").withColumnRenamed("city", "c"), "c"),
        R.min_rows(4),
    )
    assert [(i.rule_name, i.affected_records) for i in found] == [
        ("max_length", 1), ("enumeration", 1), ("not_null", 1), ("precision", 1), ("limits", 1), ("references", 1), ("min_rows", 3),
    ]


def test_json_keys_and_samples(spark, cities):
    df = cities(('{"a":1}', 1.0), ('{"a":1,"b":2}', 2.0))
    assert rows(R.json_key_drift(df, "city", ["a", "z"])) == [("a", "expected", 2), ("b", "extra", 1), ("z", "missing", 0)]
    many = spark.range(100)
    found = R.violation_samples(many, R.violates_range(F.col("id"), 10, 90), ["id"], ["id"], 3)
    assert rows(found) == [(0,), (1,), (2,)]


def test_key_tables_are_grouped_once(spark):
    """A plan with two key checks and others reads its table once for the others and once for each key."""
    df = spark.range(20).selectExpr("id", "id % 7 AS a", "id % 2 AS b")
    rules = [R.unique_check(["a"]), R.unique_check(["a", "b"]), R.null_check(["a", "b"]), R.range_check("b", 0, 0)]
    plan = G.measured(df, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 20") == 3 and "subquery" not in plan
    row = G.measured(df, rules).first()
    assert (row["total_records"], row["issues_found"], row["critical_issues"]) == (20, 3, 2)


@pytest.mark.parametrize("where", [None, "x >= 0"])
def test_observed_measures_equal_evaluated_ones(spark, tmp_path, where):
    from tidewell.operators.observed import Observed

    rows_ = [(1, 5.0, None), (2, -1.0, "a"), (2, 7.5, "b"), (None, None, "a"), (4, 100.0, "toolong")]
    df = spark.createDataFrame(rows_, "id int, x double, t string")
    rules = [R.null_check(["id", "x"]), R.range_check("x", 0, 50), R.not_null("t"), R.max_length("t", 3), R.unique_check(["id"]), R.min_rows(9), R.schema_drift(["id", "x", "z"])]
    seen = Observed(df, rules, None if where is None else F.expr(f"coalesce({where}, false)"))
    seen.frame.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    stored = stored if where is None else stored.filter(where)
    plain = G.Gate("g", "warn", "", rules).evaluate(stored, "silver", RUN_TS)
    observed = G.Gate("g", "warn", "", rules).evaluate(stored, "silver", RUN_TS, seen.row())
    assert (observed.status, observed.issues, observed.metrics) == (plain.status, plain.issues, plain.metrics)
    assert len(plain.issues) >= 5 and seen.total == stored.count()


def test_a_measure_that_cannot_be_observed(spark, tmp_path):
    """The rows are written all the same, and the gate reports the rule."""
    from tidewell.operators.observed import write_observed

    df = spark.createDataFrame([("1",), ("x",)], "v string")
    fails = R.AggRule("fails", lambda d: {"s": F.sum(F.col("v").cast("int"))}, lambda t, m, d: [R.issue("fails", "info", "x", m["s"])])
    absent = R.AggRule("absent", lambda d: {"s": F.sum("nothing")}, lambda t, m, d: [])

    def write(frame):
        frame.write.mode("overwrite").parquet(str(tmp_path / "t"))
        return spark.read.schema("v string").parquet(str(tmp_path / "t"))

    for rule in (fails, absent):
        stored, seen, total = write_observed(df, [rule], write)
        assert (stored.count(), total) == (2, 2)
        verdict = G.Gate("g", "block", "", [rule]).evaluate(stored, "bronze", RUN_TS, seen)
        assert [i.rule_name for i in verdict.issues] == ["rule_execution"]
