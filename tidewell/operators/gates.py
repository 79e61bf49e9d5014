"""Quality gates: run rules over a batch, decide, and describe the outcome as a row."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fixed
from ..functions import numeric as N
from ..sources.workspace import literal_rows
from . import rules as R

WARN, BLOCK = "warn", "block"
#: Issues of one FrameRule that are listed, and the detail that tells how many more it has.
MOST_ISSUES, LEFT_OUT = 100, "issues_left_out"
COUNTS = ("issues_found", "critical_issues", "warning_issues")
_ISSUE = [p.split(" ", 1)[0] for p in R.ISSUE_DDL.split(", ")]


@dataclass(frozen=True)
class Issue:
    rule_name: str
    severity: str
    message: str
    affected_records: int = 0
    details: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class GateResult:
    gate_name: str
    run_id: str
    status: str
    layer: str
    issues: tuple[Issue, ...]
    metrics: dict[str, int]
    evaluated_at: dt.datetime
    duration_ms: float

    @property
    def passed(self) -> bool:
        return self.status in ("passed", "warned")

    @property
    def blocked(self) -> bool:
        return self.status == "blocked"


class GateBlocked(Exception):
    """Raised by a run whose gate vetoes the batch."""

    def __init__(self, result: GateResult):
        self.result = result
        shown = ", ".join(
            f"{i.rule_name}: {i.message}" for i in result.issues[: fixed.BLOCK_TEXT_ISSUES]
        )
        super().__init__(
            f"Quality gate '{result.gate_name}' blocked for {result.layer} layer: {shown}"
        )


# --- as expressions over an array of issues -----------------------------------


def count_severity(issues: Column, severity: str) -> Column:
    return F.size(F.filter(issues, lambda i: i["severity"] == severity))


def status_of(issues: Column, mode: str | Column) -> Column:
    """passed / warned / blocked from the worst severity and the gate mode."""
    mode = mode if isinstance(mode, Column) else F.lit(mode)
    critical = F.exists(issues, lambda i: i["severity"] == "critical")
    warning = F.exists(issues, lambda i: i["severity"] == "warning")
    return (
        F.when(critical, "blocked")
        .when(warning & (mode == BLOCK), "blocked")
        .when(warning, "warned")
        .otherwise("passed")
    )


def _bounded(found: DataFrame) -> DataFrame:
    """One row for a frame of issues: the MOST_ISSUES worst, and counts by severity and records of all.

    An issue frame has a handful of rows by contract. One that breaks it is shown in part, by severity
    and content; the verdict and the counts are those of the whole frame.
    """
    severity = F.col("severity")
    rank = F.when(severity == "critical", 0).when(severity == "warning", 1).otherwise(2)
    place = F.struct(rank, "rule_name", "message", "affected_records", severity, F.array_sort(F.map_entries("details")))
    # maps cannot be sorted, so the details stand beside the place
    placed = R.leading(found.select("severity", "affected_records", place.alias("place"), F.struct(*_ISSUE).alias("issue")), ["place"], MOST_ISSUES)
    by_place = F.array_sort("_held", lambda x, y: F.when(x["place"] < y["place"], -1).when(x["place"] > y["place"], 1).otherwise(0))
    return placed.agg(
        F.collect_list(F.when(F.col("_leads"), F.struct("place", "issue"))).alias("_held"),
        F.struct(
            F.count(F.lit(1)).alias("n"), F.count_if(severity == "critical").alias("critical"),
            F.count_if(severity == "warning").alias("warning"), F.sum("affected_records").alias("records"),
        ).alias("_counts"),
    ).select(F.transform(F.slice(by_place, 1, MOST_ISSUES), lambda x: x["issue"]).alias("_issues"), "_counts")


def _left_out(shown: Column, counts: Column) -> Column:
    """An array of one issue that stands for those not shown, as severe as the worst of them, or of none."""
    more = counts["n"] - F.size(shown)
    worst = (
        F.when(counts["critical"] > count_severity(shown, "critical"), "critical")
        .when(counts["warning"] > count_severity(shown, "warning"), "warning")
        .otherwise("info")
    )
    records = F.coalesce(counts["records"], F.lit(0)) - F.aggregate(
        shown, F.lit(0).cast("bigint"), lambda s, i: s + F.coalesce(i["affected_records"], F.lit(0))
    )
    text = F.format_string("%d more issues are not shown", more)
    told = R.issue(F.get(shown, F.lit(0))["rule_name"], worst, text, records, {LEFT_OUT: more})
    return F.array_compact(F.array(F.when(more > 0, told)))


def aggregates_of(df: DataFrame, rules: Sequence[R.Rule], where: Column | None = None) -> dict[str, Column]:
    """Named aggregates of a gate: the total and what its AggRules measure, over all rows or those of ``where``.
    A rule that cannot be measured on part of a frame is left out there."""
    named = {R.TOTAL: F.count(F.lit(1)) if where is None else F.count_if(where)}
    for position, rule in enumerate(rules):
        if not isinstance(rule, R.AggRule) or (where is not None and rule.measures_where is None):
            continue
        found = rule.measures(df) if where is None else rule.measures_where(df, where)
        named |= {f"m{position}_{name}": column for name, column in found.items()}
    return named


def measured(df: DataFrame, rules: Sequence[R.Rule], seen: DataFrame | None = None) -> DataFrame:
    """One row: total rows, all issues in rule order, and how many there are, in all and by severity.

    The AggRules become one aggregation; each FrameRule is one more frame of one row, and all of these rows
    meet in one. Issues of a FrameRule beyond MOST_ISSUES are counted, and one more issue in the list tells
    of them. ``seen`` is a row of aggregates that were measured earlier (see ``observed``): the
    frame is read only for the rules that it does not cover.
    """
    wanted = aggregates_of(df, rules)
    missing = {n: c for n, c in wanted.items() if seen is None or n not in seen.columns}
    if seen is None:
        totals = df.agg(*[c.alias(n) for n, c in wanted.items()])
    elif missing:
        totals = df.agg(*[c.alias(n) for n, c in missing.items()]).crossJoin(F.broadcast(seen))  # a row and a row
    else:
        totals = seen
    frames = {p: rule for p, rule in enumerate(rules) if not isinstance(rule, R.AggRule)}
    if frames:
        gathered = totals.select(F.lit(-1).alias("_rule"), F.struct(*wanted).alias("_totals"))
        for position, rule in frames.items():
            found = _bounded(rule.issues(df)).withColumn("_rule", F.lit(position))
            gathered = gathered.unionByName(found, allowMissingColumns=True)

        def of(position: int, column: str) -> Column:
            return F.max_by(column, F.when(F.col("_rule") == position, 1))

        totals = gathered.agg(
            of(-1, "_totals").alias("_totals"),
            *[of(p, c).alias(f"{c}{p}") for p in frames for c in ("_issues", "_counts")],
        ).select("_totals.*", *[f"{c}{p}" for p in frames for c in ("_issues", "_counts")])

    # issues of AggRules between two FrameRules are one array: few expressions, whatever the number of rules
    columns, listed, plain, told, pending = [F.col(R.TOTAL)], [], [], {}, []

    def gather() -> None:
        if pending:
            name = f"_found{len(plain)}"
            columns.append(F.array_compact(F.array(*pending)).alias(name))
            plain.append(F.col(name))
            listed.append(F.col(name))
            pending.clear()

    for position, rule in enumerate(rules):
        if position in frames:
            gather()
            shown, counts = F.col(f"_issues{position}"), F.col(f"_counts{position}")
            columns += [shown, counts]
            told[position] = _left_out(shown, counts)
            listed += [shown, told[position]]
        else:
            prefix = f"m{position}_"
            found = {m.removeprefix(prefix): F.col(m) for m in wanted if m.startswith(prefix)}
            pending += rule.judge(F.col(R.TOTAL), found, df)
    gather()
    empty = F.from_json(F.lit("[]"), f"array<struct<{_as_struct(R.ISSUE_DDL)}>>")
    issues = F.concat(*listed) if listed else empty

    def number(of_array, of_counts: str) -> Column:
        return sum([of_array(c) for c in plain] + [F.col(f"_counts{p}")[of_counts] for p in told], F.lit(0)).cast("int")

    return totals.select(*columns).select(
        R.TOTAL, issues.alias("issues"),
        number(F.size, "n").alias("issues_found"),
        number(lambda a: count_severity(a, "critical"), "critical").alias("critical_issues"),
        number(lambda a: count_severity(a, "warning"), "warning").alias("warning_issues"),
    )


def _as_struct(ddl: str) -> str:
    return ", ".join(f"{p.split(' ', 1)[0]}: {p.split(' ', 1)[1]}" for p in ddl.split(", "))


def gate_rows(
    df: DataFrame,
    rules: Sequence[R.Rule],
    *,
    gate_name: str,
    layer: str,
    mode: str = BLOCK,
    run_id: str = "",
    run_ts: dt.datetime,
    seen: DataFrame | None = None,
) -> DataFrame:
    """The gate as a lazy one-row frame: status, issues, metrics. ``seen`` as in ``measured``."""
    issues = F.col("issues")
    return measured(df, rules, seen).select(
        F.lit(gate_name).alias("gate_name"),
        F.lit(run_id).alias("run_id"),
        status_of(issues, mode).alias("status"),
        F.lit(layer).alias("layer"),
        issues,
        F.struct(
            F.col(R.TOTAL),
            F.lit(len(rules)).alias("rules_evaluated"),
            *COUNTS,
        ).alias("metrics"),
        N.as_moment(run_ts).alias("evaluated_at"),
    )


METRIC_DDL = (
    "run_id string, layer string, total_records bigint, passed_records bigint, failed_records bigint, "
    "pass_rate decimal(5,2), expectation_suite string, expectations_evaluated int, "
    "expectations_passed int, evaluated_at timestamp, gate_passed boolean, failure_reason string"
)


def metric_rows(gates: DataFrame) -> DataFrame:
    """Gate results as rows of the quality-metric table.

    Failed records add up over issues, so a row that breaks two rules counts twice; rules
    that share a name count as one failing expectation.
    """
    issues, total = F.col("issues"), F.col("metrics.total_records")
    failed = F.aggregate(issues, F.lit(0).cast("bigint"), lambda s, i: s + i["affected_records"])
    passed = F.greatest(total - failed, F.lit(0))
    failing = F.size(F.array_distinct(F.transform(issues, lambda i: i["rule_name"])))
    ok = F.col("status").isin("passed", "warned")
    reason = F.array_join(
        F.transform(
            F.slice(issues, 1, fixed.REASON_ISSUES),
            lambda i: F.concat(i["rule_name"], F.lit(": "), i["message"]),
        ),
        "; ",
    )
    return gates.select(
        "run_id",
        "layer",
        total.alias("total_records"),
        passed.alias("passed_records"),
        failed.alias("failed_records"),
        N.pass_rate(passed, total).alias("pass_rate"),
        F.col("gate_name").alias("expectation_suite"),
        F.col("metrics.rules_evaluated").alias("expectations_evaluated"),
        F.greatest(F.col("metrics.rules_evaluated") - failing, F.lit(0)).alias("expectations_passed"),
        "evaluated_at",
        ok.alias("gate_passed"),
        F.when(~ok & (F.size(issues) > 0), reason).alias("failure_reason"),
    )


# --- as a driver-side decision ------------------------------------------------


def _collect(df: DataFrame, rules: Sequence[R.Rule], seen: DataFrame | None = None) -> tuple[int, list[Issue], list[int]]:
    """Total, issues and COUNTS of a batch. A rule that fails becomes a warning of its own."""
    try:
        row = measured(df, rules, seen).collect()[0]
        return row[R.TOTAL], [Issue(**i.asDict()) for i in row["issues"]], [row[c] for c in COUNTS]
    except Exception as failure:  # noqa: BLE001  a user rule may raise anything
        if len(rules) <= 1:
            if not rules:
                raise
            text = f"Rule execution failed: {_first_line(failure)}"
            return df.count(), [Issue("rule_execution", "warning", text)], [1, 0, 1]
    total, issues, counts = 0, [], [0] * len(COUNTS)
    for rule in rules:
        total, found, more = _collect(df, [rule])
        issues.extend(found)
        counts = [a + b for a, b in zip(counts, more)]
    return total, issues, counts


def _first_line(failure: Exception) -> str:
    text = failure.getMessage() if isinstance(failure, PySparkException) else str(failure)
    return (text or type(failure).__name__).splitlines()[0]


def _status(issues: Sequence[Issue], mode: str) -> str:
    severities = {i.severity for i in issues}
    if "critical" in severities or ("warning" in severities and mode == BLOCK):
        return "blocked"
    return "warned" if "warning" in severities else "passed"


@dataclass
class Gate:
    """A named list of rules with a mode; ``evaluate`` runs them over one batch."""

    name: str
    mode: str = BLOCK
    run_id: str = ""
    rules: list[R.Rule] = field(default_factory=list)

    def add_rule(self, rule: R.Rule) -> "Gate":
        self.rules.append(rule)
        return self

    def evaluate(self, df: DataFrame, layer: str, run_ts: dt.datetime, seen: DataFrame | None = None) -> GateResult:
        """The verdict on a batch; ``seen`` holds aggregates observed while it was written."""
        started = time.monotonic()
        total, issues, counts = _collect(df, self.rules, seen)
        return GateResult(
            gate_name=self.name,
            run_id=self.run_id,
            status=_status(issues, self.mode),
            layer=layer,
            issues=tuple(issues),
            metrics={
                "total_records": total,
                "rules_evaluated": len(self.rules),
                **dict(zip(COUNTS, counts)),
            },
            evaluated_at=run_ts,
            duration_ms=(time.monotonic() - started) * 1000,
        )


GATE_DDL = (
    "gate_name string, run_id string, status string, layer string, "
    f"issues array<struct<{_as_struct(R.ISSUE_DDL)}>>, "
    "metrics struct<total_records: bigint, rules_evaluated: int, issues_found: int, "
    "critical_issues: int, warning_issues: int>, evaluated_at timestamp, duration_ms double"
)


def as_rows(spark, results: Sequence[GateResult]) -> DataFrame:
    """Collected gate results (a few per run) as a frame in the gate schema."""
    return literal_rows(spark, [asdict(r) for r in results], GATE_DDL)
