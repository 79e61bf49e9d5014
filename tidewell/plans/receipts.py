"""What a run leaves behind: run row, gate rows, lineage, metrics series, alerts."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as fixed
from ..functions import numeric as N, text as X
from ..operators.gates import GATE_DDL, METRIC_DDL, GateResult, as_rows, metric_rows
from ..operators.reads import newest
from ..sources.workspace import literal_rows

RUN_DDL = (
    "run_id string, status string, started_at timestamp, completed_at timestamp, "
    "duration_seconds double, entities_processed bigint, records_ingested bigint, "
    "records_transformed bigint, records_loaded bigint, quality_gate_passed boolean, "
    "quality_gate_reason string, error_message string, error_traceback string"
)
ARTIFACT_DDL = (
    "run_id string, layer string, key string, record_count bigint, published_at timestamp, "
    "position int, entities array<string>, attempt string, written_at timestamp, parents array<string>"
)
SERVED_DDL = "run_id string, key string, served_on date, attempt string, written_at timestamp"

# the operational tables; the run table holds whole seconds
OPS_DDL = {
    "runs": RUN_DDL.replace("duration_seconds double", "duration_seconds bigint"),
    "quality_metrics": METRIC_DDL,
    "gates": GATE_DDL,
    "lineage": ARTIFACT_DDL,
    "served": SERVED_DDL,
}


@dataclass(frozen=True)
class Artifact:
    """A published folder; ``parents`` are the folders it was derived from."""

    layer: str
    key: str
    record_count: int
    parents: tuple[str, ...] = ()


@dataclass
class RunResult:
    """Outcome of one layered run; filled in while it proceeds. Every attempt at a run has
    a name of its own, so that none writes into the folders of another."""

    run_id: str
    started_at: dt.datetime
    status: str = "running"
    completed_at: dt.datetime | None = None
    duration_seconds: float = 0.0
    entities_processed: int = 0
    records_ingested: int = 0
    records_transformed: int = 0
    records_loaded: int = 0
    gates: list[GateResult] = field(default_factory=list)
    artifacts: list[Artifact] = field(default_factory=list)
    quality_gate_passed: bool = True
    quality_gate_reason: str = ""
    error_message: str = ""
    error_traceback: str = ""
    entities: list[str] = field(default_factory=list)
    attempt: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def exit_code(self) -> int:
        return {"success": 0, "blocked": 2}.get(self.status, 1)


def run_rows(spark: SparkSession, results: Sequence[RunResult]) -> DataFrame:
    names = [part.split(" ")[0] for part in RUN_DDL.split(", ")]
    return literal_rows(spark, [{n: getattr(r, n) for n in names} for r in results], RUN_DDL)


def stored_runs(runs: DataFrame) -> DataFrame:
    """Run rows as the run table holds them: whole seconds, empty texts as NULL."""
    return runs.withColumns(
        {
            "duration_seconds": N.whole_seconds(F.col("duration_seconds")),
            "quality_gate_reason": F.nullif("quality_gate_reason", F.lit("")),
            "error_message": F.nullif("error_message", F.lit("")),
            **({"error_traceback": F.nullif("error_traceback", F.lit(""))} if "error_traceback" in runs.columns else {}),
        }
    )


def artifact_rows(spark: SparkSession, result: RunResult, artifacts: Sequence[Artifact]) -> DataFrame:
    """Lineage rows of artifacts, numbered on from those the run has published already."""
    shared = {
        "run_id": result.run_id, "published_at": result.started_at, "entities": result.entities,
        "attempt": result.attempt, "written_at": dt.datetime.now(dt.timezone.utc),
    }
    first = len(result.artifacts)
    rows = [asdict(a) | shared | {"position": first + i} for i, a in enumerate(artifacts)]
    return literal_rows(spark, rows, ARTIFACT_DDL)


def current_artifacts(lineage_rows: DataFrame) -> DataFrame:
    """The newest publication of each run and layer."""
    whole = F.struct(*lineage_rows.columns)
    newest_row = F.max_by(whole, F.struct("written_at", "attempt"))
    return lineage_rows.groupBy("run_id", "layer").agg(newest_row.alias("_row")).select("_row.*")


def manifests(artifacts: DataFrame) -> DataFrame:
    """One row per run: its inputs, its start, and its artifacts in the order of the run."""
    nested = lineage(artifacts, "position")
    heads = artifacts.groupBy("run_id").agg(
        F.max_by("entities", "written_at").alias("entities"), F.min("published_at").alias("started_at")
    )
    return heads.join(nested, "run_id").select("run_id", "entities", "started_at", "artifact_count", "artifacts")


def lineage(artifacts: DataFrame, order: str = "key") -> DataFrame:
    """Artifacts nested per run. A run has one artifact per layer and table, so the list
    is short by construction."""
    item = F.struct("layer", "key", "record_count")
    return artifacts.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("artifact_count"),
        F.transform(
            F.sort_array(F.collect_list(F.struct(F.col(order).alias("_order"), item.alias("item")))),
            lambda x: x["item"],
        ).alias("artifacts"),
    )


def gate_history(spark: SparkSession, results: Sequence[GateResult]) -> DataFrame:
    return metric_rows(as_rows(spark, results))


# --- metric series --------------------------------------------------------------


def stage_series(runs: DataFrame) -> DataFrame:
    """Record counts of each run in long form, one row per stage."""
    return runs.select(
        "run_id",
        F.stack(
            F.lit(3),
            F.lit("ingested"), F.col("records_ingested").cast("bigint"),
            F.lit("transformed"), F.col("records_transformed").cast("bigint"),
            F.lit("loaded"), F.col("records_loaded").cast("bigint"),
        ).alias("stage", "value"),
    )


def latest_run_gauges(runs: DataFrame, tie_break: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """Duration, start and record counts of the newest run, one row per gauge."""
    last = newest(runs, "started_at", 1, tie_break)
    started = F.unix_micros(F.col("started_at").cast("timestamp")) / F.lit(1e6)
    gauges = [("duration_seconds", F.col("duration_seconds")), ("last_run_timestamp_seconds", started)]
    gauges += [(stage, F.col(f"records_{stage}")) for stage in ("ingested", "transformed", "loaded")]
    pairs = [x for name, value in gauges for x in (F.lit(name), value.cast("double"))]
    return last.select("run_id", F.stack(F.lit(len(gauges)), *pairs).alias("gauge", "value"))


def runs_by_status(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("value"))


def gates_by_status(gates: DataFrame) -> DataFrame:
    return gates.groupBy("layer", "status").agg(F.count(F.lit(1)).alias("value"))


def issues_by_severity(gates: DataFrame) -> DataFrame:
    """Issue counts per layer for every severity, zeros included."""
    severity = F.explode(F.array(*[F.lit(s) for s in fixed.SEVERITIES])).alias("severity")
    each = gates.select("layer", "issues", severity)
    held = F.size(F.filter("issues", lambda i: i["severity"] == F.col("severity")))
    return each.groupBy("layer", "severity").agg(F.sum(held).alias("value"))


# --- alerts ---------------------------------------------------------------------


def alerts(runs: DataFrame) -> DataFrame:
    """Texts for failed and blocked runs."""
    stats: list[tuple[str, Column]] = [
        ("ingested", F.col("records_ingested")),
        ("transformed", F.col("records_transformed")),
        ("loaded", F.col("records_loaded")),
    ]
    reason = F.coalesce(
        F.nullif("quality_gate_reason", F.lit("")), F.nullif("error_message", F.lit(""))
    )
    return runs.filter(F.col("status").isin(*fixed.ALERTED_STATUSES)).select(
        "run_id", "status", X.alert_text(F.col("status"), F.col("run_id"), reason, stats).alias("text")
    )


def new_run_id() -> str:
    return str(uuid.uuid4())
