"""The layered run: land, audit, clean, audit, enrich, audit, load, leave receipts.

Each layer is written once, to a folder that names the run and the attempt at it. The measures of its
gate are observed while it is written; only checks with a grouping of their own read it again, and of
its columns only their key. A batch counts as published once the
lineage table names its folder; lineage rows are only ever added, and readers follow the newest of
each run and layer. So a vetoed batch stays invisible, whatever earlier attempts published, nothing
is copied, and no published folder is written to again.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
import traceback
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import fixed_values as fixed
from ..functions import enrichment as E, numeric as N
from ..operators import cleaning as K, rules as R, statistics as S
from ..operators.gates import BLOCK, Gate, GateBlocked, GateResult
from ..operators.observed import write_observed
from ..operators.partials import upsert_daily
from ..sources import lake, landing, serving
from ..sources.workspace import read_or_empty
from ..spec import WEATHER, TableSpec
from . import lineage, receipts as P
from .layers import layer_gate

LOG = logging.getLogger(__name__)
REJECTED = "rejected"
KEPT = f"{REJECTED}=false"


def enrich_weather(silver: DataFrame) -> DataFrame:
    """Gold records of the weather spec: date and category labels."""
    return silver.withColumns(
        {
            "date": F.to_date("timestamp"),
            "temp_category": E.temperature_category(F.col("temperature_celsius")),
            "wind_category": E.wind_category(F.col("wind_speed")),
        }
    )


@dataclass(frozen=True)
class Tables:
    """Paths of one installation, all below one root."""

    root: str

    def batch(self, layer: str, result: P.RunResult) -> str:
        folder = lake.batch_path(self.root, layer, result.started_at, result.run_id)
        return f"{folder}/attempt={result.attempt}"

    @property
    def serving(self) -> str:
        return f"{self.root}/serving"

    @property
    def daily_serving(self) -> str:
        return f"{self.root}/daily_serving"

    def staging(self, result: P.RunResult) -> str:
        return f"{self.root}/_staging/{result.run_id}-{result.attempt}"

    def ops(self, name: str) -> str:
        return f"{self.root}/ops/{name}"

    def receipts(self, spark: SparkSession, name: str) -> DataFrame:
        """All receipts of an operational table, with the ``day`` and ``receipt`` of their folder; superseded ones too."""
        return read_or_empty(spark, self.ops(name), f"{P.OPS_DDL[name]}, day date, receipt string")

    def read_ops(
        self, spark: SparkSession, name: str, first: dt.date | None = None, last: dt.date | None = None
    ) -> DataFrame:
        """An operational table: the receipts of all runs, or of the run dates between two
        days. Dates are folders, so others are not opened.

        Of the lineage, a publication counts on the day of the newest attempt at its run and layer, which may lie
        outside the window: windows that cover all days add up to the whole."""
        rows = self.receipts(spark, name)

        def within(df: DataFrame) -> DataFrame:
            df = df if first is None else df.filter(F.col("day") >= F.lit(first))
            return df if last is None else df.filter(F.col("day") <= F.lit(last))

        if name != "lineage":
            return within(rows).drop("day", "receipt")
        if first is not None or last is not None:
            # later attempts may lie on any day, but only those of the runs of the window matter
            rows = rows.join(within(rows).select("run_id").distinct(), "run_id", "left_semi")
        return within(P.current_artifacts(rows)).drop("day", "receipt")

    def write_ops(self, rows: DataFrame, name: str, day: dt.date, *key: str) -> None:
        """Receipts go to a folder named by run date and key: a repeated run updates its own."""
        rows.write.mode("overwrite").parquet(f"{self.ops(name)}/day={day.isoformat()}/receipt={'-'.join(key)}")

    def expire(
        self, spark: SparkSession, today: dt.date, keep_days: dict[str, int], quarantine_days: int = fixed.QUARANTINE_DAYS
    ) -> dict[str, list[dt.date]]:
        """Remove the day folders of layers (name: days kept) and of the quarantine that are too
        old; returns the dates removed. For layers with lineage ``retention.sweep`` removes batches and the rows
        that name them together; this leaves the rows."""
        wanted = {"quarantine": quarantine_days} | keep_days
        return {layer: lake.expire_days(spark, f"{self.root}/{layer}", today, days) for layer, days in wanted.items()}

    def first_start(self, spark: SparkSession, run_id: str) -> dt.datetime | None:
        """When a run of this id first began; opens the receipt of that run only."""
        rows = self.receipts(spark, "runs").filter(F.col("receipt") == run_id)
        micros = rows.agg(F.min(F.unix_micros("started_at")).alias("m")).collect()[0]["m"]
        return None if micros is None else dt.datetime.fromtimestamp(micros / 1e6, dt.timezone.utc)


@dataclass
class LayeredRun:
    """A run over one batch. ``enrich`` and ``aggregates`` shape the gold layer; ``load``
    takes (gold records, result) and returns how many rows the serving side accepted. ``daily`` makes
    rows per entity and date of served rows: those of the days that a load has touched are upserted
    into the daily serving table."""

    spark: SparkSession
    tables: Tables
    spec: TableSpec = WEATHER
    mode: str = BLOCK
    enrich: Callable[[DataFrame], DataFrame] = enrich_weather
    aggregates: dict[str, Callable[[DataFrame], DataFrame]] | None = None
    load: Callable[[DataFrame, P.RunResult], int] | None = None
    daily: Callable[[DataFrame], DataFrame] | None = None

    def run(
        self, raw: DataFrame, run_ts: dt.datetime, run_id: str | None = None, entities: Sequence[str] | None = None
    ) -> P.RunResult:
        """One attempt over a landed batch; ``entities`` is what was asked for, kept in the manifest."""
        return self._attempt(P.RunResult(run_id or P.new_run_id(), run_ts, entities=list(entities or ())), raw, self._layers)

    def reprocess(
        self, schema: T.StructType, run_ts: dt.datetime, first: dt.date | None = None, last: dt.date | None = None,
        run_id: str | None = None,
    ) -> P.RunResult:
        """Silver and gold rebuilt from the bronze batches published between two run dates."""
        return self._again(published_keys(self.spark, self.tables, "bronze", first, last), schema, run_ts, run_id or P.new_run_id())

    def reprocess_derived(self, schema: T.StructType, run_ts: dt.datetime, bronze: Sequence[str]) -> list[P.RunResult]:
        """Everything derived from some bronze folders built again: a new attempt at each run that has published silver
        from one of them, over all bronze that run has read. It takes the place of what the run published before."""
        found = lineage.derived(self.spark, self.tables, bronze).filter("layer = 'silver' and current")
        runs = sorted(r["run_id"] for r in found.select("run_id").distinct().collect())
        rows = self.tables.read_ops(self.spark, "lineage").filter((F.col("layer") == "silver") & F.col("run_id").isin(runs))
        sources = {r["run_id"]: r["parents"] for r in rows.select("run_id", "parents").collect()}
        return [self._again(sources[run], schema, run_ts, run) for run in runs]

    def _again(self, bronze: Sequence[str], schema: T.StructType, run_ts: dt.datetime, run_id: str) -> P.RunResult:
        def later_layers(given: DataFrame, result: P.RunResult) -> None:
            result.records_ingested = given.count()
            if not result.records_ingested:
                raise ValueError("No data ingested")
            self._from_bronze(given, result, bronze)

        return self._attempt(P.RunResult(run_id, run_ts), read_folders(self.spark, bronze, schema), later_layers)

    def _attempt(
        self, result: P.RunResult, given: DataFrame, layers: Callable[[DataFrame, P.RunResult], None]
    ) -> P.RunResult:
        run_ts, started = result.started_at, time.monotonic()
        try:
            layers(given, result)
            result.status = "success"
        except GateBlocked as veto:
            result.status, result.quality_gate_passed = "blocked", False
            result.quality_gate_reason = str(veto)
        except Exception as failure:  # noqa: BLE001  every failure ends in a run row
            result.status, result.error_message = "failed", str(failure).split("\n\nJVM")[0]
            result.error_traceback = traceback.format_exc()
        result.duration_seconds = time.monotonic() - started
        result.completed_at = run_ts + dt.timedelta(seconds=result.duration_seconds)
        self.leave_receipts(result)
        return result

    # --- layers -----------------------------------------------------------------

    def _layers(self, raw: DataFrame, result: P.RunResult) -> None:
        bronze, seen, result.records_ingested = self._write(raw, "bronze", result, self._rules("bronze"))
        if not result.records_ingested:
            raise ValueError("No data ingested")
        if self.spec.entity in bronze.columns:  # one column is read
            result.entities_processed = bronze.agg(F.count_distinct(self.spec.entity)).collect()[0][0]
        # bronze is the faithful copy of the source: it stays, whatever its gate says
        self._publish(result, ("bronze", result.records_ingested))
        self._veto(self._audit(bronze, "bronze", result, seen))
        self._from_bronze(bronze, result, [self._key("bronze", result)])

    def _from_bronze(self, bronze: DataFrame, result: P.RunResult, sources: Sequence[str]) -> None:
        judged = K.clean_with_reason(bronze, self.spec, result.started_at)
        silver, rejects, seen = self._split(judged, result)
        self._quarantine(rejects, result)
        verdict = self._audit(silver, "silver", result, seen)
        result.records_transformed = verdict.metrics["total_records"]
        self._veto(verdict)
        self._publish(result, ("silver", result.records_transformed), parents=sources)

        gold, seen, _ = self._write(self.enrich(silver), "gold", result, self._rules("gold"))
        self._veto(self._audit(gold, "gold", result, seen))
        layers = [("gold", result.records_transformed)]
        for name, aggregate in (self.aggregates or {}).items():
            _, _, records = self._write(aggregate(silver), f"gold_{name}", result)
            layers.append((f"gold_{name}", records))
        result.records_loaded = self._load(gold, result)
        self._publish(result, *layers, parents=[self._key("silver", result)])

    def _rules(self, layer: str) -> list[R.Rule]:
        return self._gate(layer, "").rules

    def _gate(self, layer: str, run_id: str) -> Gate:
        return layer_gate(layer, self.mode, run_id, self.spec)

    def _write(
        self, df: DataFrame, layer: str, result: P.RunResult, rules: Sequence[R.Rule] = ()
    ) -> tuple[DataFrame, DataFrame | None, int]:
        """(the layer read again, observed measures of its rules, rows)."""
        def write(observed: DataFrame) -> DataFrame:
            path = lake.write_batch(observed, self.tables.batch(layer, result))
            return self.spark.read.schema(df.schema).parquet(path)

        return write_observed(df, rules, write)

    def _split(self, judged: DataFrame, result: P.RunResult) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """Valid and rejected rows in one pass over bronze: the flag is a partition column,
        so each side later reads only its own files. The silver gate is observed on the valid ones."""
        path = self.tables.batch("silver", result)
        flagged = judged.withColumn(REJECTED, F.col(K.REASON).isNotNull())
        stored, seen, _ = write_observed(
            flagged, self._rules("silver"), lambda df: lake.write_split(df, path, REJECTED), ~F.col(REJECTED)
        )
        valid = stored.filter(~F.col(REJECTED)).select(*self.spec.clean_columns)
        return valid, stored.filter(REJECTED), seen

    def _audit(self, df: DataFrame, layer: str, result: P.RunResult, seen: DataFrame | None = None) -> GateResult:
        verdict = self._gate(layer, result.run_id).evaluate(df, layer, result.started_at, seen)
        result.gates.append(verdict)
        return verdict

    def _veto(self, verdict: GateResult) -> None:
        if verdict.blocked:
            raise GateBlocked(verdict)

    def _quarantine(self, rejects: DataFrame, result: P.RunResult) -> None:
        """Rejects are kept for triage; a failure to keep them does not stop the run."""
        rows = K.quarantine_rows(rejects, result.started_at)
        try:
            lake.write_batch(rows, self.tables.batch("quarantine", result))
        except Exception:  # noqa: BLE001
            LOG.exception("quarantine of run %s not written", result.run_id)

    def _load(self, gold: DataFrame, result: P.RunResult) -> int:
        if self.load is not None:
            return self.load(gold, result)
        staging = self.tables.staging(result)
        accepted = serving.load(
            self.spark,
            gold,
            self.tables.serving,
            staging,
            result.started_at,
            self.spec,
            run_id=result.run_id,
            unique=True,  # the gold gate has just checked the key
        )
        if accepted:
            days = serving.touched_days(self.spark, staging)
            rows = lineage.served_rows(days, result, self._key("gold", result))
            self.tables.write_ops(rows, "served", result.started_at.date(), result.run_id, result.attempt)
            if self.daily is not None:
                # a day is made of all its served rows, of earlier batches too: only the touched days are read
                served = serving.read_served(self.spark, self.tables.serving, self.spec)
                touched = serving.within_days_of(served, days.withColumnRenamed("day", serving.DAY)).drop(serving.DAY)
                upsert_daily(self.daily(touched), self.tables.daily_serving, [self.spec.entity])
        return accepted

    def _key(self, layer: str, result: P.RunResult) -> str:
        path = self.tables.batch(layer, result)
        return f"{path}/{KEPT}" if layer == "silver" else path

    def _publish(self, result: P.RunResult, *layers: tuple[str, int], parents: Sequence[str] = ()) -> None:
        """Lineage rows for written folders, in one write: from then on readers see them."""
        artifacts = [P.Artifact(layer, self._key(layer, result), records, tuple(parents)) for layer, records in layers]
        rows = P.artifact_rows(self.spark, result, artifacts)
        self.tables.write_ops(rows, "lineage", result.started_at.date(), result.run_id, layers[0][0], result.attempt)
        result.artifacts.extend(artifacts)

    # --- receipts ---------------------------------------------------------------

    def leave_receipts(self, result: P.RunResult) -> None:
        """Run row first, then its gate rows, which refer to it. Receipts are best effort:
        losing one does not undo the load."""
        def runs() -> DataFrame:
            row = P.stored_runs(P.run_rows(self.spark, [result]))
            return row.withColumn("started_at", N.as_moment(begun))

        begun = result.started_at
        try:  # a repeated run updates its row and keeps its start
            begun = self.tables.first_start(self.spark, result.run_id) or begun
        except Exception:  # noqa: BLE001
            LOG.exception("earlier receipt of run %s not read", result.run_id)
        steps = (
            ("runs", begun, runs),
            ("quality_metrics", result.started_at, lambda: P.gate_history(self.spark, result.gates)),
            ("gates", result.started_at, lambda: P.as_rows(self.spark, result.gates)),
        )
        for name, day, rows in steps:
            try:
                self.tables.write_ops(rows(), name, day.date(), result.run_id)
            except Exception:  # noqa: BLE001
                LOG.exception("receipt %s of run %s not written", name, result.run_id)


def run_landing(
    runner: LayeredRun, path: str | Sequence[str], run_ts: dt.datetime, names: Sequence[str] | None = None,
    run_id: str | None = None,
) -> P.RunResult:
    """A run over landed payloads of the wanted entities. Failed payloads are set aside
    with their reason; the run goes on with the rest."""
    run_id = run_id or P.new_run_id()
    wanted = landing.for_entities(landing.read_landing(runner.spark, path), names)
    good, bad = landing.split_payloads(wanted)
    failed = bad.select(F.to_json(F.struct(*wanted.columns)).alias("record"), "reason")
    folder = lake.batch_path(runner.tables.root, "failed_payloads", run_ts, run_id)
    lake.write_batch(failed, f"{folder}/attempt={P.new_run_id()}")
    return runner.run(landing.flatten(good, run_ts), run_ts, run_id, names)


def published(
    spark: SparkSession, tables: Tables, layer: str, schema: T.StructType,
    first: dt.date | None = None, last: dt.date | None = None,
) -> DataFrame:
    """Rows of a layer's published batches between two run dates.

    The lineage table names the folders to read, one per batch; all of them are one scan.
    """
    return read_folders(spark, published_keys(spark, tables, layer, first, last), schema)


def published_keys(
    spark: SparkSession, tables: Tables, layer: str, first: dt.date | None = None, last: dt.date | None = None
) -> list[str]:
    """The folders of a layer's published batches between two run dates: as many as there are batches."""
    listed = tables.read_ops(spark, "lineage", first, last).filter((F.col("layer") == layer) & (F.col("record_count") > 0))
    return sorted(r["key"] for r in listed.select("key").collect())


def read_folders(spark: SparkSession, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def latest_published(spark: SparkSession, tables: Tables, layer: str) -> str | None:
    """Folder of the newest published batch of a layer, None when there is none."""
    listed = tables.read_ops(spark, "lineage").filter(F.col("layer") == layer)
    newest = F.max_by("key", F.struct("published_at", "written_at", "run_id"))
    return listed.agg(newest.alias("key")).collect()[0]["key"]


def validate_latest(
    spark: SparkSession, tables: Tables, layer: str, schema: T.StructType, run_ts: dt.datetime,
    spec: TableSpec = WEATHER, mode: str = BLOCK,
) -> tuple[int, GateResult | None]:
    """Gate of a layer over its newest batch: exit code 0 when it passes or there is none."""
    path = latest_published(spark, tables, layer)
    if path is None:
        return 0, None
    batch = read_or_empty(spark, path, schema)  # a batch of rejects only has no folder of valid rows
    verdict = layer_gate(layer, mode, "", spec).evaluate(batch, layer, run_ts)
    return (0 if verdict.passed else 1), verdict


def weather_daily(served: DataFrame) -> DataFrame:
    """Rows of the daily serving table from served weather observations."""
    return S.daily_serving_rows(served, WEATHER.entity, serving.SERVED_TIME)


WEATHER_AGGREGATES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "daily": S.daily_statistics,
    "stats": S.city_statistics,
}

