"""Streams: file source, gated publication per micro-batch, daily statistics, dedup.

The batch semantics are unchanged. Percentages of a gate are those of its micro-batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions import numeric as N
from ..operators import cleaning as K
from ..operators.gates import GateResult
from ..operators.observed import write_observed
from ..plans.layers import layer_gate
from ..sources import lake
from ..sources.workspace import read_or_empty
from ..spec import TableSpec


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType | str, file_format: str = "parquet",
    glob: str | None = None, files_per_trigger: int | None = None,
) -> DataFrame:
    """New files of a landing folder as a stream."""
    reader = spark.readStream.schema(schema).format(file_format)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def with_event_time(df: DataFrame, column: str) -> DataFrame:
    """Zone-free moments as UTC timestamps, which watermarks require."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def deduplicated(df: DataFrame, key: Sequence[str], event_time: str, lateness: str) -> DataFrame:
    """First row of each key; state is dropped once the watermark has passed it."""
    return df.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(list(key))


def windowed_daily(
    df: DataFrame, entity: str, event_time: str, value: str, lateness: str, digits: int | None = None
) -> DataFrame:
    """Count, mean, minimum and maximum per entity and day window."""
    day = F.window(event_time, "1 day")
    grouped = df.withWatermark(event_time, lateness).groupBy(day, entity)
    return grouped.agg(
        F.count(F.lit(1)).alias("n"),
        N.mean(F.col(value), digits).alias(f"{value}_mean"),
        F.min(value).alias(f"{value}_min"),
        F.max(value).alias(f"{value}_max"),
    ).select(F.to_date("window.start").cast("string").alias("date"), entity, "n", f"{value}_mean", f"{value}_min", f"{value}_max")


def stale_reason(event_time: str, now: dt.datetime, max_age_hours: float) -> Column:
    return F.when(N.age_hours(F.col(event_time), now) > max_age_hours, F.lit("stale"))


def gated_batches(
    stream: DataFrame, spec: TableSpec, target: str, quarantine: str, checkpoint: str,
    clock: dt.datetime | Callable[[], dt.datetime] = utc_now, mode: str = "block", max_age_hours: float | None = None,
    on_verdict: Callable[[int, GateResult], None] | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Clean each micro-batch, gate it and publish it.

    A batch is written once, valid and rejected rows apart, to a folder of ``target`` named by its
    id; a batch that is repeated after a failure replaces its own. The measures of its gate are observed while it is written.
    A batch that passes is named in the list of published batches; ``published_batches`` reads
    those, so a vetoed one stays invisible. ``clock`` gives the moment of a batch, from which
    ages are measured; ``trigger`` is that of the stream (default: all that is there, then stop).
    """
    def publish(batch: DataFrame, batch_id: int) -> None:
        now = clock() if callable(clock) else clock
        reason = F.col(K.REASON)
        if max_age_hours is not None:
            reason = F.coalesce(reason, stale_reason(spec.event_time, now, max_age_hours))
        judged = K.clean_with_reason(batch, spec, now).withColumn(K.REASON, reason)
        flagged = judged.withColumn("rejected", F.col(K.REASON).isNotNull())
        gate, path = layer_gate("silver", mode, str(batch_id), spec), f"{target}/rows/batch={batch_id}"
        stored, seen, _ = write_observed(flagged, gate.rules, lambda df: lake.write_split(df, path, "rejected"), ~F.col("rejected"))
        rejects = stored.filter("rejected")
        record = F.coalesce(K.RECORD, F.to_json(F.struct(*[f.name for f in spec.fields])))
        kept = K.quarantine_rows(rejects.withColumn(K.RECORD, record), now)
        kept.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        valid = stored.filter("not rejected").select(*spec.clean_columns)
        verdict = gate.evaluate(valid, "silver", now, seen)
        if on_verdict is not None:
            on_verdict(batch_id, verdict)
        if verdict.passed:
            named = batch.sparkSession.range(1).select(F.lit(batch_id).cast("bigint").alias("batch"))
            named.write.mode("overwrite").parquet(f"{target}/published/{batch_id}")

    return started(stream.writeStream.foreachBatch(publish), checkpoint, trigger)


def published_batches(spark: SparkSession, target: str, schema: T.StructType | str) -> DataFrame:
    """Valid rows of the batches that passed their gate. The batches are partitions of the
    folder: one that did not pass is not read."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    passed = read_or_empty(spark, f"{target}/published", "batch bigint", recursiveFileLookup=True)
    listed = sorted(r["batch"] for r in passed.distinct().collect())  # a number per batch
    rows = read_or_empty(spark, f"{target}/rows", f"{ddl}, batch bigint, rejected boolean")
    return rows.filter(~F.col("rejected") & F.col("batch").isin(listed)).drop("batch", "rejected")


def run_to_table(
    stream: DataFrame, path: str, checkpoint: str, key: Sequence[str], trigger: dict | None = None
) -> StreamingQuery:
    """Keep the current row of each key of an aggregation (update mode): a micro-batch adds a
    folder with the rows that changed, and state behind the watermark is dropped.
    ``current_rows`` reads the newest row of each key."""

    def add(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return started(stream.writeStream.outputMode("update").foreachBatch(add), checkpoint, trigger)


def current_rows(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """The newest row of each key that ``run_to_table`` has written."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = spark.read.schema(f"{ddl}, batch bigint").parquet(path)
    newest = F.max_by(F.struct(*schema.fieldNames()), "batch").alias("_row")
    return rows.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(newest).select("_row.*")


def run_to_files(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Drive a stream into a parquet folder (append, exactly once)."""
    return started(stream.writeStream.outputMode("append").format("parquet").option("path", path), checkpoint, trigger)


def started(writer: DataStreamWriter, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
