"""Streams whose micro-batches are judged against what came before: repeated keys, closed days, late rows.

A micro-batch is written once, to a folder of its id, and what it decides is noted in a ledger with a row per
batch. A batch that is repeated after a failure finds the ledger as it was and replaces its own folders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from .. import fixed_values as fixed
from ..operators import rules as R
from ..operators.gates import BLOCK, Gate, GateResult
from ..operators.partials import DailyState
from ..sources.workspace import read_or_empty
from .ingest import started, utc_now

#: Arrival of a row: the moment of its micro-batch, the same when the batch is repeated.
ARRIVALS = "_arrivals"
_LEDGER = "batch bigint, arrival timestamp"
_MARKS = "batch bigint, mark timestamp"


# --- uniqueness across micro-batches --------------------------------------------------------


def repeats_published(key: Sequence[str], ledger: DataFrame) -> R.FrameRule:
    """Keys that came twice in a batch, or came before in a batch of the ledger; any is critical."""
    shown = "[" + ", ".join(f"'{c}'" for c in key) + "]"

    def issues(df: DataFrame) -> DataFrame:
        repeated = df.filter(F.size(ARRIVALS) > 1).withColumn("_now", F.array_max(ARRIVALS))
        # few rows are repeated; the ledger has a row per batch
        each = repeated.select(*key, "_now", F.explode(ARRIVALS).alias("arrival"), F.size(F.filter(ARRIVALS, lambda a: a == F.col("_now"))).alias("_held"))
        known = ledger.select("arrival", F.lit(True).alias("_published")).distinct()
        hit = each.join(F.broadcast(known), "arrival", "left").filter(
            (F.col("_held") > 1) | (F.col("_published") & (F.col("arrival") < F.col("_now"))))
        once = hit.select(*key).distinct()
        as_text = F.concat(F.lit("["), F.array_join(F.array(*[F.col(c).cast("string") for c in key]), ", ", "null"), F.lit("]"))
        counted = R.leading(once.withColumn("_shown", as_text), list(key), fixed.SAMPLE_SIZE).agg(
            F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.when(F.col("_leads"), F.col("_shown")))).alias("_held"))
        text = F.format_string(f"Compound key {shown} repeats %d published or own value(s)", F.col("n"))
        details = {"columns": ",".join(key), "sample_duplicates": F.array_join(F.slice("_held", 1, fixed.SAMPLE_SIZE), ", ")}
        found = R.issue("stream_unique", "critical", text, F.col("n"), details)
        return counted.filter("n > 0").select(found.alias("i")).select("i.*")

    return R.FrameRule("stream_unique", issues, {"columns": ",".join(key)})


def unique_batches(
    stream: DataFrame, key: Sequence[str], event_time: str, lateness: str, target: str, checkpoint: str,
    clock: dt.datetime | Callable[[], dt.datetime] = utc_now, on_verdict: Callable[[int, GateResult], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish micro-batches whose keys no published batch has had before.

    The keys are state of the stream: each holds the arrivals it has had, and leaves when the watermark has passed
    its event time, which is part of the key. A batch with a key that it holds twice, or that came in a published
    batch, is vetoed whole; one that repeats keys of a vetoed batch is not, so a batch can be delivered
    again in order. ``published_batches`` reads what was published. Rows behind the watermark are
    dropped by the state; ``closed_days`` sets such rows aside.
    """
    if event_time not in key:
        raise ValueError("the event time must be part of the key, or keys would be kept for ever")
    columns = stream.columns
    ledger_path = f"{target}/published"
    seen = (
        stream.withColumn("_arrival", F.current_timestamp()).withWatermark(event_time, lateness).groupBy(*key)
        .agg(F.collect_list("_arrival").alias(ARRIVALS), F.max_by(F.struct(*columns), "_arrival").alias("_row"))
        .select("_row.*", ARRIVALS)
    )
    schema = seen.schema

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = clock() if callable(clock) else clock
        path = f"{target}/rows/batch={batch_id}/rejected=false"
        batch.write.mode("overwrite").parquet(path)  # the state is read once
        stored = spark.read.schema(schema).parquet(path)
        ledger = read_or_empty(spark, ledger_path, _LEDGER, recursiveFileLookup=True).filter(F.col("batch") < batch_id)
        verdict = Gate("stream_unique_gate", BLOCK, str(batch_id), [repeats_published(key, ledger)]).evaluate(stored, "silver", now)
        if on_verdict is not None:
            on_verdict(batch_id, verdict)
        if verdict.passed and verdict.metrics[R.TOTAL]:  # a batch without rows only moves the watermark
            named = stored.agg(F.max(F.array_max(ARRIVALS)).alias("arrival")).select(F.lit(batch_id).cast("bigint").alias("batch"), "arrival")
            named.coalesce(1).write.mode("overwrite").parquet(f"{ledger_path}/{batch_id}")

    return started(seen.writeStream.outputMode("update").foreachBatch(publish), checkpoint, trigger)


# --- closed days and late rows --------------------------------------------------------------


def closed_days(
    stream: DataFrame, state: DailyState, lateness: dt.timedelta, target: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Daily statistics that are emitted once, when the watermark has passed the end of their day.

    The watermark of a batch is the latest event time of the batches before it less ``lateness``. A row whose day had
    ended by then is late: it goes to ``target``/late and changes nothing. Others add to ``state``, a row per group
    and day, which is all that is kept of an open day. After the batch, the days that its own watermark closes are finalised
    and appended to ``target``/closed. Rows without a moment count as late.
    """
    moment = state.event_time

    def mark_before(spark: SparkSession, batch_id: int) -> dt.datetime | None:
        marks = read_or_empty(spark, f"{target}/marks", _MARKS, recursiveFileLookup=True)
        micros = marks.filter(F.col("batch") < batch_id).agg(F.max(F.unix_micros("mark"))).collect()[0][0]
        return None if micros is None else dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=micros)

    def end_of_closed(mark: dt.datetime | None) -> dt.date | None:
        """The last day that has ended at a watermark."""
        return None if mark is None else (mark - lateness).date() - dt.timedelta(days=1)

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = mark_before(spark, batch_id)
        last_closed = end_of_closed(before)
        day = F.to_date(moment)
        late = day.isNull() if last_closed is None else day.isNull() | (day <= F.lit(last_closed))
        path = f"{target}/batches/batch={batch_id}"
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(path)
        stored = spark.read.schema(T.StructType([*batch.schema, T.StructField("late", T.BooleanType())])).parquet(path)
        on_time = stored.filter("not late").drop("late")
        state.load(on_time, f"batch-{batch_id}")
        micros = on_time.agg(F.max(F.unix_micros(F.col(moment).cast("timestamp")))).collect()[0][0]
        epoch = dt.datetime.fromtimestamp(0, dt.timezone.utc)
        mark = max((m for m in (before, None if micros is None else epoch + dt.timedelta(microseconds=micros)) if m is not None), default=None)
        if mark is None:
            return
        first = None if last_closed is None else last_closed + dt.timedelta(days=1)
        states = state.read(spark, first, end_of_closed(mark))
        state.finalised(states).write.mode("overwrite").parquet(f"{target}/closed/batch={batch_id}")
        named = spark.range(0, 1, 1, 1).select(F.lit(batch_id).cast("bigint").alias("batch"), F.lit(mark).alias("mark"))
        named.write.mode("overwrite").parquet(f"{target}/marks/{batch_id}")

    return started(stream.writeStream.foreachBatch(add), checkpoint, trigger)


def emitted_days(spark: SparkSession, target: str, state: DailyState) -> DataFrame:
    """The finalised rows of all closed days: each group and day once."""
    schema = state.finalised(state.read(spark)).schema
    return read_or_empty(spark, f"{target}/closed", T.StructType([*schema, T.StructField("batch", T.LongType())])).drop("batch")


def late_rows(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows that came after their day was closed, with the batch that brought them."""
    whole = T.StructType([*schema, T.StructField("batch", T.LongType()), T.StructField("late", T.BooleanType())])
    return read_or_empty(spark, f"{target}/batches", whole).filter("late").drop("late")
