"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..sources.workspace import scratch, setting

#: Text bytes handled at once inside a task: bounds memory whatever the batch of the engine holds.
SLICE_BYTES = 2 << 20
#: Rows sent to a Python worker at once while a frame is staged.
BATCH_ROWS = 1_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again: computed once, lineage cut,
    and safe against lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    least = min(int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")), BATCH_ROWS)
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(least)):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose texts sum to about SLICE_BYTES."""
    start, size = 0, 0
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    for i, length in enumerate(lengths):
        if size and size + length > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += length
    if start < batch.num_rows:
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()


def package_file(path: str) -> bytes:
    """A small model file, read on the driver and sent to the tasks."""
    size = os.path.getsize(path)
    if size > 64 << 20:
        raise ValueError(f"{path}: {size} bytes is too large to send with every task")
    with open(path, "rb") as file:
        return file.read()


def ddl(df: DataFrame, columns: Sequence[str]) -> str:
    """The named columns as a schema text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema)


def map_texts(
    docs: DataFrame, columns: Sequence[str], keep: Sequence[str], fields: str, types: dict[str, pa.DataType],
    make: Callable[[], Callable[..., tuple]],
) -> DataFrame:
    """A narrow pass over texts: ``columns`` (the text first) are the arguments of a function that gives
    the values of the new ``fields``; ``keep`` columns pass through. ``make`` is called once per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, 0):
                found = [work(*row) for row in zip(*(c.to_pylist() for c in part.columns[: len(columns)]))]
                new = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(types.values())]
                yield pa.RecordBatch.from_arrays([*part.columns[len(columns):], *new], [*keep, *types])

    named = [F.col(c).alias(f"_{i}") for i, c in enumerate(columns)]
    schema = ", ".join(x for x in (ddl(docs, keep) if keep else "", fields) if x)
    return docs.select(*named, *keep).mapInArrow(run, schema)
