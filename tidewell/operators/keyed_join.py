"""Joining rows to a table with one row per key, safe for hot keys.

A plain sort-merge join sends all rows of one key to one task. Here a side is broadcast
only after a check of its rows and bytes. Beyond it, the rows of the heaviest keys meet
their partner through a small broadcast and are scattered over the shuffle, while all other
keys take the shuffled join; by construction none of those holds more than 1/HEAVY_KEYS of
the rows, and none more than TASK_ROWS unless HEAVY_KEYS others do. Rows with a NULL key,
which have no partner, are scattered too.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F, types as T

from ..sources.workspace import checkpointed

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
HEAVY_KEYS = 1_000
TASK_ROWS = 100_000


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether a frame has at most this many rows; stops reading beyond them."""
    return len(df.select(F.lit(1).alias("one")).take(rows + 1)) <= rows


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a frame stays below both limits, from one pass: rows, and the bytes of their
    fields (those of texts and the like are added up, others have a fixed width)."""
    wide = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            wide = wide + F.coalesce(F.octet_length(column), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            wide = wide + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        else:
            wide = wide + 16
    found = df.agg(F.count(F.lit(1)).alias("n"), F.sum(wide).alias("bytes")).collect()[0]
    return found["n"] <= rows and (found["bytes"] or 0) <= size


def heavy_keys(rows: DataFrame, keys: Sequence[str], most: int = HEAVY_KEYS, task_rows: int = TASK_ROWS) -> DataFrame:
    """The keys with more rows than a task should get, and of those the ``most`` heaviest.

    Computed once and kept, as it is used several times. If ``most`` keys do not reach down to
    ``task_rows``, what remains is left to the adaptive splitting of skewed joins.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > task_rows)
    return checkpointed(counts.orderBy(F.desc("_rows"), *keys).limit(most).drop("_rows"))


def attach(
    rows: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    *,
    small: bool | None = None,
    heavy: int = HEAVY_KEYS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Left join of ``rows`` to ``per_key``, which has one row per key.

    ``small`` states the outcome of a size check made earlier; None makes the check here.
    Adds the columns of ``per_key``; they are NULL where a row has no partner.
    """
    keys = list(keys)
    added = [c for c in per_key.columns if c not in keys]
    if small is None:
        small = is_small(per_key)
    if small:
        return rows.join(F.broadcast(per_key), keys, "left")

    packed = per_key.select(*keys, F.struct(*added).alias("_near"))
    hot = heavy_keys(rows.select(*keys), keys, heavy, task_rows)
    if hot.isEmpty():
        return rows.join(per_key, keys, "left").select(*rows.columns, *added)
    # at most `heavy` rows, kept: the parents are read once for them and once for the rest;
    # a hot key without partner keeps its mark
    partners = packed.join(F.broadcast(hot), keys)
    no_partner = hot.withColumn("_near", F.lit(None).cast(packed.schema["_near"].dataType))
    marks = checkpointed(
        partners.unionByName(no_partner)
        .groupBy(*keys)
        .agg(F.first("_near", ignorenulls=True).alias("_near"), F.lit(True).alias("_hot"))
    )
    marked = rows.join(F.broadcast(marks), keys, "left")
    # The row and its input partition decide where a scattered row goes: copies of a row
    # spread as well, and a repeated task sends every row to the same place again.
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.spark_partition_id())
    keyless = reduce(or_, [F.col(k).isNull() for k in keys])
    salted = marked.withColumn(
        "_salt", F.when(F.col("_hot") | keyless, spread).otherwise(F.lit(0).cast("bigint"))
    )
    far = packed.withColumnRenamed("_near", "_far").withColumn("_salt", F.lit(0).cast("bigint"))
    joined = salted.join(far, [*keys, "_salt"], "left")
    partner = F.when(F.col("_hot"), F.col("_near")).otherwise(F.col("_far"))
    return joined.withColumn("_partner", partner).select(
        *rows.columns, *[F.col("_partner")[c].alias(c) for c in added]
    )


def with_parent_flag(
    rows: DataFrame, parents: DataFrame, keys: Sequence[str], flag: str = "has_parent",
    small: bool | None = None, **how
) -> DataFrame:
    """Rows with a flag that tells whether their key exists in ``parents``."""
    listed = parents.select(*keys)
    if small is None:
        small = is_small(listed)
    known = listed.distinct().withColumn("_known", F.lit(True))
    joined = attach(rows, known, keys, small=small, **how)
    return joined.withColumn(flag, F.coalesce(F.col("_known"), F.lit(False))).drop("_known")


def orphans(rows: DataFrame, parents: DataFrame, keys: Sequence[str], **how) -> DataFrame:
    """Rows without a parent, set aside before they are removed."""
    return with_parent_flag(rows, parents, keys, "_has", **how).filter(~F.col("_has")).drop("_has")


def survivors(rows: DataFrame, parents: DataFrame, keys: Sequence[str], **how) -> DataFrame:
    """Rows that keep their parent."""
    return with_parent_flag(rows, parents, keys, "_has", **how).filter("_has").drop("_has")


def cascade(rows: DataFrame, deleted: DataFrame, keys: Sequence[str], **how) -> DataFrame:
    """Rows left after their deleted parents took their children with them."""
    return orphans(rows, deleted, keys, **how)


def joined_to_parent(rows: DataFrame, parents: DataFrame, keys: Sequence[str], **how) -> DataFrame:
    """Inner join to a parent table with one row per key."""
    tagged = parents.withColumn("_matched", F.lit(True))
    return attach(rows, tagged, keys, **how).filter("_matched").drop("_matched")
