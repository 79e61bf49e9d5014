"""Reproducible shuffle into shards: a keyed permutation over global row numbers.

Rows get gapless global numbers in an order that depends on their keys alone. A Feistel network
with cycle walking permutes 0 .. n-1; the image of a row says its shard (remainder) and its slot
(quotient), so shard sizes differ by one at most and the place of any number can be computed
without the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import staged

ROUNDS = 6
#: Rows numbered in one window, on average; and how many keys may be treated as heavy at most.
ROWS_PER_BUCKET, HEAVY_KEYS, HEAVY_PIECES = 20_000, 200, 256
#: Buckets whose counts are added up in one window.
BUCKETS_PER_GROUP = 10_000


def round_keys(seed: int) -> list[int]:
    state = np.random.default_rng(seed)
    return [int(k) for k in state.integers(0, 2**63, ROUNDS, dtype=np.int64)]


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """Round function: multiply and xor-shift, all modulo 2**64."""
    x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Image of each number of 0 .. n-1 under the permutation of 0 .. n-1 named by ``seed``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift, keys = np.uint64((1 << half) - 1), np.uint64(half), round_keys(seed)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for key in keys:
            left, right = right, left ^ (_mix(right, key) & mask)
        return (left << shift) | right

    out = once(np.asarray(numbers, np.uint64))
    # an image outside the range walks along its cycle until it comes back into it
    while (outside := out >= np.uint64(n)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def numbered(df: DataFrame, keys: Sequence[str], number: str = "row_number", carry: Sequence[str] = ()) -> DataFrame:
    """The key columns, and those to ``carry``, of every row with gapless global numbers from 0.

    The order is by a hash of the keys, then by the keys, so it does not depend on how the rows
    are stored. Rows equal in all keys are interchangeable; a key that holds more than its share
    of the rows is numbered in pieces. The counts of the buckets are added up in two steps, within groups of buckets
    and over the groups; the driver gets the number of rows and the hashes of heavy keys, fewer than HEAVY_KEYS.
    """
    spark = df.sparkSession
    columns = [*keys, *carry]
    narrow = staged(df.select(*columns, F.xxhash64(*keys).alias("_hash")), "row-keys")
    total = narrow.count()
    if total == 0:
        return narrow.select(*columns, F.lit(0).cast("bigint").alias(number))
    buckets = max(1, -(-total // ROWS_PER_BUCKET))
    heavy = [
        r["_hash"] for r in narrow.groupBy("_hash").count()
        .filter(F.col("count") > max(total // HEAVY_KEYS, ROWS_PER_BUCKET)).select("_hash").sort("_hash").collect()
    ]  # each holds over 1 / HEAVY_KEYS of the rows, so there are fewer than HEAVY_KEYS
    bucket = F.pmod("_hash", F.lit(buckets)).cast("int")
    for i, value in enumerate(heavy):
        bucket = F.when(F.col("_hash") == value, F.lit(buckets + i)).otherwise(bucket)
    place = narrow.select(*columns, "_hash", bucket.alias("_bucket")).withColumn(
        "_piece",
        F.when(F.col("_bucket") >= buckets, F.pmod(F.monotonically_increasing_id(), F.lit(HEAVY_PIECES))).otherwise(0).cast("int"),
    )
    if heavy:  # pieces follow the place of a row in the scan: fix them before they are counted
        place = staged(place, "row-pieces")
    counts = place.groupBy("_bucket", "_piece").agg(F.count("*").alias("_rows")).withColumn("_group", F.floor(F.col("_bucket") / BUCKETS_PER_GROUP))
    counts = staged(counts, "bucket-counts")
    groups = counts.groupBy("_group").agg(F.sum("_rows").alias("_rows"))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)  # a row for each group of buckets
    before = groups.select("_group", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    lower = Window.partitionBy("_group").orderBy("_bucket", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.withColumn("_inside", F.coalesce(F.sum("_rows").over(lower), F.lit(0)))
    offsets = inside.join(before, "_group").select("_bucket", "_piece", (F.col("_before") + F.col("_inside")).alias("_start"))
    within = Window.partitionBy("_bucket", "_piece").orderBy("_hash", *keys)
    return (
        place.withColumn("_rank", F.row_number().over(within))
        .join(offsets.hint("merge"), ["_bucket", "_piece"])  # a row for each bucket, which the window has brought together
        .select(*columns, (F.col("_start") + F.col("_rank") - 1).alias(number))
    )


def assign(df: DataFrame, keys: Sequence[str], shards: int, seed: int = 20_240_130, carry: Sequence[str] = ()) -> DataFrame:
    """(keys, carried columns, row_number, shard int, slot long) for every row of ``df``.

    Null keys sort first and are keys like any other; repeated rows get numbers of their own;
    an empty table gives an empty result. Other columns are left out; names that
    begin with an underscore are reserved.
    """
    if shards < 1 or any(k.startswith("_") or k in ("row_number", "shard", "slot") for k in (*keys, *carry)):
        raise ValueError("at least one shard, and no column named like a result column")
    rows = staged(numbered(df, keys, carry=carry), "row-numbers")
    total = rows.count()

    def images(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(permute(part.to_numpy(), total, seed))

    image = F.pandas_udf(images, "bigint")
    return rows.withColumn("_image", image("row_number")).select(
        *keys, *carry, "row_number", F.pmod("_image", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("_image") / shards).cast("bigint").alias("slot"),
    )


def locate(number: int, total: int, shards: int, seed: int = 20_240_130) -> tuple[int, int]:
    """(shard, slot) of one global row number, computed without the data."""
    image = int(permute(np.array([number]), total, seed)[0])
    return image % shards, image // shards


def write_shards(df: DataFrame, keys: Sequence[str], path: str, shards: int, seed: int = 20_240_130) -> None:
    """Whole rows as Parquet, a folder per shard with a column ``slot``, in slot order within each file.

    ``keys`` decide the order before the shuffle; rows that share their keys are interchangeable. The rows of a
    shard are spread over files by ranges of slots. Whole rows travel with their numbers, so no key is joined on, and one
    that holds a third of the rows is numbered in pieces. An input column called ``shard`` or ``slot`` is written
    under that name with an underscore at its end, or several. Repeated rows are all written; an empty table
    writes no row.
    """
    inner = [f"c{i}" for i in range(len(df.columns))]
    placed = assign(df.toDF(*inner), [inner[df.columns.index(k)] for k in keys], shards, seed, [c for c, n in zip(inner, df.columns) if n not in keys])
    names: list[str] = []
    for name in df.columns:
        while name in ("shard", "slot", *names):
            name += "_"
        names.append(name)
    rows = placed.select(*[F.col(c).alias(n) for c, n in zip(inner, names)], "shard", "slot")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
