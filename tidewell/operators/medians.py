"""Exact medians per group, whatever the size of a group.

The built-in ``median`` keeps all distinct values of a group in one task. It serves the
groups that are known to be small. For a larger group a mergeable quantile sketch brackets
the median, every value outside the bracket is folded into one "below" or "above" count
before the shuffle, and only the few distinct values inside the bracket are ranked. Ranks
are exact counts; a group whose median should fall outside its bracket is found by those
counts and ranked without a bracket. Brackets and medians of the large groups, one row per
group, are checkpointed: they are used several times and cost a scan each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.workspace import checkpointed
from .keyed_join import BROADCAST_BYTES, BROADCAST_ROWS, attach, has_at_most, orphans, survivors

EXACT_GROUP_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000
BINS = 4_096
STATISTICS_BYTES = 64
_KEY = "_group"


@dataclass(frozen=True)
class GroupSizes:
    """How many groups there are, how many rows the largest and the smallest one have, how wide keys are."""

    groups: int
    largest: int
    smallest: int = 0
    widest: int = 0
    counts: DataFrame | None = None
    listed: dict[int, DataFrame] = field(default_factory=dict)

    def fits_broadcast(self, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
        """Whether one row of statistics per group is small enough to broadcast."""
        return self.groups <= rows and self.groups * (self.widest + STATISTICS_BYTES) <= size

    def larger_than(self, rows: int) -> DataFrame:
        """Keys of the groups with more rows; at most one per ``rows`` rows of the table."""
        if rows not in self.listed:
            self.listed[rows] = checkpointed(self.counts.filter(F.col("_n") > rows).drop("_n"))
        return self.listed[rows]


def group_sizes(df: DataFrame, keys: Sequence[str]) -> GroupSizes:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    width = F.octet_length(F.to_json(F.struct(*keys)))
    row = counts.agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.max("_n"), F.lit(0)).alias("largest"),
        F.coalesce(F.min("_n"), F.lit(0)).alias("smallest"),
        F.coalesce(F.max(width), F.lit(0)).alias("widest"),
    ).collect()[0]
    return GroupSizes(**row.asDict(), counts=counts)


def grouped_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sizes: GroupSizes,
    *,
    name: str = "median",
    carry: Sequence[str] = (),
    exact_rows: int = EXACT_GROUP_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Median and row count ``n`` of the present values of each group.

    A group without present values has ``n`` 0 and no median; NULL is a key like any other.
    Both hold for groups of any size. ``carry`` names columns that are constant within a
    group and are kept.
    """
    keys, carry = list(keys), list(carry)
    slim = df.select(*keys, value, *carry)
    if sizes.largest <= exact_rows:
        return _plain_median(slim, keys, value, name, carry)
    # a key in a struct is never NULL itself, so that joins find the group of the NULL key
    held = slim.select(F.struct(*keys).alias(_KEY), value, *carry)
    large = sizes.larger_than(exact_rows).select(F.struct(*keys).alias(_KEY))
    small = sizes.fits_broadcast()
    ranked = _bracketed_median(survivors(held, large, [_KEY], small=small), value, name, carry, accuracy, small)
    ranked = ranked.select(*[F.col(_KEY)[k].alias(k) for k in keys], "n", name, *carry)
    if sizes.smallest > exact_rows:
        return ranked
    rest = orphans(held, large, [_KEY], small=small).select(*[F.col(_KEY)[k].alias(k) for k in keys], value, *carry)
    return _plain_median(rest, keys, value, name, carry).unionByName(ranked)


def _plain_median(df: DataFrame, keys: list[str], value: str, name: str, carry: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.median(value).alias(name), *[F.first(c).alias(c) for c in carry]
    )


def _bracketed_median(
    df: DataFrame, value: str, name: str, carry: list[str], accuracy: int, small: bool
) -> DataFrame:
    margin = 4.0 / accuracy
    ends = F.percentile_approx(
        value, F.array(F.lit(0.5 - margin), F.lit(0.5 + margin)), F.lit(accuracy)
    )
    sketched = checkpointed(
        df.groupBy(_KEY).agg(
            F.count(value).alias("n"),
            ends.alias("_ends"),
            F.min(value).alias("_min"),
            F.max(value).alias("_max"),
            *[F.first(c).alias(c) for c in carry],
        )
    )
    held = [_KEY, "n", *carry]
    rows = df.filter(F.col(value).isNotNull()).select(_KEY, F.col(value).alias("_x"))
    narrow = sketched.filter("n > 0").select(*held, F.col("_ends")[0].alias("_low"), F.col("_ends")[1].alias("_high"))
    found = checkpointed(_pick(_counted(rows, narrow, carry, small), name, carry))
    empty = sketched.filter("n = 0").select(_KEY, "n", F.lit(None).cast(found.schema[name].dataType).alias(name), *carry)
    # The sketch's error bound keeps the middle ranks inside the bracket, so nothing is
    # missed; the ranks are checked all the same, and a missed group is counted whole.
    done = found.filter(F.col(name).isNotNull())
    missed = sketched.filter("n > 0").join(done, _KEY, "left_anti")
    if has_at_most(missed, 0):
        return done.unionByName(empty)
    whole = missed.select(*held, F.col("_min").alias("_low"), F.col("_max").alias("_high"))
    return done.unionByName(_pick(_counted(rows, whole, carry, small), name, carry)).unionByName(empty)


def _counted(rows: DataFrame, brackets: DataFrame, carry: list[str], small: bool) -> DataFrame:
    """Counts of the distinct values inside the bracket of each group, and one count each
    for all values below and above it. The counts are combined before the shuffle."""
    x, low, high = F.col("_x"), F.col("_low"), F.col("_high")
    part = F.when(x < low, -1).when(x > high, 1).otherwise(0)
    bracketed = attach(rows, brackets, [_KEY], small=small).filter("n is not null").withColumn("_part", part)
    inside = F.col("_part") == 0
    position = F.floor((x - low) / (high - low) * BINS)
    return bracketed.groupBy(
        _KEY,
        "_part",
        F.when(inside & (high > low), position).otherwise(F.lit(0)).alias("_bin"),
        F.when(inside, x).alias("_x"),
    ).agg(
        F.count(F.lit(1)).alias("_c"), F.first("n").alias("n"), *[F.first(c).alias(c) for c in carry]
    )


def _running(keys: Sequence[str], *order: str):
    """Running total within a group, in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return F.sum("_c").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _pick(counted: DataFrame, name: str, carry: list[str]) -> DataFrame:
    """Middle value of each group from the counts of its distinct values.

    The lower middle has rank floor((n+1)/2), the upper one floor(n/2)+1. Values are first
    counted in BINS equal slices of the bracket; only the one or two slices that hold a
    middle rank are then ranked value by value, each on its own.
    """
    ranks = {"_lower": F.floor((F.col("n") + 1) / 2), "_upper": F.floor(F.col("n") / 2) + 1}

    def covers(rank: Column) -> Column:
        return (F.col("_upto") - F.col("_c") < rank) & (F.col("_upto") >= rank)

    slices = (
        counted.groupBy(_KEY, "_part", "_bin")
        .agg(F.sum("_c").alias("_c"), F.first("n").alias("n"))
        .withColumn("_upto", _running([_KEY], "_part", "_bin"))
        .filter((F.col("_part") == 0) & (covers(ranks["_lower"]) | covers(ranks["_upper"])))
        .select(_KEY, "_bin", (F.col("_upto") - F.col("_c")).alias("_before"))
    )
    inside = counted.filter("_part = 0").join(slices, [_KEY, "_bin"])
    ranked = inside.withColumn("_upto", F.col("_before") + _running([_KEY, "_bin"], "_x"))
    picked = ranked.groupBy(_KEY).agg(
        F.first("n").alias("n"),
        *[F.max(F.when(covers(rank), F.col("_x"))).alias(end) for end, rank in ranks.items()],
        *[F.first(c).alias(c) for c in carry],
    )
    middle = (F.col("_lower") + F.col("_upper")) / 2
    return picked.select(_KEY, "n", middle.alias(name), *carry)
