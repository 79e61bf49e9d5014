"""Daily statistics kept up to date: partial states per group and day that batches add to.

A state holds what count, mean, deviation, minimum and maximum are made of. States of disjoint rows add up, so
a batch of new rows appends one row per group and day that it touches and reads nothing of what is there.
A batch that delivers known keys again corrects values; a minimum cannot be taken back, so the groups and
days of such keys are stated anew from their rows. Such a whole state stands for everything before it. Sums
are kept in whole units of the last digit and are exact, in whatever order batches arrive.

Readers take the newest whole state of each group and day and add the later ones. One writer works on a table at a
time, as on the serving table; compaction may run beside it.
"""

from __future__ import annotations

import datetime as dt
import re
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import numeric as N
from ..sources import lake
from ..sources.workspace import checkpointed, read_or_empty, scratch
from .merge import require_unique, upsert

DAY, SEQUENCE, WHOLE, ROWS = "date", "sequence", "whole", "n"
_EXACT = "decimal(38,0)"
_NAME = re.compile(r"[A-Za-z0-9._-]+")
#: Days of a batch that are listed in a filter; beyond, their first and last bound it.
LISTED_DAYS = 1_000


@dataclass(frozen=True)
class DailyState:
    """A table of states below ``path``.

    ``keys`` (names and types) are its groups; ``measures`` maps columns to their number of decimals. Rows
    without a moment or group belong to no state; an absent value is not counted in its measure.
    """

    path: str
    keys: str
    event_time: str
    measures: dict[str, int]

    @property
    def groups(self) -> list[str]:
        return [part.split()[0].strip("`") for part in self.keys.split(", ")]

    @property
    def _fields(self) -> dict[str, str]:
        kinds = {"count": "bigint", "sum": _EXACT, "squares": _EXACT, "min": "double", "max": "double"}
        return {ROWS: "bigint"} | {f"{m}_{part}": kind for m in self.measures for part, kind in kinds.items()}

    @property
    def ddl(self) -> str:
        fields = ", ".join(f"`{n}` {k}" for n, k in self._fields.items())
        return f"{self.keys}, {fields}, {SEQUENCE} bigint, {WHOLE} boolean, {DAY} date, batch string"

    # --- writing ----------------------------------------------------------------

    def states(self, df: DataFrame) -> DataFrame:
        """One state per group and UTC day of the rows. Combined before the shuffle."""
        present = df.dropna(subset=[self.event_time, *self.groups]).withColumn(DAY, F.to_date(self.event_time))
        parts = [F.count(F.lit(1)).alias(ROWS)]
        for name, digits in self.measures.items():
            value, units = F.col(name).cast("double"), N.fixed_point(F.col(name), digits).cast(_EXACT)
            parts += [
                F.count(name).alias(f"{name}_count"), F.sum(units).cast(_EXACT).alias(f"{name}_sum"),
                F.sum((units * units).cast(_EXACT)).cast(_EXACT).alias(f"{name}_squares"),
                F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max"),
            ]
        return present.groupBy(*self.groups, DAY).agg(*parts)

    def load(
        self, delta: DataFrame, batch: str, row_key: Sequence[str] = (), earlier: DataFrame | None = None,
        updates: Sequence[str] | None = None,
    ) -> list[dt.date]:
        """Add a batch; returns the days it touched.

        ``earlier`` holds the rows known before (nothing, if it is None) and ``row_key`` names a row in it: keys of the
        batch that are known change in ``updates`` (default: all other columns), and the groups and days that
        their old or new version lies in are stated anew. A batch repeated under its name, ``earlier`` being what
        it was, replaces its states.
        """
        if not row_key and earlier is not None:
            raise ValueError("rows known before need a key to be found by")
        added = self.states(delta)
        days = _days(delta, self.event_time)
        found = added.withColumn(WHOLE, F.lit(False))
        if earlier is not None:
            require_unique(delta, row_key)
            columns = [*dict.fromkeys([*row_key, *self.groups, self.event_time, *self.measures])]
            held = earlier.select(*columns)
            again = held.join(delta.select(*row_key), list(row_key), "left_semi")
            moved = again.unionByName(delta.select(*columns).join(held.select(*row_key), list(row_key), "left_semi"))
            # one row per group and day: the join below is between states, not rows
            stale = moved.dropna(subset=[self.event_time, *self.groups]).select(*self.groups, F.to_date(self.event_time).alias(DAY)).distinct()
            stale = checkpointed(stale)  # used several times
            known_days = _days(moved, self.event_time)
            days = sorted({*days, *known_days})
            if known_days:
                near = _within(held, self.event_time, known_days).unionByName(again).dropDuplicates(list(row_key))
                taken = None if updates is None else [c for c in updates if c in columns]
                after = self.states(upsert(near, delta.select(*columns), row_key, taken))
                place = [*self.groups, DAY]
                anew = checkpointed(after.join(stale, place, "left_semi").withColumn(WHOLE, F.lit(True)))
                # a group and day that all its rows have left is stated as empty
                empty = {n: F.lit(0 if n == ROWS or n.endswith("_count") else None).cast(k) for n, k in self._fields.items()}
                gone = stale.join(anew.select(*place), place, "left_anti").withColumns({**empty, WHOLE: F.lit(True)})
                found = found.join(stale, place, "left_anti").unionByName(anew).unionByName(gone)
        self._write(found, batch)
        return days

    def _write(self, states: DataFrame, batch: str, sequence: Column | None = None) -> None:
        if not _NAME.fullmatch(batch):
            raise ValueError(f"Not a name of a batch: {batch!r}")
        place = F.lit(time.time_ns()) if sequence is None else sequence
        rows = states.withColumn(SEQUENCE, place).withColumn("batch", F.lit(batch))
        names = [f.name for f in rows.schema if f.name not in (DAY, "batch")]
        (
            rows.select(*names, DAY, "batch").hint("rebalance", DAY)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, "batch").parquet(self.path)
        )

    def compact(self, spark: SparkSession, batch: str, first: dt.date | None = None, last: dt.date | None = None) -> int:
        """State every group and day between two dates once, and remove the folders this replaces; returns their number."""
        old = self._rows(spark, first, last)
        listed = checkpointed(old.select(DAY, "batch").distinct())
        folders = [f"{self.path}/{DAY}={r[DAY]}/batch={r['batch']}" for r in listed.collect()]  # names only
        if not folders:
            return 0
        # placed right after the last state it holds: a batch that is loaded meanwhile comes later
        self._write(self._merged(old, F.col("_last") + 1).withColumn(WHOLE, F.lit(True)), batch, F.col(SEQUENCE))
        lake.remove_folders(spark, folders)
        return len(folders)

    # --- reading ----------------------------------------------------------------

    def _rows(self, spark: SparkSession, first: dt.date | None, last: dt.date | None) -> DataFrame:
        rows = read_or_empty(spark, self.path, self.ddl)
        if first is not None:
            rows = rows.filter(F.col(DAY) >= F.lit(first))
        if last is not None:
            rows = rows.filter(F.col(DAY) <= F.lit(last))
        return rows

    def _merged(self, rows: DataFrame, sequence: Column | None = None) -> DataFrame:
        """One row per group and day. A group and day has as many states as batches touched it since it was stated whole
        or compacted; they are folded as a short list, which needs one shuffle."""
        place = F.struct(SEQUENCE, "batch").alias("place")
        state = F.struct(place, WHOLE, *self._fields)
        held = rows.groupBy(*self.groups, DAY).agg(F.collect_list(state).alias("_states"))
        last_whole = F.array_max(F.transform(F.filter("_states", lambda s: s[WHOLE]), lambda s: s["place"]))
        counted = held.withColumn("_from", last_whole).withColumn(
            "_states", F.filter("_states", lambda s: F.col("_from").isNull() | (s["place"] >= F.col("_from"))))
        folded = [self._fold(name).alias(name) for name in self._fields]
        if sequence is not None:
            counted = counted.withColumn("_last", F.array_max(F.transform("_states", lambda s: s["place"][SEQUENCE])))
            folded.append(sequence.alias(SEQUENCE))
        return counted.select(*self.groups, DAY, *folded).filter(F.col(ROWS) > 0)

    def _fold(self, name: str) -> Column:
        values = F.filter(F.transform("_states", lambda s: s[name]), lambda v: v.isNotNull())
        if name.endswith("_min"):
            return F.array_min(values)
        if name.endswith("_max"):
            return F.array_max(values)
        kind = self._fields[name]
        total = F.aggregate(values, F.lit(0).cast(kind), lambda a, v: (a + v).cast(kind))
        return total if kind == "bigint" else F.when(F.size(values) > 0, total)

    def read(self, spark: SparkSession, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """One state per group and day; states may be added up further, over days or groups."""
        return self._merged(self._rows(spark, first, last))

    def finalised(self, states: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
        """Rounded count, mean, deviation, minimum and maximum of each measure, per group and day or per ``by``.

        A group of one has no deviation.
        """
        if by is not None:
            sums = [F.sum(n).cast(k).alias(n) for n, k in self._fields.items() if not n.endswith(("_min", "_max"))]
            ends = [(F.min if n.endswith("_min") else F.max)(n).alias(n) for n in self._fields if n.endswith(("_min", "_max"))]
            states = states.groupBy(*by).agg(*sums, *ends)
        out = []
        for name, digits in self.measures.items():
            n, total, squares = F.col(f"{name}_count"), F.col(f"{name}_sum"), F.col(f"{name}_squares")
            unit = F.lit(float(10**digits))
            # n * squares - sum * sum is exact; both are below 38 digits for any count of readings
            spread = (n.cast("decimal(19,0)") * squares - total * total).cast("double")
            held = F.when(n > 1, F.sqrt(spread / (n.cast("double") * (n - 1).cast("double"))) / unit)
            out += [
                (F.rint(total.cast("double") / F.when(n > 0, n)) / unit).alias(f"{name}_mean"),
                N.round_even(held, digits).alias(f"{name}_std"), F.col(f"{name}_min"), F.col(f"{name}_max"), n,
            ]
        keys = list(by) if by is not None else [*self.groups, DAY]
        return states.select(*keys, ROWS, *out)


def _days(df: DataFrame, event_time: str) -> list[dt.date]:
    """The days of the rows; dates only reach the driver."""
    days = df.filter(F.col(event_time).isNotNull()).select(F.to_date(event_time).alias(DAY)).distinct()
    return sorted(r[DAY] for r in days.collect())


def _within(rows: DataFrame, event_time: str, days: Sequence[dt.date]) -> DataFrame:
    """Rows of some days; their first and last bound the scan."""
    moment, day = F.col(event_time), F.to_date(event_time)
    low, high = F.lit(min(days)).cast(rows.schema[event_time].dataType), F.lit(max(days) + dt.timedelta(days=1)).cast(rows.schema[event_time].dataType)
    bounded = rows.filter((moment >= low) & (moment < high))
    return bounded.filter(day.isin(list(days))) if len(days) <= LISTED_DAYS else bounded


def upsert_daily(rows: DataFrame, path: str, keys: Sequence[str], day: str = DAY) -> None:
    """Insert or update finished daily rows in a table partitioned by day, by ``keys`` and day. Only the days of
    the rows are read and rewritten, staged first."""
    spark = rows.sparkSession
    staged = scratch(spark, "daily-rows")
    rows.write.parquet(staged)
    delta = spark.read.schema(rows.schema).parquet(staged)
    require_unique(delta, [*keys, day])
    days = [r[day] for r in delta.select(day).distinct().collect()]
    if not days:
        return
    held = read_or_empty(spark, path, rows.schema).filter(F.col(day).isin(days))
    whole = scratch(spark, "daily-rows")
    upsert(held.select(*rows.columns), delta, [*keys, day]).write.parquet(whole)
    names = [c for c in rows.columns if c != day]
    (
        spark.read.schema(rows.schema).parquet(whole).select(*names, day).hint("rebalance", day)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    )
