"""States that batches add to: distinct sketches and daily statistics, against counting all rows."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from samples import rows
from tidewell.operators import partials as P, sketches as S

DDL = "id bigint, kind string, ts timestamp, x double"


def made(seed, count=300, days=6, first=0):
    draw = random.Random(seed)
    start = dt.datetime(2024, 3, 1)
    out = []
    for i in range(count):
        moment = start + dt.timedelta(days=draw.randrange(days), seconds=draw.randrange(86_400))
        kind = draw.choice(["a", "a", "a", "b", None]) if i % 40 else "lone"
        out.append((first + i, kind, None if i % 37 == 5 else moment, None if i % 11 == 3 else round(draw.uniform(-50, 50), 2)))
    return out


def brute(held):
    groups = defaultdict(list)
    for _, kind, moment, x in held:
        if kind is not None and moment is not None:
            groups[kind, moment.date()].append(x)
    out = []
    for (kind, day), xs in groups.items():
        units = [round(x * 100) for x in xs if x is not None]
        n, total = len(units), sum(units)
        spread = (n * sum(u * u for u in units) - total * total) / (n * (n - 1)) if n > 1 else None
        out.append((
            kind, day, len(xs), round(total / n) / 100 if n else None, None if spread is None else round(spread**0.5) / 100,
            min(units) / 100 if n else None, max(units) / 100 if n else None, n,
        ))
    return sorted(out, key=repr)


def state(tmp_path):
    return P.DailyState(str(tmp_path / "state"), "kind string", "ts", {"x": 2})


def test_disjoint_batches_add_up(spark, tmp_path):
    table, all_rows = state(tmp_path), []
    assert table.read(spark).count() == 0
    for number in range(4):
        batch = made(number, first=1000 * number)
        all_rows += batch
        table.load(spark.createDataFrame(batch, DDL).repartition(3), f"b{number}")
        assert rows(table.finalised(table.read(spark))) == brute(all_rows)
    window = table.read(spark, dt.date(2024, 3, 2), dt.date(2024, 3, 4))
    assert rows(table.finalised(window)) == [r for r in brute(all_rows) if 2 <= r[1].day <= 4]
    # adding rows reads nothing of what is there
    plan = table.states(spark.createDataFrame(made(1), DDL))._jdf.queryExecution().toString()
    assert str(tmp_path) not in plan


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    table, batch = state(tmp_path), made(1)
    for _ in range(3):
        table.load(spark.createDataFrame(batch, DDL), "same")
    assert rows(table.finalised(table.read(spark))) == brute(batch)
    with pytest.raises(ValueError):
        table.load(spark.createDataFrame(batch, DDL), "a/b")


@pytest.mark.parametrize("compacted", [False, True])
def test_corrections_are_stated_anew(spark, tmp_path, compacted):
    """Known keys move to other days, groups and values, some to none, and bring new rows with them."""
    table, held = state(tmp_path), {r[0]: r for r in made(1)}
    table.load(spark.createDataFrame(list(held.values()), DDL), "first")
    draw = random.Random(7)
    for step in range(3):
        changed = {}
        for key in draw.sample(sorted(held), 40):
            i, kind, moment, x = held[key]
            changed[key] = (
                i, draw.choice([kind, "b", None, "new"]), draw.choice([moment, moment and moment + dt.timedelta(days=step)]),
                draw.choice([x, None, -99.5]))
        fresh = {r[0]: r for r in made(20 + step, 50, first=10_000 * (step + 1))}
        delta = spark.createDataFrame([*changed.values(), *fresh.values()], DDL)
        table.load(delta, f"step{step}", ["id"], spark.createDataFrame(list(held.values()), DDL))
        held |= changed | fresh
        if compacted:
            assert table.compact(spark, f"compacted{step}") > 0
            folders = {p.name for p in (tmp_path / "state").glob("date=*/batch=*")}
            assert folders <= {f"batch=compacted{step}"}
        assert rows(table.finalised(table.read(spark))) == brute(held.values())


def test_a_group_that_all_rows_leave_is_gone(spark, tmp_path):
    table, day = state(tmp_path), dt.datetime(2024, 3, 1, 5)
    first = spark.createDataFrame([(1, "a", day, 1.0)], DDL)
    table.load(first, "one")
    table.load(spark.createDataFrame([(1, "b", day, 1.0)], DDL), "two", ["id"], first)
    assert rows(table.read(spark), "kind") == [("b",)]


def test_only_updates_change(spark, tmp_path):
    table, day = state(tmp_path), dt.datetime(2024, 3, 1, 5)
    first = spark.createDataFrame([(1, "a", day, 1.0)], DDL)
    table.load(first, "one")
    table.load(spark.createDataFrame([(1, "b", day, 7.0)], DDL), "two", ["id"], first, updates=["x", "ingested_at"])
    assert rows(table.finalised(table.read(spark)), "kind", "x_mean") == [("a", 7.0)]


def test_loads_refuse_what_they_cannot_find(spark, tmp_path):
    twice = spark.createDataFrame([(1, "a", dt.datetime(2024, 3, 1), 1.0)] * 2, DDL)
    with pytest.raises(ValueError):
        state(tmp_path).load(twice, "x", earlier=twice)
    with pytest.raises(Exception, match="duplicate"):
        state(tmp_path).load(twice, "x", ["id"], twice)


def test_compaction_beside_a_load(spark, tmp_path, monkeypatch):
    """A batch that arrives while states are compacted is not lost and not counted twice."""
    table = state(tmp_path)
    first, second = made(1), made(2, first=5000)
    table.load(spark.createDataFrame(first, DDL), "one")
    removed = P.lake.remove_folders

    def late(session, folders):
        table.load(spark.createDataFrame(second, DDL), "two")
        removed(session, folders)

    monkeypatch.setattr(P.lake, "remove_folders", late)
    table.compact(spark, "c")
    assert rows(table.finalised(table.read(spark))) == brute(first + second)


def test_daily_rows_are_upserted(spark, tmp_path):
    path, day = str(tmp_path / "served"), dt.date(2024, 3, 1)
    ddl = "kind string, n bigint, date date"
    P.upsert_daily(spark.createDataFrame([("a", 1, day), ("b", 2, day), ("a", 3, day + dt.timedelta(days=1))], ddl), path, ["kind"])
    P.upsert_daily(spark.createDataFrame([("a", 9, day), ("c", 4, day)], ddl), path, ["kind"])
    P.upsert_daily(spark.createDataFrame([], ddl), path, ["kind"])
    found = rows(spark.read.schema(ddl).parquet(path), "kind", "n", F.dayofmonth("date").alias("d"))
    assert found == [("a", 3, 2), ("a", 9, 1), ("b", 2, 1), ("c", 4, 1)]


# --- distinct sketches --------------------------------------------------------------------


def test_sketches_add_up_over_days_and_loads(spark, tmp_path):
    path, by = str(tmp_path / "sketches"), "kind string"
    first, second = made(1, 900), made(2, 900, days=9, first=500)
    for batch in (first, second, first):  # a repeated load changes nothing
        S.load_sketches(spark.createDataFrame(batch, DDL).repartition(4), path, ["id"], "ts", by)
    held = first + second
    for low, high in ((1, 3), (2, 9), (1, 31)):
        exact = defaultdict(set)
        for i, kind, moment, _ in held:
            if kind and moment and low <= moment.day <= high:
                exact[kind].add(i)
        found = dict(rows(S.distinct_between(spark, path, by, dt.date(2024, 3, low), dt.date(2024, 3, high))))
        assert found.keys() == exact.keys()
        for kind, values in exact.items():
            assert abs(found[kind] - len(values)) <= 3 * S.relative_error() * len(values) + 1


def test_error_bound_of_many_values(spark):
    days = spark.range(0, 200_000, 1, 4).withColumn("ts", F.timestamp_seconds(F.col("id") * 5))
    sketches = S.daily_sketches(days, ["id"], "ts")
    assert sketches.count() == 12
    found = S.estimated(S.merged(sketches)).first()[0]
    assert abs(found - 200_000) <= 3 * S.relative_error() * 200_000
    small = S.estimated(S.merged(S.daily_sketches(days, ["id"], "ts", lg_buckets=8)))
    assert abs(small.first()[0] - 200_000) <= 3 * S.relative_error(8) * 200_000


def test_what_is_counted(spark):
    df = spark.createDataFrame(
        [("a", 1, dt.datetime(2024, 3, 1)), ("a", 2, dt.datetime(2024, 3, 1)), (None, 1, dt.datetime(2024, 3, 1)), ("a", None, dt.datetime(2024, 3, 1)), ("b", 1, None)],
        "k string, n int, ts timestamp")
    assert S.estimated(S.daily_sketches(df, ["k"], "ts")).first()["distinct"] == 1
    assert S.estimated(S.daily_sketches(df, ["k", "n"], "ts")).first()["distinct"] == 2
    assert S.estimated(S.daily_sketches(df.withColumn("d", F.col("n") / 2), ["d"], "ts")).first()["distinct"] == 2
    assert rows(S.estimated(S.daily_sketches(df, ["n"], "ts", ["k"])), "k", "distinct") == [("a", 2)]


def test_empty_loads(spark, tmp_path):
    path = str(tmp_path / "none")
    S.load_sketches(spark.createDataFrame([], DDL), path, ["id"], "ts")
    assert S.distinct_between(spark, path).collect()[0][0] in (0, None)
    assert P.DailyState(path + "2", "kind string", "ts", {"x": 2}).load(spark.createDataFrame([], DDL), "e") == []
