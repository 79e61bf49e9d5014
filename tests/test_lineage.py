"""Traversal of the lineage, reprocessing along it, and the sweep of what nothing refers to."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from samples import RUN_TS, TURIN, rows
from tidewell.operators import cleaning as K
from tidewell.plans import lineage as L, medallion as W, retention as V
from tidewell.spec import WEATHER

DAY = dt.timedelta(days=1)
NOW = dt.timedelta(0)


@pytest.fixture
def runner(spark, tmp_path):
    return W.LayeredRun(spark, W.Tables(str(tmp_path / "lake")), WEATHER, "block")


@pytest.fixture
def reporting(runner):
    """A runner that publishes daily and entity statistics too."""
    runner.aggregates = W.WEATHER_AGGREGATES
    return runner


def schema(df):
    return K.clean(df, WEATHER, RUN_TS).schema


@pytest.mark.parametrize("seed", range(3))
def test_closure_by_brute_force(spark, seed):
    """Diamonds, circles, repeated edges and absent ends."""
    draw = random.Random(seed)
    nodes = [f"n{i}" for i in range(25)]
    edges = [(draw.choice(nodes), draw.choice(nodes)) for _ in range(40)] + [("n0", None), (None, "n1"), ("n3", "n3")]
    origins = ["n0", "n5", "outside", "n0"]
    want = set()
    for origin in set(origins):
        newest, depth, seen = {origin}, 0, set()
        while newest:
            want |= {(origin, n, depth) for n in newest}
            seen |= newest
            newest = {c for p, c in edges if p in newest and c is not None} - seen
            depth += 1
    found = L.closure(spark.createDataFrame(edges + edges[:5], "a string, b string"), spark.createDataFrame([(o,) for o in origins], "x string"))
    assert rows(found) == sorted(want, key=repr)
    assert L.closure(spark.createDataFrame([], "a string, b string"), spark.createDataFrame([], "x string")).count() == 0


def test_derived_folders_and_days(spark, reporting, raw):
    runner = reporting
    one = runner.run(raw({}, TURIN), RUN_TS, "one")
    runner.run(raw(dict(TURIN, timestamp="2024-01-29T12:00:00+00:00")), RUN_TS, "two")
    found = L.derived(spark, runner.tables, [runner.tables.batch("bronze", one)])
    assert rows(found, "layer", "depth", "current") == [
        ("bronze", 0, True), ("gold", 2, True), ("gold_daily", 2, True), ("gold_stats", 2, True), ("serving", 3, True), ("silver", 1, True)]
    assert rows(found.filter("layer = 'serving'"), F.col("day").cast("string")) == [("2024-01-30",)]
    assert L.derived(spark, runner.tables, ["nowhere"]).count() == 0
    assert L.derived(spark, runner.tables, []).count() == 0


def test_a_vetoed_run_derives_nothing_beyond_silver(spark, runner, raw):
    result = runner.run(raw({}, {}), RUN_TS, "doubled")
    found = L.derived(spark, runner.tables, [runner.tables.batch("bronze", result)])
    assert rows(found, "layer") == [("bronze",), ("silver",)]


def test_reprocessing_takes_the_place_of_what_was_derived(spark, runner, raw):
    one = runner.run(raw({}), RUN_TS, "one")
    runner.run(raw(TURIN), RUN_TS, "two")
    again = runner.reprocess_derived(raw({}).schema, RUN_TS + DAY, [runner.tables.batch("bronze", one)])
    assert [(r.run_id, r.status, r.records_ingested) for r in again] == [("one", "success", 1)]
    assert rows(W.published(spark, runner.tables, "silver", schema(raw({}))), "city") == [("Braga",), ("Turin",)]
    found = L.derived(spark, runner.tables, [runner.tables.batch("bronze", one)])
    assert rows(found.filter("layer = 'silver'"), "current") == [(False,), (True,)]
    # a second time along the same way; runs that read several bronze folders read all of them again
    both = runner.reprocess(raw({}).schema, RUN_TS + 2 * DAY, run_id="both")
    assert both.records_ingested == 2
    later = runner.reprocess_derived(raw({}).schema, RUN_TS + 3 * DAY, [runner.tables.batch("bronze", one)])
    assert sorted((r.run_id, r.records_ingested) for r in later) == [("both", 2), ("one", 1)]


# --- windows and the sweep ------------------------------------------------------------------


def test_windows_add_up(spark, runner, raw):
    """A run published on two days counts on the day of its newest attempt only."""
    for day, city in ((0, {}), (1, TURIN)):
        runner.run(raw(city), RUN_TS + day * DAY, "same")
    runner.run(raw({"city": "Oslo"}), RUN_TS, "other")
    days = [RUN_TS.date(), (RUN_TS + DAY).date()]
    held = [rows(W.published(spark, runner.tables, "gold", schema(raw({})), d, d), "city") for d in days]
    assert held == [[("Oslo",)], [("Turin",)]]
    assert rows(W.published(spark, runner.tables, "gold", schema(raw({}))), "city") == sorted(held[0] + held[1])


def attempts(tmp_path, layer):
    return len(list((tmp_path / "lake" / layer).glob("*/*/*/*/attempt=*")))


def test_sweep(spark, reporting, raw, tmp_path):
    runner = reporting
    old = RUN_TS - 50 * DAY
    runner.run(raw({}, {"temperature_celsius": "200"}), old, "old")
    for day, city in ((0, {}), (1, TURIN)):
        runner.run(raw(city), RUN_TS + day * DAY, "same")
    runner.run(raw(TURIN, TURIN), RUN_TS, "vetoed")
    keep = {"silver": 30, "gold": 30, "gold_stats": 400}
    names = ("bronze", "silver", "gold", "gold_stats")
    before = {n: rows(W.published(spark, runner.tables, n, spark.read.parquet(W.latest_published(spark, runner.tables, n)).schema, RUN_TS.date()), "city") for n in names}
    # files of today are within the grace period; rows go at once
    first = V.sweep(spark, runner.tables, RUN_TS, keep)
    assert (first.superseded_rows, first.expired_rows, first.folders) == (5, 2, ())
    second = V.sweep(spark, runner.tables, RUN_TS, keep, grace=NOW)
    assert (second.superseded_rows, second.expired_rows) == (0, 0)
    assert {n: attempts(tmp_path, n) for n in (*names, "gold_daily")} == {"bronze": 3, "silver": 2, "gold": 1, "gold_stats": 2, "gold_daily": 2}
    after = {n: rows(W.published(spark, runner.tables, n, spark.read.parquet(W.latest_published(spark, runner.tables, n)).schema, RUN_TS.date()), "city") for n in names}
    assert before == after
    # reading days whose batches are gone gives nothing, and does not fail
    assert W.published(spark, runner.tables, "silver", schema(raw({})), old.date(), old.date()).count() == 0
    assert rows(W.published(spark, runner.tables, "silver", schema(raw({}))), "city") == [("Turin",)] * 3
    assert V.sweep(spark, runner.tables, RUN_TS, keep, grace=NOW).folders == ()
    assert attempts(tmp_path, "quarantine") == 4
    V.sweep(spark, runner.tables, RUN_TS + 60 * DAY, {}, grace=NOW)
    assert attempts(tmp_path, "quarantine") == 3


@pytest.mark.parametrize("fails_at", [0, 1, 3])
def test_an_interrupted_sweep(spark, runner, raw, tmp_path, monkeypatch, fails_at):
    """Wherever a sweep stops, readers see the newest attempts, and the next sweep ends what it began."""
    runner.run(raw({}), RUN_TS - 50 * DAY, "same")
    runner.run(raw(TURIN), RUN_TS - 49 * DAY, "same")
    runner.run(raw({"city": "Oslo"}), RUN_TS, "other")
    keep = {"silver": 30, "gold": 30}
    removed, calls = V.lake.remove_folders, []

    def broken(session, folders):
        for folder in folders:
            if len(calls) == fails_at:
                raise OSError("storage is down")
            calls.append(folder)
            removed(session, [folder])

    monkeypatch.setattr(V.lake, "remove_folders", broken)
    with pytest.raises(OSError):
        V.sweep(spark, runner.tables, RUN_TS, keep, grace=NOW)
    seen = rows(W.published(spark, runner.tables, "gold", schema(raw({}))), "city")
    assert seen in ([("Oslo",)], [("Oslo",), ("Turin",)])  # never the attempt that was superseded
    monkeypatch.setattr(V.lake, "remove_folders", removed)
    V.sweep(spark, runner.tables, RUN_TS, keep, grace=NOW)
    assert rows(W.published(spark, runner.tables, "gold", schema(raw({}))), "city") == [("Oslo",)]
    assert (attempts(tmp_path, "gold"), attempts(tmp_path, "bronze")) == (1, 2)


def test_sweep_of_an_empty_lake(spark, runner, raw):
    runner.run(raw({}).limit(0), RUN_TS, "nothing")
    swept = V.sweep(spark, runner.tables, RUN_TS, {"gold": 1}, grace=NOW)
    assert swept.superseded_rows == 0 and len(swept.folders) == 1  # the folder of the failed attempt
