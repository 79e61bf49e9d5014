"""Micro-batches judged against earlier ones: repeated keys, closed days, late rows, repeated batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from samples import RUN_TS, rows
from tidewell.operators.partials import DailyState
from tidewell.streaming import ingest as I, watermarks as U

DDL = "id bigint, city string, ts timestamp, x double"
START = dt.datetime(2024, 3, 1)


def at(hours):
    return START + dt.timedelta(hours=hours)


@pytest.fixture
def deliver(spark, tmp_path):
    """Lands a batch and drives the stream over it."""

    def go(run, *batch, again=False):
        folder = tmp_path / "landing"
        if batch:
            spark.createDataFrame(batch, DDL).coalesce(1).write.mode("append").parquet(str(folder))
        if again:  # the stream forgets that it has ended its last batch
            ended = tmp_path / "checkpoint" / "commits"
            last = max(int(p.name) for p in ended.iterdir() if p.name.isdigit())
            for name in (f"{last}", f".{last}.crc"):
                (ended / name).unlink(missing_ok=True)
        run(I.file_stream(spark, str(folder), DDL), str(tmp_path / "checkpoint")).awaitTermination()

    return go


# --- keys ---------------------------------------------------------------------------------


def gate(spark, tmp_path, verdicts, lateness="30 days"):
    def note(batch, verdict):
        if verdict.metrics["total_records"]:  # batches without rows move the watermark only
            verdicts.append(verdict)

    def run(stream, checkpoint):
        return U.unique_batches(stream, ["city", "ts"], "ts", lateness, str(tmp_path / "out"), checkpoint, RUN_TS, note)

    return run


def ids(spark, tmp_path):
    return [i for (i,) in rows(I.published_batches(spark, str(tmp_path / "out"), DDL), "id")]


def test_a_key_repeated_two_batches_later(spark, tmp_path, deliver):
    verdicts = []
    run = gate(spark, tmp_path, verdicts)
    deliver(run, (1, "a", at(1), 1.0), (2, "b", at(1), 1.0))
    deliver(run, (3, "a", at(2), 1.0), (None, None, at(2), None))
    deliver(run, (4, "a", at(1), 9.0), (5, "c", at(3), 1.0))  # repeats the first batch: vetoed whole
    assert [v.status for v in verdicts] == ["passed", "passed", "blocked"]
    found = verdicts[2].issues[0]
    assert (found.rule_name, found.severity, found.affected_records, found.details["sample_duplicates"]) == (
        "stream_unique", "critical", 1, "[a, 2024-03-01 01:00:00]")
    assert sorted(ids(spark, tmp_path), key=repr) == [1, 2, 3, None]
    deliver(run, (5, "c", at(3), 1.0))  # a key of the vetoed batch may come again
    assert verdicts[3].passed and 5 in ids(spark, tmp_path)
    deliver(run, (6, "c", at(3), 1.0))
    assert verdicts[4].blocked and 6 not in ids(spark, tmp_path)


def test_a_key_twice_in_one_batch(spark, tmp_path, deliver):
    verdicts = []
    deliver(gate(spark, tmp_path, verdicts), (1, "a", at(1), 1.0), (2, "a", at(1), 2.0), (3, "b", at(1), 1.0))
    assert verdicts[0].blocked and verdicts[0].issues[0].affected_records == 1
    assert ids(spark, tmp_path) == []


def test_a_repeated_batch_is_no_repetition(spark, tmp_path, deliver):
    """A batch run again after a failure finds its own keys in the state and the ledger."""
    verdicts = []
    run = gate(spark, tmp_path, verdicts)
    deliver(run, (1, "a", at(2), 1.0))
    deliver(run, (2, "b", at(1), 1.0))
    deliver(run, again=True)
    assert [v.status for v in verdicts] == ["passed"] * 3 and ids(spark, tmp_path) == [1, 2]
    deliver(run, (3, "b", at(1), 1.0))
    assert verdicts[3].blocked


def test_keys_leave_the_state_behind_the_watermark(spark, tmp_path, deliver):
    with pytest.raises(ValueError):
        U.unique_batches(I.file_stream(spark, str(tmp_path), DDL), ["id"], "ts", "1 day", "x", "y")
    verdicts, sizes = [], []
    run = gate(spark, tmp_path, verdicts, "1 hour")

    def watched(stream, checkpoint):
        query = run(stream, checkpoint)
        query.awaitTermination()
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        return query

    for day in range(1, 5):
        deliver(watched, *[(i, f"c{i}", at(24 * day), 1.0) for i in range(20)])
    assert max(sizes) <= 40


# --- days ---------------------------------------------------------------------------------


def closing(spark, tmp_path, lateness=12):
    state = DailyState(str(tmp_path / "state"), "city string", "ts", {"x": 2})
    target = str(tmp_path / "out")
    run = lambda stream, checkpoint: U.closed_days(stream, state, dt.timedelta(hours=lateness), target, checkpoint)
    shown = lambda: rows(U.emitted_days(spark, target, state), F.dayofmonth("date").alias("d"), "city", "n", "x_mean")
    late = lambda: rows(U.late_rows(spark, target, spark.createDataFrame([], DDL).schema), "id")
    return run, shown, late


def test_days_close_once_and_late_rows_stand_aside(spark, tmp_path, deliver):
    run, closed, late = closing(spark, tmp_path)
    deliver(run, (1, "a", at(1), 1.0), (2, "b", at(5), 2.0), (3, "a", at(30), 5.0))
    assert (closed(), late()) == ([], [])  # the watermark is at 18 hours
    deliver(run, (4, "a", at(2), 3.0), (5, "a", at(40), 7.0))  # in time: day 1 closes with this batch
    assert (closed(), late()) == ([(1, "a", 2, 2.0), (1, "b", 1, 2.0)], [])
    deliver(run, (6, "a", at(3), 100.0), (7, "a", None, 1.0), (8, "a", at(61), 1.0))  # 6 comes too late
    assert late() == [(6,), (7,)]
    assert closed() == [(1, "a", 2, 2.0), (1, "b", 1, 2.0), (2, "a", 2, 6.0)]
    deliver(run, (9, None, at(200), 1.0))
    assert closed()[3:] == [(3, "a", 1, 1.0)] and late() == [(6,), (7,)]
    # every day is emitted once: nothing to compact
    folders = sorted(p.parent.name for p in (tmp_path / "out" / "closed").glob("batch=*/_SUCCESS"))
    assert folders == ["batch=0", "batch=1", "batch=2", "batch=3"]


def test_a_repeated_batch_closes_its_days_again(spark, tmp_path, deliver):
    run, closed, late = closing(spark, tmp_path)
    deliver(run, (1, "a", at(1), 1.0), (3, "a", at(30), 5.0))
    deliver(run, (4, "a", at(2), 3.0), (5, "a", at(40), 7.0))
    before = closed()
    deliver(run, again=True)
    assert closed() == before == [(1, "a", 2, 2.0)] and late() == []


def test_rows_without_moments_only(spark, tmp_path, deliver):
    run, closed, late = closing(spark, tmp_path)
    deliver(run, (1, "a", None, 1.0))
    assert (closed(), late()) == ([], [(1,)])
