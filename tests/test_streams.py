"""Streams driven to their end."""

import datetime as dt

import pytest

from samples import TURIN, RUN_TS, rows
from tidewell.streaming import ingest as I
from tidewell.spec import WEATHER


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def test_gated_micro_batches(spark, raw, folder):
    raw({}, TURIN, {"city": "Oslo", "temperature_celsius": "200"}).coalesce(1).write.parquet(folder("in"))
    raw({"city": "Bern", "timestamp": "2024-01-01T00:00:00Z"}, {"city": "Kyiv"}).coalesce(1).write.mode("append").parquet(folder("in"))
    seen = []
    for _ in range(2):  # the second start finds nothing new
        stream = I.file_stream(spark, folder("in"), raw({}).schema, files_per_trigger=1)
        I.gated_batches(
            stream, WEATHER, folder("out"), folder("dead"), folder("state"), lambda: RUN_TS, max_age_hours=24,
            on_verdict=lambda i, v: seen.append((i, v.status, v.metrics["total_records"])),
        ).awaitTermination()
    assert sorted(seen, key=lambda s: s[0])[0][1] == "passed" and sum(s[2] for s in seen) == 3 and len(seen) == 2
    found = I.published_batches(spark, folder("out"), "city string")
    assert rows(found, "city") == [("Braga",), ("Kyiv",), ("Turin",)]
    dead = spark.read.schema("reason string").parquet(folder("dead") + "/batch=*")
    assert rows(dead, "reason") == [("stale",), ("temperature_celsius=200.0 outside range [-100, 100]",)]


def test_daily_windows_and_deduplication(spark, folder):
    start = dt.datetime(2024, 1, 1, 12)
    given = [(f"c{i % 2}", start + dt.timedelta(days=i // 4, minutes=i), float(i)) for i in range(12)]
    df = spark.createDataFrame(given + given, "city string, t timestamp, x double")
    df.coalesce(1).write.parquet(folder("in"))
    stream = I.file_stream(spark, folder("in"), df.schema)
    once = I.deduplicated(stream, ["city", "t"], "t", "10 days")
    I.run_to_files(once, folder("once"), folder("state1")).awaitTermination()
    assert spark.read.parquet(folder("once")).count() == 12
    daily = I.windowed_daily(stream, "city", "t", "x", "1 day", digits=0)
    key = ["date", "city"]
    I.run_to_table(daily, folder("daily"), folder("state2"), key).awaitTermination()
    later = spark.createDataFrame([("c0", start + dt.timedelta(days=2, minutes=500), 100.0)], df.schema)
    later.coalesce(1).write.mode("append").parquet(folder("in"))
    I.run_to_table(daily, folder("daily"), folder("state2"), key).awaitTermination()
    found = rows(I.current_rows(spark, folder("daily"), daily.schema, key))
    assert ("2024-01-03", "c0", 5, 27.0, 8.0, 100.0) in found
    assert found[0] == ("2024-01-01", "c0", 4, 1.0, 0.0, 2.0) and len(found) == 6
