"""Landing payloads, lake folders and the serving table."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from samples import RUN_TS, rows
from tidewell.operators import cleaning as K, rules as R
from tidewell.operators.gates import GateBlocked
from tidewell.sources import lake, landing, serving, workspace
from tidewell.spec import WEATHER

PAYLOAD = {
    "weather": [{"main": "Rain", "description": "light rain"}, {"main": "Mist", "description": "mist"}],
    "main": {"temp": 286.9, "feels_like": 285.65, "pressure": 1021, "humidity": 58},
    "visibility": 8200, "wind": {"speed": 6.25, "deg": 305}, "clouds": {"all": 35}, "dt": 1709467500,
    "sys": {"country": "PT", "sunrise": 1709449260, "sunset": 1709490840}, "id": 7, "name": "Braga", "cod": 200,
}


@pytest.fixture
def payloads(spark, tmp_path):
    def land(*texts):
        folder = tmp_path / "landing"
        folder.mkdir()
        for i, text in enumerate(texts):
            (folder / f"{i}.json").write_text(text if isinstance(text, str) else json.dumps(text))
        return landing.read_landing(spark, str(folder))

    return land


def test_flatten(payloads):
    row = landing.flatten(payloads(PAYLOAD), RUN_TS).collect()[0]
    assert (row["city"], row["country"], row["temperature_celsius"], row["feels_like_celsius"]) == ("Braga", "PT", 13.75, 12.5)
    assert (row["weather_condition"], row["humidity"], row["visibility"]) == ("Rain", 58, 8200)
    assert row["timestamp"] == dt.datetime(2024, 3, 3, 12, 5)


def test_absent_parts(payloads):
    bare = payloads({"name": "Nowhere", "weather": [], "cod": 200})
    row = landing.flatten(bare, RUN_TS).collect()[0]
    assert row["temperature_celsius"] is None and row["weather_condition"] is None and row["timestamp"] is None
    filled = landing.flatten(bare, RUN_TS, compat_defaults=True).collect()[0]
    assert (filled["temperature_celsius"], filled["country"], filled["humidity"]) == (-273.15, "Unknown", 0)
    assert filled["timestamp"] == dt.datetime(1970, 1, 1)
    judged = K.clean_with_reason(landing.flatten(bare, RUN_TS, compat_defaults=True), WEATHER, RUN_TS)
    assert rows(judged, "reason") == [("temperature_celsius=-273.15 outside range [-100, 100]",)]


def test_failed_fetches_are_set_aside(payloads):
    found = payloads(
        PAYLOAD, {"cod": "404", "message": "city not found", "name": "Atlantis"}, {"cod": 401}, {"cod": 429}, {"cod": 503},
        "{ broken", dict(PAYLOAD, name="Turin"),
    )
    good, bad = landing.split_payloads(found)
    assert rows(good, "name") == [("Braga",), ("Turin",)]
    assert rows(bad, "reason") == [
        ("API request failed",), ("City not found: Atlantis",), ("Invalid API key",), ("Payload does not parse",), ("Rate limit exceeded",),
    ]
    assert rows(landing.for_entities(good, ["Turin", "Rome"]), "name") == [("Turin",)]
    assert landing.for_entities(good, None).count() == 2


def test_landed_payload_passes_the_cleaner(payloads):
    judged = K.clean_with_reason(landing.flatten(payloads(PAYLOAD), RUN_TS), WEATHER, RUN_TS)
    assert rows(K.valid_rows(judged), "city", "temperature_celsius", "humidity") == [("Braga", 13.75, 58)]


# --- lake -------------------------------------------------------------------------


def test_batch_paths():
    at = dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)
    assert lake.batch_path("/r", "bronze", at, "x") == "/r/bronze/year=2024/month=01/day=15/batch=x"
    assert lake.batch_path("/r", "bronze", at, "x", "plain") == "/r/bronze/2024/01/15/x"


@pytest.fixture
def by_day(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, dt.datetime(2023, 3, 4) if i < 3 else dt.datetime(2024, 6, 7 + i)) for i in range(6)], "i int, t timestamp"
    )
    return df, lake.write_by_day(df, str(tmp_path / "days"), "t")


def test_day_folders_are_pruned(spark, by_day):
    df, path = by_day
    found = lake.read_by_day(spark, path, df.schema, dt.date(2024, 1, 1), dt.date(2024, 6, 11))
    assert rows(found, "i") == [(3,), (4,)]
    assert lake.read_by_day(spark, path, "i int, t timestamp").count() == 6
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_listing(spark, by_day, tmp_path):
    _, path = by_day
    (tmp_path / "days" / "stray.txt").write_text("x")
    days = {r["day"] for r in lake.list_files(spark, path, dt.date(2024, 1, 1)).collect()}
    assert days == {dt.date(2024, 6, d) for d in (10, 11, 12)} | {None}


def test_retention(spark, by_day):
    df, path = by_day
    assert lake.expire_days(spark, path, dt.date(2024, 6, 12), 1) == [dt.date(2023, 3, 4), dt.date(2024, 6, 10)]
    assert rows(lake.read_by_day(spark, path, df.schema), "i") == [(4,), (5,)]


def test_json_batches(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=2))
    (tmp_path / "object.json").write_text(json.dumps({"a": 3}, indent=2))
    assert rows(lake.read_json(spark, str(tmp_path), "a int")) == [(1,), (2,), (3,)]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "l.json").write_text('{"a": 4}\n{"a": 5}\n')
    assert rows(lake.read_json(spark, str(tmp_path / "lines"), "a int", multi_line=False)) == [(4,), (5,)]
    (tmp_path / "bad.json").write_text("{ broken")
    paths = [str(tmp_path / n) for n in ("array.json", "bad.json", "absent.json", "object.json")]
    assert rows(lake.read_json(spark, paths, "a int")) == [(1,), (2,), (3,)]
    bad = lake.broken_json(spark, paths, "a int").collect()
    assert [(r["path"].rsplit("/", 1)[1], r["text"]) for r in bad] == [("bad.json", "{ broken")]
    assert lake.read_json(spark, [str(tmp_path / "absent.json")], "a int").collect() == []


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "batch=1")
    for _ in range(2):
        lake.write_batch(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_latest_batch_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("20240101_000000", 1), ("20240102_000000", 2)], "batch string, v int")
    assert rows(lake.latest_batch(df), "v") == [(2,)]
    path = lake.export_csv(df, str(tmp_path / "csv"))
    assert rows(lake.read_csv(spark, path, "batch string, v int")) == rows(df)


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert workspace.shared_root(spark) == (named.rstrip("/") if named else workspace.shared_root(spark))
    first, second = workspace.scratch(spark, "a"), workspace.scratch(spark, "a")
    assert first != second and first.startswith(workspace.shared_root(spark))
    with workspace.setting(spark, "spark.sql.shuffle.partitions", "3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


# --- serving ----------------------------------------------------------------------


@pytest.fixture
def silver(raw):
    return lambda *changes: K.valid_rows(K.clean_with_reason(raw(*changes), WEATHER, RUN_TS))


def test_serving_projection(silver):
    df = serving.serving_rows(silver({}, {"city": "Turin"}), RUN_TS)
    assert df.columns == serving.serving_columns()
    assert dict(df.dtypes)["temperature_celsius"] == "decimal(5,2)"
    assert len({r["ingested_at"] for r in df.collect()}) == 1
    again = serving.serving_rows(df.drop("ingested_at"), RUN_TS)
    assert rows(again, "city", "recorded_at") == rows(df, "city", "recorded_at")


def test_load_updates_three_columns(spark, silver, tmp_path):
    path, stage = str(tmp_path / "served"), str(tmp_path / "stage")
    later = RUN_TS + dt.timedelta(hours=1)
    first = silver({}, {"city": "Oslo", "timestamp": "2024-01-29T12:00:00Z"}, {"city": "Rome", "timestamp": "2024-01-28T01:00:00Z"})
    assert serving.load(spark, first, path, stage + "1", RUN_TS) == 3
    ids = {r["city"]: r["id"] for r in serving.read_served(spark, path).collect()}
    second = silver({"temperature_celsius": "14", "pressure": "900", "humidity": None}, {"city": "Bern"})
    assert serving.load(spark, second, path, stage + "2", later) == 2
    found = {r["city"]: r for r in serving.read_served(spark, path).collect()}
    braga = found["Braga"]
    assert set(found) == {"Braga", "Oslo", "Rome", "Bern"}
    assert (float(braga["temperature_celsius"]), braga["humidity"], braga["pressure"]) == (14.0, None, 1021)
    assert braga["ingested_at"].hour == later.hour and found["Oslo"]["ingested_at"].hour == RUN_TS.hour
    assert {c: found[c]["id"] for c in ids} == ids
    assert {str(found[c]["recorded_on"]) for c in ("Braga", "Oslo", "Rome")} == {"2024-01-30", "2024-01-29", "2024-01-28"}


def test_load_refuses_duplicates_and_broken_constraints(spark, silver, tmp_path):
    path, stage = str(tmp_path / "served"), str(tmp_path / "stage")
    with pytest.raises(GateBlocked, match="duplicate"):
        serving.load(spark, silver({}, {}), path, stage, RUN_TS)
    with pytest.raises(GateBlocked, match="wind_direction"):
        serving.load(spark, silver({"wind_direction": "361"}), path, stage, RUN_TS)
    assert serving.load(spark, silver({}).limit(0), path, stage, RUN_TS) == 0
    assert serving.read_served(spark, path).count() == 0


def test_optional_values_may_be_absent(spark, silver, tmp_path):
    bare = silver({"feels_like_celsius": None, "wind_direction": None, "weather_condition": None, "sunrise": None})
    assert serving.load(spark, bare, str(tmp_path / "served"), str(tmp_path / "stage"), RUN_TS) == 1


def test_only_the_days_of_the_batch_are_read(spark, silver, tmp_path):
    path = str(tmp_path / "served")
    for day in range(1, 6):
        serving.load(spark, silver({"timestamp": f"2024-01-{day:02}T12:00:00Z"}), path, str(tmp_path / f"s{day}"), RUN_TS)
    batch = silver({"timestamp": "2024-01-03T12:00:00Z"})
    dated = serving.serving_rows(batch, RUN_TS).withColumn(serving.DAY, F.to_date(serving.SERVED_TIME))
    touched = serving.within_days_of(serving.read_served(spark, path), dated)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "recorded_on" in filters and touched.count() == 1
    assert len(touched.inputFiles()) >= 1


def test_rule_names_of_the_load_gate():
    names = [r.name for r in serving.load_gate().rules]
    assert names.count("limits") == 3 and "unique_check" in names and isinstance(serving.load_gate().rules[-1], R.FrameRule)
