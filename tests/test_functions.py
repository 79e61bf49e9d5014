"""Scalar functions, value by value."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from samples import RUN_TS
from tidewell.functions import cleaning as C, enrichment as E, numeric as N, text as X

UTC = dt.timezone.utc


def apply(spark, kind, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    found = df.select("i", build(F.col("v"), df.schema["v"].dataType).alias("r")).orderBy("i")
    return [r["r"] for r in found.collect()]


def test_clean_text(spark):
    given = ["  Braga  ", None, "   ", "\tOslo\n", "a b", "São Paulo ", " x ", "Ōsaka\x1f", ""]
    wanted = ["Braga", None, None, "Oslo", "a b", "São Paulo", "x", "Ōsaka", None]
    assert apply(spark, "string", given, C.clean_text) == wanted
    assert apply(spark, "int", [123], C.clean_text) == ["123"]


def test_to_number(spark):
    given = ["12.5", None, "invalid", "0", " 7 ", "12.5d", "0x10", "1e3", ".5", "5.", "1_000", "1__0", "+3", " 4 ", "", "-"]
    wanted = [12.5, None, None, 0.0, 7.0, None, None, 1000.0, 0.5, 5.0, 1000.0, None, 3.0, 4.0, None, None]
    assert apply(spark, "string", given, C.to_number) == wanted
    assert apply(spark, "double", [12.5, 0.0, None], C.to_number) == [12.5, 0.0, None]
    assert apply(spark, "string", ["inf", "-Infinity"], C.to_number) == [float("inf"), float("-inf")]
    assert apply(spark, "boolean", [True], C.to_number) == [1.0]


def test_to_whole(spark):
    assert apply(spark, "string", ["12", "12.9", "-12.9", None, "invalid", "0", "nan", "inf", "1e30"], C.to_whole) == [
        12, 12, -12, None, None, 0, None, None, None,
    ]
    assert apply(spark, "double", [12.9, None], C.to_whole) == [12, None]


def test_to_moment(spark):
    given = [
        "2024-01-30T12:00:00+00:00", "2024-01-30T12:00:00Z", "2024-01-30T14:00:00+02:00", "2024-01-30 12:00",
        "1706616000", "1706616000.5", "2024-01-30", "20240130", "not-a-timestamp", None, "12:30", "2024-1-5",
        "2024-01-30T25:00:00", "2024-01-30T12:00:00 Europe/Paris", "nan", "1e20",
    ]
    noon = dt.datetime(2024, 1, 30, 12)
    day = dt.datetime(2024, 1, 30)
    wanted = [noon] * 5 + [noon.replace(microsecond=500000), day, day] + [None] * 8
    assert apply(spark, "string", given, C.to_moment) == wanted
    assert apply(spark, "string", ["2024"], C.to_moment) == [dt.datetime(1970, 1, 1, 0, 33, 44)]
    assert apply(spark, "bigint", [1706616000], C.to_moment) == [noon]
    assert apply(spark, "timestamp_ntz", [noon], C.to_moment) == [noon]


def test_bins_are_right_closed(spark):
    found = apply(spark, "double", [-100.0, 0.0, 0.1, 10.0, 12.0, 100.0, 100.1, None], lambda c, _: E.temperature_category(c))
    assert found == [None, "freezing", "cold", "cold", "mild", "hot", None, None]
    found = apply(spark, "double", [-1.0, 0.0, 5.0, 5.1, 15.0, 30.0, 200.0, 201.0], lambda c, _: E.wind_category(c))
    assert found == [None, "calm", "calm", "light", "light", "moderate", "strong", None]


def test_heat_index(spark):
    df = spark.createDataFrame([(30.0, 50.0), (20.0, 50.0), (30.0, None), (None, 50.0)], "t double, h double")
    found = [r[0] for r in df.select(E.heat_index(F.col("t"), F.col("h"))).collect()]
    assert found[0] == pytest.approx(30.3611111)
    assert found[1:3] == [pytest.approx(20.0), pytest.approx(30.0)]
    assert found[3] is None


def test_calendar_features(spark):
    df = spark.createDataFrame(
        [("2024-01-30 18:59:00", 20.0, 40), ("2024-01-30 05:59:00", 20.0, None), ("2024-01-30 19:00:00", 27.0, 40)],
        "m string, t double, h int",
    )
    features = E.calendar_features(F.col("m").cast("timestamp"), F.col("t"), F.col("h"))
    found = [tuple(r) for r in df.select(*[c.alias(n) for n, c in features.items()]).collect()]
    assert [f[:4] for f in found] == [
        (18, "Tuesday", True, True), (5, "Tuesday", False, False), (19, "Tuesday", False, False),
    ]


def test_rounding_and_shares(spark):
    df = spark.createDataFrame([(0.125, 3, 8), (0.375, 0, 0), (-0.125, 1, 3)], "x double, p int, t int")
    found = df.select(
        N.round_even(F.col("x")), N.share_percent(F.col("p"), F.col("t")), N.pass_rate(F.col("p"), F.col("t")).cast("double")
    ).collect()
    assert [tuple(r) for r in found] == [(0.12, 37.5, 37.5), (0.38, 0.0, 0.0), (-0.12, 33.33, 33.33)]


def test_exact_mean_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9 + 0.01, -1e9, 0.05, None]
    up = spark.createDataFrame([(v,) for v in values], "x double")
    down = spark.createDataFrame([(v,) for v in reversed(values)], "x double")
    means = {df.agg(N.exact_mean(F.col("x"))).collect()[0][0] for df in (up, down, up.repartition(3))}
    assert means == {0.11}


def test_age(spark):
    df = spark.createDataFrame([(RUN_TS - dt.timedelta(hours=25),)], "m timestamp")
    assert df.select(N.age_hours(F.col("m"), RUN_TS)).collect()[0][0] == 25.0


def test_paths():
    day = dt.datetime(2024, 1, 15)
    assert X.day_path(day) == "year=2024/month=01/day=15"
    assert X.day_path(day, "plain") == "2024/01/15"
    assert X.stamp(dt.datetime(2024, 1, 5, 3, 4, 5)) == "20240105_030405"


def test_day_of_path(spark):
    given = [
        "bronze/weather/year=2024/month=01/day=15/a.json", "bronze/weather/2024/01/15/a.json", "bronze/a.json",
        "bronze/2024/13/40/a.json", "s3://b/x/year=2023/month=3/day=4/batch=1/p.parquet",
    ]
    wanted = [dt.date(2024, 1, 15), dt.date(2024, 1, 15), None, None, dt.date(2023, 3, 4)]
    assert apply(spark, "string", given, lambda c, _: X.day_of_path(c)) == wanted


def test_display_texts(spark):
    found = apply(spark, "double", [-1.0, 0.0, 14.96, 24.9, 25.0, 12.25, None], lambda c, _: X.temperature_text(c))
    assert found == ["🥶 -1.0°C", "❄️ 0.0°C", "❄️ 15.0°C", "🌤️ 24.9°C", "🔥 25.0°C", "❄️ 12.2°C", None]
    assert apply(spark, "string", ["wind_speed"], lambda c, _: X.title(c)) == ["Wind Speed"]
    assert apply(spark, "string", ["Braga, Turin ,Rome"], lambda c, _: X.name_list(c)) == [["Braga", "Turin", "Rome"]]
    assert apply(spark, "double", [95.0, 94.9], lambda c, _: X.completeness_label(c)) == ["Good", "Needs Attention"]
    assert apply(spark, "boolean", [True, False, None], lambda c, _: X.gate_label(c)) == ["PASSED", "FAILED", "FAILED"]


def test_moments_in_every_spelling_of_a_day_with_a_time(spark):
    """Against the standard library: separators, parts of the clock and zones in all combinations."""
    days, clocks = ("2024-01-30", "20240130"), ("10", "10:30", "1030", "10:30:05", "103005", "10:30:05.25", "103005.250001")
    zones = ("", "Z", "+05", "+0530", "+05:30", "-0800", "-08:00")
    texts = [f"{day}{mark}{clock}{zone}" for day in days for mark in "T " for clock in clocks for zone in zones]
    found = apply(spark, "string", texts, lambda v, kind: F.unix_micros(C.to_moment(v, kind)))
    for text, micros in zip(texts, found):
        moment = dt.datetime.fromisoformat(text)
        moment = moment if moment.tzinfo else moment.replace(tzinfo=UTC)
        assert micros == (moment - dt.datetime(1970, 1, 1, tzinfo=UTC)) // dt.timedelta(microseconds=1), text
