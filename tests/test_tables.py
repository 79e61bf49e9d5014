"""Statistics, reads, joins, merges, medians and outliers."""

import datetime as dt
import math
import random
from collections import defaultdict
from statistics import median, stdev

import pytest
from pyspark.sql import functions as F

from samples import rows
from tidewell.operators import (
    keyed_join as J,
    medians as D,
    merge as M,
    outliers as O,
    reads as Q,
    statistics as S,
)


# --- statistics -------------------------------------------------------------------


def test_grouped_statistics_by_hand(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", None), ("b", 5.0), (None, 9.0)], "g string, x double"
    )
    found = S.grouped_statistics(df, ["g"], [S.Measure("x", ("mean", "min", "max", "std", "count"))], rows="n")
    assert rows(found) == [
        ("a", 2.33, 1.0, 4.0, round(stdev([1, 2, 4]), 2), 3, 4), ("b", 5.0, 5.0, 5.0, None, 1, 1),
    ]


def test_daily_statistics(spark):
    df = spark.createDataFrame(
        [("Braga", "PT", dt.datetime(2024, 1, 30, h), 10.0 + h, 60 + h) for h in (1, 2, 23)]
        + [("Braga", "PT", dt.datetime(2024, 1, 31, 0), 5.0, None)],
        "city string, country string, timestamp timestamp, temperature_celsius double, humidity int",
    ).withColumns({"pressure": F.lit(1000), "wind_speed": F.lit(3.456), "clouds_percentage": F.lit(5), "visibility": F.lit(9)})
    found = S.daily_statistics(df).select("date", "temperature_celsius_mean", "humidity_min", "wind_speed_mean", "temperature_celsius_std")
    assert rows(found) == [
        ("2024-01-30", 18.67, 61.0, 3.46, round(stdev([11, 12, 33]), 2)), ("2024-01-31", 5.0, None, 3.46, None),
    ]
    served = S.daily_serving_rows(df)
    assert [tuple(r)[:4] for r in served.orderBy("date").collect()][1][0:2] == ("Braga", dt.date(2024, 1, 31))
    assert dict(served.dtypes)["pressure_avg"] == "decimal(7,2)"
    assert "observation_count" in S.city_statistics(df).columns


def test_metadata_and_snapshot_of_an_empty_table(spark):
    df = spark.createDataFrame([], "city string, recorded_at timestamp, temperature_celsius double, humidity int")
    row = S.quality_snapshot(df).collect()[0]
    assert (row["total_records"], row["avg_measure"], row["data_completeness"], row["earliest_record"]) == (0, 0.0, 0.0, None)
    assert S.batch_metadata(df, "city", "recorded_at").collect()[0]["record_count"] == 0


def test_snapshot(spark):
    now = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("a", now, 10.0, 1), ("a", now, 70.0, None), ("b", now, -50.0, 3)],
        "city string, recorded_at timestamp, temperature_celsius double, humidity int",
    )
    row = S.quality_snapshot(df).collect()[0]
    assert (row["unique_entities"], row["avg_measure"], row["data_completeness"], row["valid_measure_pct"]) == (2, 10.0, 66.67, 66.67)


def test_histogram(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("x"))
    found = S.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r["count"] for r in found] == [10] * 10
    flat = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [(r["bin"], r["count"]) for r in S.histogram(flat, "x").collect()] == [(0, 2)]


# --- reads --------------------------------------------------------------------------


def test_latest_row_and_latest_values_differ(spark):
    df = spark.createDataFrame([("a", 1, 5, 7), ("a", 2, None, 8)], "city string, t int, humidity int, x int")
    assert rows(Q.latest_per_key(df, ["city"], "t"), "humidity", "x") == [(None, 8)]
    assert rows(Q.latest_values_per_key(df, ["city"], "t", ["humidity", "x"])) == [("a", 5, 8)]
    undated = spark.createDataFrame([("a", None, 1), ("a", 3, 2), (None, None, 9)], "city string, t int, x int")
    assert rows(Q.latest_per_key(undated, ["city"], "t")) == [("a", 3, 2), (None, None, 9)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = Q.latest_per_key(df, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("partial_max_by") > plan.index("Exchange")


def test_ranges(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, d, 12)) for d in range(1, 6)] + [("b", dt.datetime(2024, 1, 3))], "city string, t timestamp"
    )
    between = Q.entity_range(df, "city", "a", "t", dt.datetime(2024, 1, 2, 12), dt.datetime(2024, 1, 4, 12))
    assert between.count() == 3
    assert Q.entity_range(df, "city", "a", "t").count() == 5
    assert Q.date_filtered(df, "t", dt.date(2024, 1, 3), dt.date(2024, 1, 4)).count() == 3
    assert Q.date_filtered(df, "t", dt.date(2024, 1, 3), None).count() == 6
    assert [r["t"].day for r in Q.newest(df, "t", 2, ["city"]).collect()] == [5, 4]
    assert Q.series(df, "city", "t", ["city", "absent", "t"]).columns == ["city", "t"]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, d double")
    assert rows(Q.union_batches([a, b])) == [(1, "x", None), (None, "y", 2.0)]


# --- joins --------------------------------------------------------------------------


@pytest.mark.parametrize("how", [{"small": True}, {"small": None}, {"small": False}, {"small": False, "task_rows": 20}, {"small": False, "heavy": 2, "task_rows": 5}])
def test_attach_agrees_with_a_plain_join(spark, how):
    # a third of the rows share one key, another third one key without partner, some have none
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, 999).otherwise((F.col("id") % 50).cast("int"))
    left = spark.range(600).select(F.when(F.col("id") % 11 != 0, key).alias("k"), (F.col("id") % 5).alias("v"))
    right = spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"), F.lit("p").alias("p"))
    plain = left.join(right, "k", "left").select("k", "v", "w", "p")
    assert rows(J.attach(left, right, ["k"], **how), "k", "v", "w", "p") == rows(plain)
    assert J.orphans(left, right, ["k"], **how).count() == left.join(right, "k", "left_anti").count()
    assert J.survivors(left, right, ["k"], **how).count() == left.join(right, "k", "left_semi").count()
    assert J.joined_to_parent(left, right, ["k"], **how).count() == left.join(right, "k").count()


def test_hot_rows_scatter(spark):
    """Copies of one row with one key do not end in one task."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(0, 8000, 1, 16).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
        right = spark.range(500).select(F.col("id").cast("int").alias("k"), F.lit("w").alias("w"))
        found = J.attach(left, right, ["k"], small=False, task_rows=100)
        sizes = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 8000 and max(sizes) < 8000 and len(sizes) > 1
        assert found.filter("w is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_check(spark):
    assert J.has_at_most(spark.range(10), 10) and not J.has_at_most(spark.range(11), 10)
    wide = spark.range(10).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert J.is_small(wide) and not J.is_small(wide, size=5000) and not J.is_small(wide, rows=9)


def test_upsert(spark):
    ddl = "city string, at int, t double, note string"
    base = spark.createDataFrame([("L", 1, 12.0, "old"), ("P", 1, 7.0, None)], ddl)
    delta = spark.createDataFrame([("L", 1, 14.0, "new"), ("R", 1, 20.0, "first"), ("P", 1, None, "x")], ddl)
    assert rows(M.upsert(base, delta, ["city", "at"], ["t"])) == [
        ("L", 1, 14.0, "old"), ("P", 1, None, None), ("R", 1, 20.0, "first"),
    ]
    assert rows(M.upsert(base, delta, ["city", "at"])) == [("L", 1, 14.0, "new"), ("P", 1, None, "x"), ("R", 1, 20.0, "first")]
    with pytest.raises(ValueError):
        M.upsert(base, delta, ["city", "at"], ["absent"])
    with pytest.raises(M.DuplicateKeys):
        M.require_unique(delta.union(delta), ["city", "at"])
    M.require_unique(delta, ["city", "at"])


# --- medians and outliers -------------------------------------------------------------


def grouped(values):
    held = defaultdict(list)
    for key, x in values:
        held[key].append(x)
    return held


@pytest.mark.parametrize("exact_rows", [10**6, 0])
@pytest.mark.parametrize("small", [True, False])
def test_medians_by_brute_force(spark, exact_rows, small, monkeypatch):
    if not small:
        monkeypatch.setattr(D.GroupSizes, "fits_broadcast", lambda self: False)
    rng = random.Random(3)
    # one group with most rows, one of copies, a pair, a single, and huge outliers
    values = [("hot", round(rng.gauss(0, 50), 2)) for _ in range(3000)] + [("same", 4.5)] * 501
    values += [("pair", 1.0), ("pair", 2.0), ("one", -3.0)] + [("wide", 10.0**e) for e in range(-8, 9)] + [("hot", 1e12)]
    df = spark.createDataFrame(values, "g string, x double").repartition(7)
    sizes = D.group_sizes(df, ["g"])
    assert (sizes.groups, sizes.largest) == (5, 3001)
    found = {r["g"]: (r["n"], r["median"], r["mad"]) for r in O.group_spread(df, "g", "x", sizes, exact_rows).collect()}
    for key, xs in grouped(values).items():
        m = median(xs)
        assert found[key][0] == len(xs)
        assert found[key][1] == pytest.approx(m, rel=1e-12)
        assert found[key][2] == pytest.approx(median(abs(x - m) for x in xs), rel=1e-9)


def test_a_missed_bracket_is_ranked_whole(spark):
    """With a useless sketch the exact route still finds every median."""
    values = [("a", float(i)) for i in range(1001)] + [("b", 1.0), ("b", 4.0)]
    df = spark.createDataFrame(values, "g string, x double").repartition(5)
    found = D.grouped_median(df, ["g"], "x", D.group_sizes(df, ["g"]), exact_rows=0, accuracy=20)
    assert rows(found, "g", "n", "median") == [("a", 1001, 500.0), ("b", 2, 2.5)]


def readings(spark, cities):
    rows_ = [(c, str(x) if x is not None else None) for c, xs in cities.items() for x in xs]
    return spark.createDataFrame(rows_, "city string, t string")


@pytest.mark.parametrize(
    "cities, threshold, wanted",
    [
        ({"Quito": [3.25, 3.5, 3.75, 4.0, 4.25, 31.0]}, 3.0, ["31.0"]),
        ({"Lima": [7, 8, 6, 7, 9, 8], "Cusco": [2.5] * 5, "Ica": [1, 400]}, 3.0, []),
        ({"Low": [-51, -52, -53, -54, -50], "High": [62, 61, 63, 64, 62]}, 3.5, []),
        ({"Loja": [5, None, "none", 5.5, 4.5, 6, "x", -44]}, 2.0, ["-44"]),
        ({"Puno": [20, 22, 24, 26, 28, 60, 95]}, 1.0, ["95", "60", "20"]),
        ({None: [1, 2, 3, 2, 1, 3, 90], "Ayo": [5, 5, 6]}, 3.5, ["90"]),
    ],
)
def test_outliers(spark, cities, threshold, wanted):
    found = O.by_severity(O.robust_outliers(readings(spark, cities), "city", "t", threshold), "t")
    assert [r["t"] for r in found.collect()] == wanted


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("exact_rows", [10**6, 200, 0])
def test_medians_with_nulls(spark, exact_rows, small, monkeypatch):
    """Groups of any size keep their NULL values and the group of the NULL key."""
    if not small:
        monkeypatch.setattr(D.GroupSizes, "fits_broadcast", lambda self: False)
    values = [("a", float(i)) for i in range(301)] + [("a", None)] * 200 + [(None, float(i)) for i in range(8)] + [("none", None)] * 3
    values += [(None, None)] * 400
    df = spark.createDataFrame(values, "g string, x double").repartition(5)
    sizes = D.group_sizes(df, ["g"])
    found = O.group_spread(df, "g", "x", sizes, exact_rows)
    assert rows(found, "g", "n", "median", "mad") == [("a", 301, 150.0, 75.0), ("none", 0, None, None), (None, 8, 3.5, 2.0)]


def test_outlier_scores_by_brute_force(spark):
    rng = random.Random(5)
    values = [(f"c{rng.randrange(4)}", round(rng.expovariate(0.1), 2)) for _ in range(800)]
    df = spark.createDataFrame(values, "city string, t double")
    wanted = []
    for city, xs in grouped(values).items():
        m = median(xs)
        spread = median(abs(x - m) for x in xs)
        wanted += [(city, x, round(0.6745 * (x - m) / spread, 2)) for x in xs if abs(0.6745 * (x - m) / spread) >= 3.5]
    for exact_rows in (10**6, 10):
        found = rows(O.robust_outliers(df, "city", "t", exact_rows=exact_rows))
        assert [f[:2] for f in found] == [w[:2] for w in sorted(wanted, key=repr)]
        assert all(math.isclose(f[2], w[2], abs_tol=0.011) for f, w in zip(found, sorted(wanted, key=repr)))


