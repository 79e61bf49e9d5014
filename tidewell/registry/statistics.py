"""Queries: grouped statistics, reads, outliers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import outliers as O, reads as Q, statistics as S
from ..operators.medians import group_sizes, grouped_median
from . import common as C

def gold_daily(spark, sf_dir):
    return S.daily_statistics(
        C.events(spark, sf_dir), ("event_type",), "ts",
        (S.Measure("value", ("mean", "min", "max", "std"), digits=2), S.Measure("k", ("min", "max"))),
        rows="n",
    )


def gold_entity_stats(spark, sf_dir):
    measures = (S.Measure("value", ("mean", "min", "max", "std", "count"), digits=2),)
    return S.city_statistics(C.events(spark, sf_dir), ("user_id", "event_type"), measures, "value")


def daily_serving(spark, sf_dir):
    e = C.events(spark, sf_dir)
    weather = e.select(
        "user_id", "ts",
        F.col("value").alias("temperature_celsius"),
        F.col("k").alias("humidity"),
        (F.col("k") + 950).alias("pressure"),
        F.floor(F.col("value")).alias("wind_speed"),
        (F.lit(100) - F.col("k")).alias("clouds_percentage"),
        (F.col("k") * 1000).alias("visibility"),
    )
    rows = S.daily_serving_rows(weather, "user_id", "ts")
    wanted = ("temp_avg", "temp_min", "temp_max", "temp_std", "humidity_avg", "pressure_avg", "wind_speed_avg", "wind_speed_max", "clouds_avg")
    return rows.select(
        "user_id", F.col("date").cast("string").alias("date"), *[C.real(c).alias(c) for c in wanted], "observation_count"
    )


def gold_metadata(spark, sf_dir):
    return S.batch_metadata(C.events(spark, sf_dir), "user_id", "ts")


def filtered_stats(spark, sf_dir):
    chosen = Q.date_filtered(
        C.events(spark, sf_dir), "ts", dt.date(2024, 1, 5), dt.date(2024, 1, 20), "event_type", "click"
    )
    return S.filtered_statistics(chosen, "value", "value", digits=2)


def entity_list(spark, sf_dir):
    return S.distinct_values(C.events(spark, sf_dir), "event_type")


def date_bounds(spark, sf_dir):
    found = S.date_bounds(C.events(spark, sf_dir), "ts")
    return found.select(*[F.col(c).cast("string").alias(c) for c in found.columns])


def histogram(spark, sf_dir):
    return _bins(S.histogram(C.events(spark, sf_dir), "value"), "bin")


def histogram_by_entity(spark, sf_dir):
    return _bins(S.histogram(C.events(spark, sf_dir), "value", split="event_type"), "bin", "event_type")


def _bins(df, *keys):
    shown = [C.big(k).alias(k) if k == "bin" else k for k in keys]
    return df.select(*shown, "count", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


def quality_snapshot(spark, sf_dir):
    e = C.events(spark, sf_dir).withColumn("k", F.when(F.col("k") >= 10, F.col("k")))
    found = S.quality_snapshot(e, "user_id", "ts", "value", "k", digits=2)
    return found.withColumns({c: C.micros(F.col(c)) for c in ("earliest_record", "latest_record")})


_EVENT = ("event_id", "user_id", "event_type", "value", "k")


def _shown(df):
    return df.select(*_EVENT, C.micros(F.col("ts")).alias("ts"))


def latest_per_key(spark, sf_dir):
    return _shown(Q.latest_per_key(C.events(spark, sf_dir), ["user_id"], "ts", ["event_id"]))


def latest_non_null(spark, sf_dir):
    e = C.events(spark, sf_dir).withColumns(
        {"k": F.when(F.col("k") >= 40, F.col("k")), "value": F.when(F.col("value") < 60, F.col("value"))}
    )
    return Q.latest_values_per_key(e, ["user_id"], "ts", ["event_type", "value", "k"], ["event_id"])


def top_latest(spark, sf_dir):
    return _shown(Q.newest(C.events(spark, sf_dir), "ts", 100, ["event_id"]))


def entity_range(spark, sf_dir):
    chosen = Q.entity_range(
        C.events(spark, sf_dir), "event_type", "purchase", "ts",
        dt.datetime(2024, 1, 3, 12), dt.datetime(2024, 1, 27, 6, 30),
    )
    return _shown(Q.newest_first(chosen, "ts", ["event_id"]))


def date_range(spark, sf_dir):
    chosen = Q.date_filtered(C.events(spark, sf_dir), "ts", dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    return _shown(chosen)


def series(spark, sf_dir):
    found = Q.series(
        C.events(spark, sf_dir), "event_type", "ts", ["event_type", "ts", "value", "event_id", "absent"], ["event_id"]
    )
    return found.withColumn("ts", C.micros(F.col("ts")))


def union_batches(spark, sf_dir):
    e = C.events(spark, sf_dir)
    errors = e.filter("event_type = 'error'").select("event_id", "event_type", F.col("k").alias("code"))
    others = e.filter("event_type <> 'error'").select("event_type", "value", "event_id")
    return Q.union_batches([errors, others])


def mad_outliers(spark, sf_dir):
    found = O.robust_outliers(C.events(spark, sf_dir), "event_type", "value")
    return O.by_severity(found, "event_id").select("event_id", "event_type", "value", "z_score")


def mad_outliers_by_user(spark, sf_dir):
    found = O.robust_outliers(C.events(spark, sf_dir), "user_id", "value", threshold=3.0, min_samples=5)
    return found.select("event_id", "user_id", "value", "z_score")


def group_medians(spark, sf_dir):
    li = C.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity")
    spread = O.group_spread(li, "l_suppkey", "l_quantity", group_sizes(li, ["l_suppkey"]))
    return spread.select("l_suppkey", "n", "median", "mad")


def group_medians_nulls(spark, sf_dir):
    """Medians of groups with absent values and of the rows without a group, by either route."""
    li = C.table(spark, sf_dir, "lineitem")
    keyed = li.select(
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.when((F.col("l_linenumber") > 2) & (F.col("l_returnflag") != "A"), F.col("l_extendedprice")).alias("price"),
    )
    sizes, found = group_sizes(keyed, ["flag"]), None
    for route, rows in (("plain", sizes.largest), ("bracketed", 0)):
        medians = grouped_median(keyed, ["flag"], "price", sizes, exact_rows=rows)
        medians = medians.select(F.lit(route).alias("route"), "flag", "n", F.round("median", 4).alias("median"))
        found = medians if found is None else found.unionByName(medians)
    return found


def mad_outliers_null_entity(spark, sf_dir):
    """Events without a type are scored against each other."""
    e = C.events(spark, sf_dir).withColumn("event_type", F.when(F.col("event_type") != "view", F.col("event_type")))
    found = O.robust_outliers(e, "event_type", "value", threshold=2.0)
    return found.select("event_id", "event_type", "value", "z_score")


def group_medians_sketched(spark, sf_dir):
    """The same medians by the route for groups too large for one task."""
    li = C.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    spread = O.group_spread(
        li, "l_returnflag", "l_extendedprice", group_sizes(li, ["l_returnflag"]), exact_rows=1_000
    )
    return spread.select("l_returnflag", "n", F.round("median", 4).alias("median"), F.round("mad", 4).alias("mad"))


_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"
_CENTS = "round_even(sum(CAST(round(value * 100) AS BIGINT)) / count(*), 0) / 100"


def _histogram_sql(split: str) -> str:
    also = f", {split}" if split else ""
    return f"""
        WITH b AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 20 AS w FROM events),
             x AS (SELECT CAST(least(floor((value - lo) / w), 19) AS BIGINT) AS bin, lo, w{also} FROM events, b)
        SELECT bin{also}, count(*) AS count, round(any_value(lo) + bin * any_value(w), 6) AS low,
               round(any_value(lo) + (bin + 1) * any_value(w), 6) AS high
        FROM x GROUP BY bin{also}"""


def _outlier_sql(entity: str, threshold: float, least: int) -> str:
    return f"""
        WITH r AS (SELECT event_id, {entity}, value,
                          row_number() OVER (PARTITION BY {entity} ORDER BY value) AS rn,
                          count(*) OVER (PARTITION BY {entity}) AS n FROM events),
             m AS (SELECT {entity}, any_value(n) AS n,
                          (max(value) FILTER (WHERE rn = (n + 1) // 2) + max(value) FILTER (WHERE rn = n // 2 + 1)) / 2 AS med
                   FROM r GROUP BY {entity}),
             d AS (SELECT {entity}, abs(value - med) AS dev, m.n,
                          row_number() OVER (PARTITION BY {entity} ORDER BY abs(value - med)) AS rn
                   FROM events JOIN m USING ({entity})),
             a AS (SELECT {entity},
                          (max(dev) FILTER (WHERE rn = (n + 1) // 2) + max(dev) FILTER (WHERE rn = n // 2 + 1)) / 2 AS mad
                   FROM d GROUP BY {entity})
        SELECT event_id, {entity}, value, round_even(CAST(0.6745 AS DOUBLE) * (value - med) / mad * 100, 0) / 100 AS z_score
        FROM events JOIN m USING ({entity}) JOIN a USING ({entity})
        WHERE n >= {least} AND mad <> 0 AND abs(CAST(0.6745 AS DOUBLE) * (value - med) / mad) >= {threshold}"""


_NO_TYPE = "(SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS event_type, value FROM events)"

ORACLES = {
    "mad_outliers_null_entity": f"""
        WITH e AS (SELECT event_id, event_type, coalesce(event_type, '?') AS held, value FROM {_NO_TYPE} x),
             r AS (SELECT held, value, row_number() OVER (PARTITION BY held ORDER BY value) AS rn, count(*) OVER (PARTITION BY held) AS n FROM e),
             m AS (SELECT held, any_value(n) AS n,
                          (max(value) FILTER (WHERE rn = (n + 1) // 2) + max(value) FILTER (WHERE rn = n // 2 + 1)) / 2 AS med
                   FROM r GROUP BY held),
             d AS (SELECT held, abs(value - med) AS dev, m.n, row_number() OVER (PARTITION BY held ORDER BY abs(value - med)) AS rn
                   FROM e JOIN m USING (held)),
             a AS (SELECT held, (max(dev) FILTER (WHERE rn = (n + 1) // 2) + max(dev) FILTER (WHERE rn = n // 2 + 1)) / 2 AS mad
                   FROM d GROUP BY held)
        SELECT event_id, event_type, value, round_even(CAST(0.6745 AS DOUBLE) * (value - med) / mad * 100, 0) / 100 AS z_score
        FROM e JOIN m USING (held) JOIN a USING (held)
        WHERE n >= 3 AND mad <> 0 AND abs(CAST(0.6745 AS DOUBLE) * (value - med) / mad) >= 2.0""",
    "gold_daily": f"""
        SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, {_CENTS} AS value_mean, min(value) AS value_min,
               max(value) AS value_max, round_even(stddev_samp(value) * 100, 0) / 100 AS value_std,
               CAST(min(k) AS DOUBLE) AS k_min, CAST(max(k) AS DOUBLE) AS k_max, count(*) AS n
        FROM {C.EVENTS_SQL} e GROUP BY 1, 2""",
    "gold_entity_stats": f"""
        SELECT user_id, event_type, {_CENTS} AS value_mean, min(value) AS value_min, max(value) AS value_max,
               round_even(stddev_samp(value) * 100, 0) / 100 AS value_std, count(value) AS observation_count
        FROM events GROUP BY 1, 2""",
    "daily_serving": f"""
        SELECT user_id, strftime(ts, '%Y-%m-%d') AS date, round_even(avg(value) * 100, 0) / 100 AS temp_avg,
               min(value) AS temp_min, max(value) AS temp_max, round_even(stddev_samp(value) * 100, 0) / 100 AS temp_std,
               round_even(avg(floor(value)) * 100, 0) / 100 AS wind_speed_avg,
               round_even(avg(k) * 100, 0) / 100 AS humidity_avg, round_even(avg(k + 950) * 100, 0) / 100 AS pressure_avg,
               max(floor(value)) AS wind_speed_max, round_even(avg(100 - k) * 100, 0) / 100 AS clouds_avg,
               count(*) AS observation_count
        FROM {C.EVENTS_SQL} e GROUP BY 1, 2""",
    "gold_metadata": """
        SELECT count(*) AS record_count, count(DISTINCT user_id) AS entity_count,
               strftime(min(ts), '%Y-%m-%d') AS start_date, strftime(max(ts), '%Y-%m-%d') AS end_date FROM events""",
    "filtered_stats": f"""
        SELECT count(*) AS count, {_CENTS} AS avg_measure, max(value) AS max_measure, min(value) AS min_measure,
               {_CENTS} AS avg_second
        FROM events WHERE event_type = 'click' AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    "entity_list": "SELECT DISTINCT event_type FROM events ORDER BY 1",
    "date_bounds": """
        SELECT strftime(min(ts), '%Y-%m-%d') AS first_date, strftime(max(ts), '%Y-%m-%d') AS last_date FROM events""",
    "histogram": _histogram_sql(""),
    "histogram_by_entity": _histogram_sql("event_type"),
    "quality_snapshot": f"""
        SELECT count(*) AS total_records, count(DISTINCT user_id) AS unique_entities,
               strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS earliest_record,
               strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS latest_record, {_CENTS} AS avg_measure,
               round_even(count(*) FILTER (WHERE k >= 10) / count(*) * 100.0 * 100, 0) / 100 AS data_completeness,
               round_even(count(*) FILTER (WHERE value BETWEEN -50 AND 60) / count(*) * 100.0 * 100, 0) / 100 AS valid_measure_pct
        FROM {C.EVENTS_SQL} e""",
    "latest_per_key": f"""
        SELECT event_id, user_id, event_type, value, k, {_TS} FROM {C.EVENTS_SQL} e
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_non_null": f"""
        SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type,
               arg_max(value, (ts, event_id)) FILTER (WHERE value < 60) AS value,
               arg_max(k, (ts, event_id)) FILTER (WHERE k >= 40) AS k
        FROM {C.EVENTS_SQL} e GROUP BY user_id""",
    "top_latest": f"""
        SELECT event_id, user_id, event_type, value, k, {_TS} FROM
            (SELECT * FROM {C.EVENTS_SQL} x ORDER BY ts DESC, event_id DESC LIMIT 100) e""",
    "entity_range": f"""
        SELECT event_id, user_id, event_type, value, k, {_TS} FROM {C.EVENTS_SQL} e
        WHERE event_type = 'purchase' AND ts BETWEEN TIMESTAMP '2024-01-03 12:00:00' AND TIMESTAMP '2024-01-27 06:30:00'""",
    "date_range": f"""
        SELECT event_id, user_id, event_type, value, k, {_TS} FROM {C.EVENTS_SQL} e
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    "series": f"SELECT event_type, {_TS}, value, event_id FROM events",
    "union_batches": f"""
        SELECT event_id, event_type, k AS code, CAST(NULL AS DOUBLE) AS value FROM {C.EVENTS_SQL} a WHERE event_type = 'error'
        UNION ALL BY NAME SELECT event_type, value, event_id FROM events WHERE event_type <> 'error'""",
    "mad_outliers": _outlier_sql("event_type", 3.5, 3),
    "mad_outliers_by_user": _outlier_sql("user_id", 3.0, 5),
    "group_medians": """
        WITH m AS (SELECT l_suppkey, median(l_quantity) AS median, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT l_suppkey, any_value(n) AS n, any_value(m.median) AS median, median(abs(l_quantity - m.median)) AS mad
        FROM lineitem JOIN m USING (l_suppkey) GROUP BY 1""",
    "group_medians_nulls": """
        WITH x AS (SELECT CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag,
                          CASE WHEN l_linenumber > 2 AND l_returnflag <> 'A' THEN l_extendedprice END AS price FROM lineitem)
        SELECT route, flag, count(price) AS n, round(median(price), 4) AS median
        FROM x, (VALUES ('plain'), ('bracketed')) r(route) GROUP BY route, flag""",
    "group_medians_sketched": """
        WITH m AS (SELECT l_returnflag, median(l_extendedprice) AS median, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT l_returnflag, any_value(n) AS n, round(any_value(m.median), 4) AS median,
               round(median(abs(l_extendedprice - m.median)), 4) AS mad
        FROM lineitem JOIN m USING (l_returnflag) GROUP BY 1""",
}
QUERIES = {name: globals()[name] for name in ORACLES}
