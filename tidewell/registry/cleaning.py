"""Queries: cleaning, validation, enrichment, display texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import enrichment as E, numeric as N, text as X
from ..operators import cleaning as K
from . import common as C


def silver_clean(spark, sf_dir):
    cleaned = K.clean(C.raw_events(spark, sf_dir), C.EVENTS, C.RUN_TS)
    return cleaned.withColumns(
        {"ts": C.micros(F.col("ts")), "_transformed_at": C.micros(F.col("_transformed_at"))}
    )


def _judged(spark, sf_dir):
    return K.clean_with_reason(C.raw_events(spark, sf_dir), C.EVENTS, C.RUN_TS)


def silver_reject_reason(spark, sf_dir):
    return _judged(spark, sf_dir).select("event_id", "reason")


def silver_valid(spark, sf_dir):
    valid = K.valid_rows(_judged(spark, sf_dir))
    return valid.select("event_id", "event_type", "user_id", "value", "k", C.micros(F.col("ts")).alias("ts"))


def quarantine_rows(spark, sf_dir):
    rows = K.quarantine_rows(_judged(spark, sf_dir), C.RUN_TS)
    return rows.select(
        C.big(F.get_json_object("record", "$.event_id")).alias("event_id"),
        F.get_json_object("record", "$.user_id").alias("raw_user"),
        "reason",
        C.micros(F.col("quarantined_at")).alias("quarantined_at"),
        "source_layer",
    )


def category_bins(spark, sf_dir):
    e = C.events(spark, sf_dir)
    return e.select(
        "event_id",
        E.temperature_category(F.col("value") - 100).alias("temp_category"),
        E.wind_category(F.col("value")).alias("wind_category"),
    )


def labels_text(spark, sf_dir):
    e = C.events(spark, sf_dir)
    return e.select(
        "event_id",
        X.temperature_text(F.col("value") / 4 - 10).alias("shown"),
        X.completeness_label(F.col("k")).alias("completeness"),
        X.quality_mark(F.col("k")).alias("mark"),
        X.gate_label(F.col("k") >= 50).alias("gate"),
        X.run_state(F.when(F.col("k") > 20, F.col("ts"))).alias("state"),
        X.title(F.concat("event_type", F.lit("_"), F.lit("count"))).alias("title"),
        X.shown_moment(F.col("ts")).alias("shown_at"),
        F.array_join(X.name_list(F.concat("event_type", F.lit(" , "), F.col("k").cast("string"))), "|").alias("names"),
    )


def heat_index(spark, sf_dir):
    e = C.events(spark, sf_dir)
    felt = E.heat_index(F.col("value") / 10, F.when(F.col("k") >= 5, C.real("k")))
    return e.select("event_id", F.round(felt, 6).alias("heat_index"))


def time_features(spark, sf_dir):
    e = C.events(spark, sf_dir)
    features = E.calendar_features(F.col("ts"), F.col("value"), F.when(F.col("k") >= 5, F.col("k")))
    features.pop("heat_index")
    features["hour"] = C.big(features["hour"])
    return e.select("event_id", *[c.alias(n) for n, c in features.items()])


def age_and_duration(spark, sf_dir):
    e = C.moments(C.events(spark, sf_dir))
    age = N.age_hours(F.col("ts"), C.RUN_TS)
    return e.select(
        "event_id",
        F.round(age, 6).alias("age_hours"),
        N.whole_seconds(F.col("value")).alias("whole_seconds"),
        (age > 24).alias("stale"),
    )


_HEAT = "(value / 10 * 9 / 5 + 32)"
ORACLES = {
    "silver_clean": f"""
        SELECT event_id, event_type, user_id, value, k, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
               '{C.ZERO_TEXT}' AS _transformed_at, 'bronze' AS _source_layer FROM ({C.CLEAN_SQL}) c""",
    "silver_reject_reason": f"SELECT event_id, reason FROM ({C.REASON_SQL}) r",
    "silver_valid": f"""
        SELECT event_id, event_type, user_id, value, k, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts
        FROM ({C.REASON_SQL}) r WHERE reason IS NULL""",
    "quarantine_rows": f"""
        SELECT event_id, CAST(user_id AS VARCHAR) AS raw_user, reason, '{C.ZERO_TEXT}' AS quarantined_at,
               'silver' AS source_layer FROM ({C.REASON_SQL}) r WHERE reason IS NOT NULL""",
    "category_bins": """
        SELECT event_id,
               CASE WHEN t > -100 AND t <= 0 THEN 'freezing' WHEN t > 0 AND t <= 10 THEN 'cold'
                    WHEN t > 10 AND t <= 20 THEN 'mild' WHEN t > 20 AND t <= 30 THEN 'warm'
                    WHEN t > 30 AND t <= 100 THEN 'hot' END AS temp_category,
               CASE WHEN value > -1 AND value <= 5 THEN 'calm' WHEN value > 5 AND value <= 15 THEN 'light'
                    WHEN value > 15 AND value <= 30 THEN 'moderate'
                    WHEN value > 30 AND value <= 200 THEN 'strong' END AS wind_category
        FROM (SELECT event_id, value, value - 100 AS t FROM events) e""",
    "labels_text": f"""
        SELECT event_id,
               CASE WHEN t < 0 THEN '🥶 ' WHEN t < 15 THEN '❄️ ' WHEN t < 25 THEN '🌤️ ' ELSE '🔥 ' END
                   || format('{{:.1f}}', t) || '°C' AS shown,
               CASE WHEN k >= 95 THEN 'Good' ELSE 'Needs Attention' END AS completeness,
               CASE WHEN k >= 95 THEN '✅' ELSE '⚠️' END AS mark,
               CASE WHEN k >= 50 THEN 'PASSED' ELSE 'FAILED' END AS gate,
               CASE WHEN k > 20 THEN 'Ready' ELSE 'No runs yet' END AS state,
               upper(event_type[1]) || event_type[2:] || ' Count' AS title,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown_at,
               event_type || '|' || CAST(k AS VARCHAR) AS names
        FROM (SELECT *, value / 4 - 10 AS t FROM {C.EVENTS_SQL} x) e""",
    "heat_index": f"""
        SELECT event_id, round((CASE WHEN {_HEAT} >= 80 AND k >= 40
                   THEN 0.5 * ({_HEAT} + 61.0 + ({_HEAT} - 68.0) * CAST(1.2 AS DOUBLE) + k * CAST(0.094 AS DOUBLE))
                   ELSE {_HEAT} END - 32) * 5 / 9, 6) AS heat_index
        FROM {C.EVENTS_SQL} e""",
    "time_features": f"""
        SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, dayname(ts) AS day_of_week,
               hour(ts) BETWEEN 6 AND 18 AS is_daytime,
               k >= 5 AND value BETWEEN 18 AND 26 AND k BETWEEN 30 AND 60 AS is_comfortable
        FROM {C.EVENTS_SQL} e""",
    "age_and_duration": """
        SELECT event_id, round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts)) / 3.6e9, 6) AS age_hours,
               CAST(trunc(value) AS BIGINT) AS whole_seconds,
               (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts)) / 3.6e9 > 24 AS stale
        FROM events""",
}
QUERIES = {name: globals()[name] for name in ORACLES}
