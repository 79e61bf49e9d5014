"""Queries: states that batches add to (distinct sketches, daily statistics)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..operators import partials as P, sketches as S, variants as V
from ..sources import keyed as B
from ..sources.workspace import scratch
from . import common as C

_BY = "event_type string"
_RANGES = {"week": (dt.date(2024, 1, 8), dt.date(2024, 1, 14)), "across loads": (dt.date(2024, 1, 5), dt.date(2024, 1, 25)), "all": (None, None)}


def _batches(events):
    """A batch of the early days, and one that delivers half of them again with other values."""
    early = events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp"))
    late = events.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp")).withColumn("value", F.col("value") * 2)
    return early, late


def distinct_sketched(spark, sf_dir):
    """Distinct users per type and range of days: the exact number, and whether the merged daily sketches are within
    three standard errors (and one user) of it. Two loads overlap."""
    events, path = C.moments(C.table(spark, sf_dir, "events")), scratch(spark, "user-sketches")
    for batch in _batches(events):
        S.load_sketches(batch, path, ["user_id"], "ts", _BY)
    found = None
    for name, (first, last) in _RANGES.items():
        near = S.distinct_between(spark, path, _BY, first, last, "estimate")
        day = F.to_date("ts")
        kept = events.filter(day.between(F.lit(first), F.lit(last))) if first else events
        exact = kept.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
        bound = 3 * S.relative_error() * F.col("users") + 1
        both = exact.join(near, "event_type").select(
            "event_type", F.lit(name).alias("days"), "users", (F.abs(F.col("estimate") - F.col("users")) <= bound).alias("within"))
        found = both if found is None else found.unionByName(both)
    return found


def _loaded(spark, sf_dir, serve=None):
    """The state of the events: two halves of the early batch, a compaction, then a redelivery of known rows."""
    events = C.moments(C.table(spark, sf_dir, "events")).select("event_id", "event_type", "ts", "value")
    early, late = _batches(events)
    state = P.DailyState(scratch(spark, "daily-state"), _BY, "ts", {"value": 2})
    steps = [(early.filter("event_id % 2 = 0"), {}), (early.filter("event_id % 2 = 1"), {}), (late, {"row_key": ["event_id"], "earlier": early})]
    for number, (batch, more) in enumerate(steps):
        days = state.load(batch, uuid.uuid4().hex, **more)
        if number == 1:
            state.compact(spark, "compacted", last=dt.date(2024, 1, 15))
        if serve is not None and days:
            serve(state, min(days), max(days))
    return state


def _shown(finished):
    return finished.select("event_type", F.col("date").cast("string").alias("date"), "n", "value_mean", "value_std", "value_min", "value_max")


def daily_incremental(spark, sf_dir):
    """Daily statistics read from states that three loads, one of them a redelivery, have added to."""
    state = _loaded(spark, sf_dir)
    return _shown(state.finalised(state.read(spark)))


def daily_serving_table(spark, sf_dir):
    """The finished rows of the days each load touched, upserted by type and date."""
    path = scratch(spark, "daily-serving")

    def serve(state, first, last):
        P.upsert_daily(state.finalised(state.read(spark, first, last)), path, ["event_type"])

    state = _loaded(spark, sf_dir, serve)
    ddl = state.finalised(state.read(spark)).schema
    return _shown(spark.read.schema(ddl).parquet(path))


def entity_incremental(spark, sf_dir):
    """Statistics per type over all days, from the daily states alone."""
    state = _loaded(spark, sf_dir)
    return state.finalised(state.read(spark), ["event_type"]).select("event_type", "n", "value_mean", "value_std", "value_min", "value_max")


def _upserted(spark, sf_dir):
    """Orders without a date in buckets: a first load, then price changes of one customer in fifty with new orders beside them."""
    orders = C.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema)
    table = B.BucketedTable(scratch(spark, "keyed-orders"), ddl, ("o_orderkey",), 8, 2_000)
    steps = [table.upsert(orders.filter("o_custkey % 7 <> 0"))]
    late = orders.filter("o_orderkey <= 1000")
    steps.append(table.upsert(late.withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("o_orderstatus", F.lit("X")), ["o_totalprice"]))
    steps.append(table.upsert(orders.filter("o_custkey % 7 = 0 and o_orderkey > 1000")))
    return table, steps


def upsert_bucketed(spark, sf_dir):
    return _upserted(spark, sf_dir)[0].read(spark)


def lookup_bucketed(spark, sf_dir):
    """Rows of some keys; an upsert of low keys and this lookup open the files of these keys only."""
    table, steps = _upserted(spark, sf_dir)
    wanted = C.table(spark, sf_dir, "lineitem").filter("l_quantity = 50 and l_discount = 0.1").select(F.col("l_orderkey").alias("o_orderkey"))
    pruned = steps[1].read <= min(steps[1].files, 8 * (-(-1000 // 8) // 2_000 + 2))
    return table.lookup(wanted).withColumn("pruned", F.lit(pruned))


def variant_drift(spark, sf_dir):
    """Payloads of the late days against the history of the early ones: a number that became text, a name that came, one
    that went, and a list whose elements changed."""
    e = C.events(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    old = F.struct(
        "event_id", F.struct("value", F.struct(F.col("k")).alias("reading"), F.lit("m").alias("unit")).alias("measure"),
        F.array(F.struct(F.col("event_type").alias("name"), F.lit(True).alias("shown"))).alias("tags"))
    number = F.when(F.col("k") < 50, F.to_json(F.struct(F.struct(F.col("k").cast("string").alias("k")).alias("r")))).otherwise(F.to_json(F.struct(F.struct("k").alias("r"))))
    new = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"measure":{"value":'), F.col("value").cast("string"),
        F.lit(',"reading":'), F.get_json_object(number, "$.r"), F.lit('},"tags":["'), "event_type", F.lit('"],"extra key":null}'))
    history = scratch(spark, "payload-history")
    V.keep(V.profile(e.filter(early).select(F.to_json(old).alias("payload")), "payload"), history, "early")
    late = V.profile(e.filter(~early).select(new.alias("payload")), "payload")
    return V.drift(late, V.read_history(spark, history))


_UPSERTED = """(
    SELECT o_orderkey, o_custkey,
        CASE WHEN o_orderkey <= 1000 AND o_custkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey <= 1000 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
    FROM orders)"""
_VALUES = "(SELECT event_type, ts, CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN value * 2 ELSE value END AS value FROM events)"
_STATISTICS = """
    count(*) AS n, round_even(sum(u) / count(*), 0) / 100 AS value_mean,
    CASE WHEN count(*) > 1 THEN round_even(sqrt(CAST(count(*) * sum(u * u) - sum(u) * sum(u) AS DOUBLE)
        / (CAST(count(*) AS DOUBLE) * (count(*) - 1))) / 100 * 100, 0) / 100 END AS value_std,
    min(value) AS value_min, max(value) AS value_max"""
_UNITS = f"(SELECT *, CAST(round(value * 100) AS HUGEINT) AS u FROM {_VALUES} v)"
_DAILY = f"SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, {_STATISTICS} FROM {_UNITS} u GROUP BY ALL"

ORACLES = {
    "distinct_sketched": " UNION ALL ".join(
        f"SELECT event_type, '{name}' AS days, count(DISTINCT user_id) AS users, true AS within FROM events"
        + (f" WHERE CAST(ts AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'" if first else "") + " GROUP BY event_type"
        for name, (first, last) in _RANGES.items()),
    "daily_incremental": _DAILY,
    "daily_serving_table": _DAILY,
    "upsert_bucketed": f"SELECT * FROM {_UPSERTED} o",
    "lookup_bucketed": f"""
        SELECT *, true AS pruned FROM {_UPSERTED} o
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50 AND l_discount = 0.1)""",
    "variant_drift": f"""
        WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE k < 50) AS t FROM {C.EVENTS_SQL} e WHERE ts >= TIMESTAMP '2024-01-15')
        SELECT path, type, status, records FROM (
            SELECT unnest([
                {{path: '$', type: 'object', status: 'expected', records: n}}, {{path: '$.event_id', type: 'integer', status: 'expected', records: n}},
                {{path: '$.measure', type: 'object', status: 'expected', records: n}}, {{path: '$.measure.value', type: 'number', status: 'expected', records: n}},
                {{path: '$.measure.reading', type: 'object', status: 'expected', records: n}},
                {{path: '$.measure.reading.k', type: 'string', status: 'retyped', records: t}},
                {{path: '$.measure.reading.k', type: 'integer', status: 'expected', records: n - t}},
                {{path: '$.tags', type: 'array', status: 'expected', records: n}}, {{path: '$.tags[]', type: 'string', status: 'retyped', records: n}},
                {{path: '$[''extra key'']', type: 'null', status: 'added', records: n}},
                {{path: '$.measure.unit', type: NULL, status: 'missing', records: 0}}, {{path: '$.tags[].name', type: NULL, status: 'missing', records: 0}},
                {{path: '$.tags[].shown', type: NULL, status: 'missing', records: 0}}], recursive := true) FROM c) x""",
    "entity_incremental": f"SELECT event_type, {_STATISTICS} FROM {_UNITS} u GROUP BY event_type",
}
QUERIES = {name: globals()[name] for name in ORACLES}
