"""Compare every registered query with its SQL twin: columns, row count, values.

Run as ``python tests/compare.py [sf] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def canonical(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(canonical(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def oracle_rows(con, sql):
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()


def difference(spark, con, name, query, sql, sf_dir):
    """None when both sides agree, else a short text."""
    df = query(spark, sf_dir)
    ours = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = sorted_rows(*oracle_rows(con, sql))
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference\n   ours   {a}\n   theirs {b}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", os.environ.get("ZONE", "UTC"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if (wanted and name not in wanted) or name not in oracles:
            continue
        started = time.time()
        try:
            text = difference(spark, con, name, query, oracles[name], sf_dir)
        except Exception as failure:  # noqa: BLE001
            text = f"{type(failure).__name__}: {str(failure)[:1500]}"
        bad += text is not None
        print(f"{'ok  ' if text is None else 'BAD '} {name} {time.time() - started:.2f}s {text or ''}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
