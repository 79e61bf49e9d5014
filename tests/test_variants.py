"""Paths and types of JSON payloads, and their drift."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from samples import RUN_TS, rows
from tidewell.operators import gates as G, variants as V


def kind(x):
    for types, name in (((bool,), "boolean"), ((int,), "integer"), ((float,), "number"), ((str,), "string"), ((dict,), "object"), ((list,), "array")):
        if isinstance(x, types):
            return name
    return "null"


def paths(x, at="$"):
    yield at, kind(x)
    if isinstance(x, dict):
        for name, value in x.items():
            plain = name.isascii() and name.replace("_", "a").isalnum()
            yield from paths(value, f"{at}.{name}" if plain else f"{at}['{name}']")
    elif isinstance(x, list):
        for value in x:
            yield from paths(value, f"{at}[]")


def brute(texts):
    out = Counter()
    for text in texts:
        if text is None:
            continue
        try:
            held = set(paths(json.loads(text)))
        except ValueError:
            out["$", "broken"] += 1
            continue
        types = {}
        for path, t in held:
            types.setdefault(path, set()).add(t)
        for path, own in types.items():
            for t in own:
                if not (t == "null" and len(own) > 1) and not (t == "integer" and "number" in own):
                    out[path, t] += 1
    return sorted(((p, t, n) for (p, t), n in out.items()), key=repr)


def made(draw, depth=0):
    pick = draw.random()
    if depth > 3 or pick < 0.45:
        return draw.choice([1, 2**40, 1.5, -0.25, "s", "é", True, None, ""])
    if pick < 0.75:
        return {draw.choice(["a", "b", "c_1", "d e", "ü", "x.y"]): made(draw, depth + 1) for _ in range(draw.randint(0, 3))}
    return [made(draw, depth + 1) for _ in range(draw.randint(0, 3))]


@pytest.mark.parametrize("seed", range(3))
def test_profile_by_brute_force(spark, seed):
    draw = random.Random(seed)
    texts = [json.dumps(made(draw), ensure_ascii=False) for _ in range(150)] + [None, "", "{", "nope", "[]", "{}", '{"a":1}', '{"a":1}']
    df = spark.createDataFrame([(t,) for t in texts], "payload string").repartition(4)
    assert rows(V.profile(df, "payload")) == brute(texts)
    assert V.shapes(df, "payload").filter("n > 1").count() > 0


def test_depth(spark):
    df = spark.createDataFrame([('{"a":{"b":{"c":1}}}',)], "p string")
    assert rows(V.profile(df, "p", most_depth=2)) == [("$", "object", 1), ("$.a", "object", 1), ("$.a.b", "deep", 1)]


def test_drift_against_history(spark, tmp_path):
    def batch(*texts):
        return spark.createDataFrame([(t,) for t in texts], "p string")

    path = str(tmp_path / "history")
    first = V.profile(batch('{"a":{"n":1,"u":"m"},"l":[{"x":1}],"z":null}', '{"a":{"n":2,"u":null}}'), "p")
    assert {r["status"] for r in V.drift(first, V.read_history(spark, path)).collect()} == {"expected"}
    V.keep(first, path, "one")
    V.keep(first, path, "one")
    assert V.read_history(spark, path).count() == first.count()
    later = V.profile(batch('{"a":{"n":"1","u":"m","w":3},"z":5}', '{"a":{"n":null}}', "{"), "p")
    found = V.drift(later, V.read_history(spark, path)).filter("status <> 'expected'")
    assert rows(found) == sorted([
        ("$", "broken", "broken", 1), ("$.a.n", "string", "retyped", 1), ("$.a.w", "integer", "added", 1), ("$.l", None, "missing", 0),
        ("$.l[]", None, "missing", 0), ("$.l[].x", None, "missing", 0)], key=repr)
    V.keep(later, path, "two")
    assert rows(V.drift(later, V.read_history(spark, path)).filter("status <> 'expected'"), "status", "path") == [("broken", "$"), ("missing", "$.l"), ("missing", "$.l[]"), ("missing", "$.l[].x")]


def test_drift_as_a_gate_rule(spark):
    old = V.profile(spark.createDataFrame([('{"a":1,"b":2}',)], "p string"), "p")
    new = spark.createDataFrame([('{"a":"x","c":2}',)] * 3, "p string")
    found = G.Gate("g", "warn", "", [V.variant_drift("p", old)]).evaluate(new, "bronze", RUN_TS)
    assert found.status == "blocked"
    assert sorted((i.severity, i.message, i.affected_records) for i in found.issues) == [
        ("critical", "1 missing path(s): $.b", 0), ("critical", "1 retyped path(s): $.a string", 3), ("warning", "1 added path(s): $.c integer", 3)]
    same = G.Gate("g", "warn", "", [V.variant_drift("p", old)]).evaluate(spark.createDataFrame([('{"a":5,"b":null}',)], "p string"), "bronze", RUN_TS)
    assert same.status == "passed"


def test_empty(spark):
    empty = spark.createDataFrame([], "p string")
    assert V.profile(empty, "p").count() == 0
    assert V.drift(V.profile(empty, "p"), V.profile(empty, "p")).count() == 0
