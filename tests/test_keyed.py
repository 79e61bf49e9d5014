"""Bucketed keyed tables: upserts by brute force, pruning, interrupted writes, vacuum."""

import random

import pytest

from samples import rows
from tidewell.operators.merge import DuplicateKeys
from tidewell.sources import keyed as B

DDL = "id bigint, kind string, x double, note string"


def table(tmp_path, **more):
    return B.BucketedTable(str(tmp_path / "t"), DDL, ("id", "kind"), 4, **({"file_rows": 5} | more))


@pytest.mark.parametrize("seed", range(2))
def test_upserts_by_brute_force(spark, tmp_path, seed):
    draw, held, keyed = random.Random(seed), {}, table(tmp_path)
    assert keyed.read(spark).count() == 0
    for step in range(5):
        keys = {(draw.choice([None, draw.randrange(60 * (step + 1))]) if draw.random() < 0.1 else draw.randrange(200), draw.choice(["a", "b"])) for _ in range(40)}
        keys = {k for k in keys if k[0] is not None}
        batch = [(i, k, draw.random(), f"s{step}") for i, k in keys]
        updates = ["x"] if step == 3 else None
        done = keyed.upsert(spark.createDataFrame(batch, DDL).repartition(3), updates)
        assert done.rows == len(batch) and done.read <= done.files
        for i, k, x, note in batch:
            old = held.get((i, k))
            held[i, k] = (x, old[1]) if old and updates else (x, note)
        assert rows(keyed.read(spark)) == sorted(((i, k, *v) for (i, k), v in held.items()), key=repr)
        files = keyed.manifest(spark).collect()
        assert sum(f["rows"] for f in files) == len(held) and max(f["rows"] for f in files) <= 5
        for bucket in range(4):  # files of a bucket are ranges that do not overlap
            ends = sorted((tuple(f["first"]), tuple(f["last"])) for f in files if f["bucket"] == bucket)
            assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
        wanted = [(draw.randrange(250), draw.choice(["a", "b"])) for _ in range(30)]
        found = keyed.lookup(spark.createDataFrame(wanted, "id bigint, kind string"))
        assert rows(found, "id", "kind") == sorted({w for w in wanted if w in held}, key=repr)
    before = rows(keyed.read(spark))
    assert keyed.compact(spark) > 0 and keyed.vacuum(spark) > 0 and keyed.vacuum(spark) == 0
    assert rows(keyed.read(spark)) == before


def test_only_files_of_the_keys_are_opened(spark, tmp_path):
    keyed = table(tmp_path, file_rows=100)
    keyed.upsert(spark.range(4000).selectExpr("id", "'a' AS kind", "1.0 AS x", "'n' AS note"))
    files = {r["file"] for r in keyed.manifest(spark).collect()}
    assert len(files) >= 40
    done = keyed.upsert(spark.createDataFrame([(7, "a", 2.0, "m"), (8, "a", 2.0, "m")], DDL))
    assert (done.files, done.read <= 2, done.written <= 2) == (len(files), True, True)
    after = {r["file"] for r in keyed.manifest(spark).collect()}
    assert len(files & after) >= len(files) - 2  # the others are as they were
    found = keyed.lookup(spark.createDataFrame([(7, "a"), (100_000, "a")], "id bigint, kind string"))
    assert len(found.inputFiles()) <= 2 and rows(found, "id", "x") == [(7, 2.0)]


def test_what_an_interrupted_upsert_wrote_is_not_read(spark, tmp_path, monkeypatch):
    keyed = table(tmp_path)
    keyed.upsert(spark.createDataFrame([(1, "a", 1.0, "n")], DDL))

    def broken(self, index, version):
        raise OSError("storage is down")

    with monkeypatch.context() as patched:
        patched.setattr(B.BucketedTable, "_state", broken)
        with pytest.raises(OSError):
            keyed.upsert(spark.createDataFrame([(1, "a", 2.0, "n"), (2, "a", 2.0, "n")], DDL))
    assert rows(keyed.read(spark), "id", "x") == [(1, 1.0)]
    keyed.upsert(spark.createDataFrame([(2, "a", 3.0, "n")], DDL))
    assert rows(keyed.read(spark), "id", "x") == [(1, 1.0), (2, 3.0)]


def test_refusals(spark, tmp_path):
    keyed = table(tmp_path)
    with pytest.raises(DuplicateKeys):
        keyed.upsert(spark.createDataFrame([(1, "a", 1.0, "n")] * 2, DDL))
    with pytest.raises(ValueError):
        keyed.vacuum(spark, 0)
    assert keyed.upsert(spark.createDataFrame([], DDL)).rows == 0
    assert keyed.read(spark).count() == 0
