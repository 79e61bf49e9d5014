import hashlib

import numpy as np
import pytest

from tidewell.llm import piece_codec, queries, sharding

SF_DIR = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b   c", "\n \t x", "a▁b▁ ▁", "</s> <s> <0x41>", "ﬁ Ａ 　 \xa0", "x\x00y",
       "日本語 テキスト", "🙂🙂 🙂", "é", " " * 40, "é" * 300, "w" * 5000 + " " + "12345 " * 50]


def library(texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    ids = [model.encode(t or "", add_eos=True) for t in texts]
    return ids, [model.decode(i) for i in ids]


def test_codec_equals_library_on_odd_texts(documents):
    df = documents(list(enumerate(ODD)) + [(None, "a b"), (4, "a")])
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in piece_codec.encode(df, queries.piece_model()).collect()), key=repr)
    ids, decoded = library(ODD)
    want = [(i, a, b) for i, (a, b) in enumerate(zip(ids, decoded))]
    extra = library(["a b", "a"])
    want += [(None, extra[0][0], extra[1][0]), (4, extra[0][1], extra[1][1])]
    assert got == sorted(want, key=repr)
    assert piece_codec.encode(df.limit(0), queries.piece_model()).collect() == []


def test_codec_query_equals_library(spark):
    texts = {r.doc_id: r.text for r in queries.read(spark, SF_DIR, "documents").collect()}
    ids, decoded = library(texts.values())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {k: (len(i), sha(" ".join(map(str, i))), sha(d)) for k, i, d in zip(texts, ids, decoded)}
    got = {r[0]: tuple(r[1:]) for r in queries.sentencepiece_ids(spark, SF_DIR).collect()}
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 1000, 4097])
def test_permutation(n):
    image = sharding.permute(np.arange(n), n, 5)
    assert sorted(image) == list(range(n))
    assert n < 100 or list(image) != list(sharding.permute(np.arange(n), n, 6))


def test_shards(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 10)
    rows = [(i, f"t{i}") for i in range(150)] + [(7, "same")] * 80 + [(None, None)] * 3
    df = documents(rows)
    first = [tuple(r) for r in sharding.assign(df, ["doc_id", "text"], 4).collect()]
    again = [tuple(r) for r in sharding.assign(df.repartition(7), ["doc_id", "text"], 4).collect()]
    assert sorted(first, key=repr) == sorted(again, key=repr)
    assert sorted(r[2] for r in first) == list(range(len(rows)))
    for shard in range(4):
        slots = sorted(r[4] for r in first if r[3] == shard)
        assert slots == list(range(len(slots))) and len(slots) in (len(rows) // 4, len(rows) // 4 + 1)
    assert all(sharding.locate(r[2], len(rows), 4) == r[3:] for r in first)
    assert sharding.assign(df.limit(0), ["doc_id"], 4).collect() == []


def test_written_shards(spark, documents, tmp_path):
    df = documents([(i % 5, f"t{i % 5}") for i in range(23)] + [(None, None)])
    sharding.write_shards(df.select("doc_id", "text"), ["doc_id", "text"], str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 24
    assert sorted(r["count"] for r in back.groupBy("shard").count().collect()) == [8, 8, 8]


def test_written_shards_with_clashing_names(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", i * 2, "own") for i in range(20)] + [(1, "t1", 2, "own")] * 30, "doc_id int, text string, slot int, shard string")
    sharding.write_shards(df, ["doc_id"], str(tmp_path / "out"), 3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(back.columns) == ["doc_id", "shard", "shard_", "slot", "slot_", "text"]
    whole = sorted((r.doc_id, r.text, r.slot_, r.shard_) for r in back.collect())
    assert whole == sorted(tuple(r) for r in df.collect())
    for shard in range(3):
        slots = sorted(r.slot for r in back.filter(back.shard == shard).collect())
        assert slots == list(range(len(slots))) and len(slots) in (16, 17)
    sharding.write_shards(df.limit(0), ["doc_id"], str(tmp_path / "none"), 3)


@pytest.mark.parametrize(("per_bucket", "per_group"), [(20_000, 10_000), (7, 3), (3, 1)])
def test_numbers_by_brute_force(spark, documents, monkeypatch, per_bucket, per_group):
    """Numbers follow bucket, hash and key; offsets of buckets are added up in groups of any size."""
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", per_bucket)
    monkeypatch.setattr(sharding, "BUCKETS_PER_GROUP", per_group)
    from pyspark.sql import functions as F

    df = documents([(None if i % 31 == 4 else i // 2, f"t{i % 9}") for i in range(211)]).select("doc_id", "text")
    buckets = max(1, -(-211 // per_bucket))
    hashed = df.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h")).collect()
    order = sorted((r.h % buckets, r.h, r.doc_id is not None, r.doc_id or 0, r.text, r.doc_id) for r in hashed)
    want = sorted(((o[5], o[4], n, *sharding.locate(n, 211, 5)) for n, o in enumerate(order)), key=repr)
    got = sorted((tuple(r) for r in sharding.assign(df.repartition(6), ["doc_id", "text"], 5).collect()), key=repr)
    assert got == want


def test_shards_query(spark):
    got = queries.shards(spark, SF_DIR)
    rows = {r.doc_id: r for r in got.collect()}
    from pyspark.sql import functions as F
    import zlib

    docs = queries.read(spark, SF_DIR, "documents").collect()
    sized = [(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs]
    table = spark.createDataFrame(sized, "doc_id bigint, size bigint, crc bigint")
    order = sorted((r.h, r.doc_id) for r in table.select("doc_id", F.xxhash64("doc_id", "size", "crc").alias("h")).collect())
    places = {i: sharding.locate(n, len(docs), 8) for n, (_, i) in enumerate(order)}
    for i, size, crc in sized:
        assert tuple(rows[i]) == (i, size, crc, "rows", *places[i], None)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert got.select("shard", "slot").distinct().count() == got.count() == 200
